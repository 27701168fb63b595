import pytest
from pyspark.sql import functions as F

from sparktab.operators import profile as p
from sparktab.sources.readers import SourceError, load_source, read_table, require_rows, schema_from_rules, read_rejects, source_errors
from sparktab.sources.writers import write_predictions, write_splits


def test_round_trip_by_suffix_and_type(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a bigint, b string")
    for fmt in ("csv", "json", "orc", "parquet"):
        path = f"{tmp_path}/t.{fmt}"
        df.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
        by_suffix = read_table(spark, path, schema=df.schema)
        by_type = load_source(spark, {"raw_path": path, "type": fmt}, df.schema)
        assert sorted(by_suffix.collect()) == sorted(by_type.collect()) == sorted(df.collect())


def test_csv_infers_types_and_reads_latin1(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("a,b\n1,é\n2,y\n".encode("latin-1"))
    df = load_source(spark, {"raw_path": f"{tmp_path}/t.csv", "encoding": "ISO-8859-1"})
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "é"), (2, "y")]


def test_headerless_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,x\n2,y\n")
    assert load_source(spark, {"raw_path": f"{tmp_path}/t.csv", "header": None}).count() == 2


def test_bad_sources(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\n1\n")
    for call in (
        lambda: read_table(spark, f"{tmp_path}/t.txt"),
        lambda: read_table(spark, f"{tmp_path}/t.csv", "excel"),
        lambda: read_table(spark, f"{tmp_path}/absent.csv"),
    ):
        with pytest.raises(SourceError):
            call()


def test_empty_table_is_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    empty = load_source(spark, {"raw_path": f"{tmp_path}/t.csv"})
    with pytest.raises(SourceError):
        require_rows(empty)


def test_schema_from_rules():
    schema = schema_from_rules([{"name": "id", "dtype": "int"}, {"name": "x", "dtype": "float"}])
    assert schema.simpleString() == "struct<id:bigint,x:double>"


def test_split_table_is_pruned(spark, tmp_path):
    df = spark.range(9).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    write_splits(df, str(tmp_path / "s"))
    part = spark.read.parquet(str(tmp_path / "s")).where("split = 'test'")
    assert part.count() == 3
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().toString()


def test_predictions_keep_ids(spark, tmp_path):
    df = spark.createDataFrame([(10, 0.2, 0.8, 1), (20, 0.6, 0.4, 0)], "id int, class_0 double, class_1 double, prediction int")
    write_predictions(df, str(tmp_path / "p"), "id", "csv")
    stored = read_table(spark, str(tmp_path / "p"), "csv")
    assert stored.columns == ["id", "class_0", "class_1", "prediction"]
    assert {r.id for r in stored.collect()} == {10, 20}


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "", float("nan"))], "i int, s string, x double")
    value = p.fingerprint(df).first()
    assert p.fingerprint(df.repartition(3).orderBy(F.desc("i"))).first() == value
    assert p.fingerprint(df.withColumn("s", F.coalesce("s", F.lit("")))).first() != value
    shifted = spark.createDataFrame([("ab", "c")], "x string, y string")
    other = spark.createDataFrame([("a", "bc")], "x string, y string")
    assert p.fingerprint(shifted).first() != p.fingerprint(other).first()


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, None)], "a int, b string")
    assert p.duplicate_count(df).first().n_duplicates == 1
    assert p.duplicate_count(df, ["b"]).first().n_duplicates == 2
    assert p.duplicate_count(df.where("false")).first().n_rows == 0


def test_fingerprint_keeps_every_digit(spark):
    def value(x):
        return p.fingerprint(spark.createDataFrame([(x,)], "x double")).first().fingerprint

    numbers = [0.1234561, 0.1234564, 0.12345640000000001, 1e-300, 2e-300, 5e-324, 1e300, -1e300, 9e15, 9e15 + 2, 0.0, 1.0, 2.0, -1.0, 0.5, float("inf"), float("-inf"), float("nan"), None]
    assert len({value(x) for x in numbers}) == len(numbers)
    assert value(0.0) == value(-0.0)


def test_head_and_schema(spark):
    df = spark.range(10).repartition(4)
    assert [r.id for r in p.head_sample(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [tuple(r) for r in p.schema_rows(df).collect()] == [(0, "id", "bigint")]


def test_broken_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,x,2.5\n2,y\nthree,z,1.0\n4,w,1.0,more\n5,,\n")
    good, bad = read_rejects(spark, f"{tmp_path}/t.csv", "a int, b string, c double")
    assert sorted((r.a, r.b, r.c) for r in good.collect()) == [(1, "x", 2.5), (5, None, None)]
    assert good.select("b").count() == 2 and good.columns == ["a", "b", "c"]
    assert sorted(r["_record"] for r in bad.collect()) == ["2,y", "4,w,1.0,more", "three,z,1.0"]


def test_errors_of_a_running_job(spark, tmp_path):
    (tmp_path / "t.parquet").mkdir()
    (tmp_path / "t.parquet/part.parquet").write_bytes(b"no such format at all")
    with pytest.raises(SourceError, match="cannot read"), source_errors(f"{tmp_path}/t.parquet"):
        spark.read.schema("a int").parquet(f"{tmp_path}/t.parquet").collect()
    with pytest.raises(ZeroDivisionError), source_errors("x"):
        1 / 0  # noqa: B018
