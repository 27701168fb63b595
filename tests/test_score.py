import json

import pytest
from pyspark.sql import functions as F

from sparktab.operators.knn import ModelError, train_model
from sparktab.operators.preprocess import PreprocessError, columns_to_array
from sparktab.operators.score import RECORD_FIELDS, Scorer, load_scorer, parse_records, prediction_summary, record_schema, save_scorer, score, score_files, score_json, score_or_reject
from sparktab.operators.validate import ValidationError
from sparktab.plans.stages import data_stage, infer_stage, train_stage
from sparktab.sources.readers import SourceError
from sparktab.streaming.quality import late_rows, latest_windows, quality_stream, windowed_quality
from sparktab.streaming.score import score_stream

CONFIG = {
    "target": "target",
    "raw_features": ["x1", "x2"],
    "features": {"continuous": ["x1"]},
    "preprocessing": {"rename_columns": {"x 1": "x1"}},
    "data_split": {"test_size": 0.25, "valid_size": 0.25},
    "model": {"type": "knn", "params": {"n_neighbors": 3, "metric": "minkowski"}},
}


def twelve(spark):
    rows = [(i, i + 1, 12 - i, i % 2) for i in range(12)]
    return spark.createDataFrame(rows, "id bigint, x1 int, x2 int, target int")


@pytest.fixture(scope="module")
def scorer(spark):
    rows = [(i, float(i), float(20 - i), int(i > 9)) for i in range(20)]
    df = columns_to_array(spark.createDataFrame(rows, "id bigint, f1 double, f2 double, y int"), ["f1", "f2"], "v")
    return Scorer(train_model(df, "id", "v", "y", params={"n_neighbors": 3, "metric": "euclidean"}), ["f1", "f2"])


def test_train_stage(spark):
    trained = train_stage(twelve(spark).withColumnRenamed("x1", "x 1"), CONFIG, "id")
    assert {r.split: r.n for r in trained.report.collect()} == {"train": 6, "valid": 3, "test": 3}
    assert trained.predictions.count() == 12
    assert trained.scorer.model.n_neighbors == 3
    out = infer_stage(twelve(spark).drop("target"), trained.scorer, CONFIG)
    assert out.columns[-2:] == ["prediction", "prediction_proba"] and out.count() == 12


def test_scaling_learns_from_train_only(spark):
    trained = train_stage(twelve(spark), CONFIG, "id")
    train = trained.processed.where("split = 'train'").select(F.col("features")[0].alias("x")).collect()
    assert min(r.x for r in train) == 0.0 and max(r.x for r in train) == 1.0


def test_train_stage_errors(spark):
    with pytest.raises(ModelError):
        train_stage(twelve(spark), {**CONFIG, "model": {"type": "svm"}}, "id")
    with pytest.raises(PreprocessError):
        train_stage(twelve(spark).drop("target"), CONFIG, "id")


def test_data_stage(spark, tmp_path):
    twelve(spark).write.option("header", True).csv(str(tmp_path / "t"))
    rules = [{"name": n, "dtype": "int"} for n in ("id", "x1", "x2", "target")]
    config = {
        "data_source": {"raw_path": str(tmp_path / "t")},
        "schema_from_rules": True,
        "data_validation": {"schema": {"columns": rules}},
    }
    assert data_stage(spark, config).count() == 12
    with pytest.raises(SourceError):
        data_stage(spark, {"data_source": {"raw_path": str(tmp_path / "none")}})


def test_data_stage_reads_its_source_once(spark, tmp_path):
    """The rules are counted on the way to the shared folder; later steps do not see the source."""
    path = tmp_path / "t"
    twelve(spark).write.option("header", True).csv(str(path))
    rules = [{"name": "x1", "dtype": "int", "max": 10}]
    config = {"data_source": {"raw_path": str(path)}, "schema_from_rules": True, "data_validation": {"action_on_error": "warn", "schema": {"columns": rules}}}
    out = data_stage(spark, {**config, "schema_from_rules": False})
    assert not any(str(path) in f for f in out.inputFiles()) and out.count() == 12
    config["data_validation"]["action_on_error"] = "raise"
    with pytest.raises(ValidationError, match="x1"):
        data_stage(spark, {**config, "schema_from_rules": False})
    twelve(spark).where("false").coalesce(1).write.mode("overwrite").option("header", True).csv(str(path))
    with pytest.raises(SourceError, match="empty"):
        data_stage(spark, config)


def test_score_appends(spark, scorer):
    df = spark.createDataFrame([(100, 1.0, 19.0, "kept"), (101, 18.0, 2.0, "kept")], "id bigint, f1 double, f2 double, note string")
    rows = {r.id: r for r in score(df, scorer, proba=True).collect()}
    assert (rows[100].prediction, rows[100].prediction_proba, rows[100].note) == (0, 0.0, "kept")
    assert (rows[101].prediction, rows[101].prediction_proba) == (1, 1.0)
    assert prediction_summary(score(df, scorer, proba=True)).first().proba_mean == 0.5
    with pytest.raises(PreprocessError, match="f2"):
        score(df.drop("f2"), scorer)


def test_score_sends_the_vector_only(spark, scorer):
    """One Arrow function over the vector; no struct of the row, no join, no shuffle."""
    df = spark.range(5).selectExpr("id", "double(id) AS f1", "20D - id AS f2", "repeat('x', 1000) AS note", "map('a', id) AS extra")
    plan = score(df, scorer, proba=True)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.count("ArrowEvalPython") == 1
    assert "MapInArrow" not in plan and "Exchange" not in plan and "named_struct" not in plan and "struct(id" not in plan
    assert score(df, scorer).columns == ["id", "f1", "f2", "note", "extra", "prediction"]


BAD = [(1, 1.0, 19.0, "a"), (2, None, 19.0, "b"), (3, float("nan"), float("inf"), "c"), (None, 18.0, 2.0, "d"), (2, 18.0, None, "e"), (4, 18.0, float("-inf"), "f")]


def test_bad_rows_are_set_aside(spark, scorer):
    df = spark.createDataFrame(BAD, "id bigint, f1 double, f2 double, missing_features string")
    good, bad = score_or_reject(df, scorer, proba=True)
    assert {(r.id, r.prediction, r.prediction_proba, r.missing_features) for r in good.collect()} == {(1, 0, 0.0, "a"), (None, 1, 1.0, "d")}
    assert bad.columns == ["id", "f1", "f2", "missing_features"]
    assert sorted((r.id, r.missing_features) for r in bad.collect()) == [(2, ["f1"]), (2, ["f2"]), (3, ["f1", "f2"]), (4, ["f2"])]
    with pytest.raises(Exception, match="missing"):
        score(df, scorer).collect()
    good, bad = score_or_reject(df.where("false"), scorer)
    assert good.count() == bad.count() == 0


def test_imputed_features_are_not_missing(spark):
    rows = [(i, float(i) if i % 4 else None, float(12 - i), i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, x1 double, x2 double, target int")
    trained = train_stage(df, CONFIG, "id")
    fresh = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None)], "id bigint, x1 double, x2 double")
    good, bad = score_or_reject(fresh, trained.scorer)
    assert [r.id for r in good.collect()] == [1] and [(r.id, r.missing_features) for r in bad.collect()] == [(2, ["x2"])]


def test_files_with_bad_rows(spark, scorer, tmp_path):
    (tmp_path / "in.csv").write_text("id,f1,f2,note\n7,1.0,19.0,x\n8,,5.0,y\n9,15.0,5.0,z\n")
    out = score_files(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out", scorer, rejects_path=f"{tmp_path}/bad")
    assert {r.id: r.prediction for r in out.collect()} == {7: 0, 9: 1}
    assert [(r.id, r.note, r.missing_features) for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == [(8, "y", ["f1"])]


def test_bad_rows_do_not_stop_a_stream(spark, scorer, tmp_path):
    df = spark.createDataFrame([(r[0], r[1], r[2]) for r in BAD], "id bigint, f1 double, f2 double")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/scored")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out/rejects")).count() == 4


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_score_files(spark, scorer, tmp_path, fmt):
    (tmp_path / "in.csv").write_text("id,f1,f2\n7,1.0,19.0\n8,15.0,5.0\n")
    out = score_files(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out", scorer, proba=True, output_format=fmt)
    assert out.columns == ["id", "class_0", "class_1", "prediction"]
    assert {r.id: r.prediction for r in out.collect()} == {7: 0, 8: 1}
    (tmp_path / "in.txt").write_text("id\n")
    with pytest.raises(SourceError):
        score_files(spark, f"{tmp_path}/in.txt", f"{tmp_path}/out", scorer)


def test_record_schema():
    assert len(RECORD_FIELDS) == len(set(RECORD_FIELDS)) == 30
    assert not any(f.nullable for f in record_schema())


def test_records(spark):
    whole = {name: 1.5 for name in RECORD_FIELDS}
    short = {k: v for k, v in whole.items() if k != "mean_radius"}
    texts = [json.dumps(whole), json.dumps(short), "{not json", None, json.dumps({**whole, "worst_area": "x"}), json.dumps({**whole, "mean_area": 3})]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, record string")
    good, bad = parse_records(df, "record")
    assert sorted(r.id for r in good.collect()) == [0, 5]
    rejected = {r.id: r.missing_fields for r in bad.collect()}
    assert set(rejected) == {1, 2, 3, 4} and rejected[1] == ["mean_radius"]


def test_score_json(spark, scorer):
    texts = [json.dumps({"f1": 1.0, "f2": 19.0}), json.dumps({"f1": 19.0, "f2": 1.0}), json.dumps({"f1": 1.0})]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, record string")
    good, bad = score_json(df, "record", scorer)
    assert {r.id: (r.prediction, r.probability) for r in good.collect()} == {0: (0, 0.0), 1: (1, 1.0)}
    assert [r.id for r in bad.collect()] == [2]


def test_stream_equals_batch(spark, scorer, tmp_path):
    rows = [(i, float(i % 20), float(20 - i % 20)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, f1 double, f2 double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/scored")).drop("batch")
    assert sorted(got.collect()) == sorted(score(df, scorer, True).collect())


def test_stream_of_records(spark, scorer, tmp_path):
    texts = [json.dumps({"f1": 1.0, "f2": 19.0}), "nonsense"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, record string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp"), json_col="record").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/scored")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/rejects")).count() == 1


def test_quality_stream_equals_batch(spark, small, tmp_path):
    rules = [{"name": "value", "dtype": "float", "min": 1}]
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    quality_stream(stream, rules, "ts", sink, str(tmp_path / "cp"), watermark="40 days").awaitTermination()
    want = windowed_quality(events, rules, "ts", "1 day")
    assert sorted(latest_windows(spark, sink).collect()) == sorted(want.select(*latest_windows(spark, sink).columns).collect())


def test_every_row_is_scored(spark, scorer):
    """Null ids and ids that repeat, on both ways of voting."""
    rows = [(1, 1.0, 19.0), (None, 18.0, 2.0), (7, 1.0, 19.0), (7, 18.0, 2.0)]
    df = spark.createDataFrame(rows, "id bigint, f1 double, f2 double").withColumn("prediction", F.lit("old"))
    want = [(1, 0, 0.0), (7, 0, 0.0), (7, 1, 1.0), (None, 1, 1.0)]
    for limit in (None, 0):
        from sparktab.operators import knn

        kept, scorer.model._local = knn.LOCAL_BYTES, None
        knn.LOCAL_BYTES = kept if limit is None else limit
        try:
            got = score(df, scorer, proba=True).select("id", "prediction", "prediction_proba").collect()
        finally:
            knn.LOCAL_BYTES, scorer.model._local = kept, None
        assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r)) == want


def test_small_models_move_no_rows(spark, scorer):
    df = spark.range(50).selectExpr("id", "double(id % 20) f1", "20 - double(id % 20) f2")
    plan = score(df, scorer, proba=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_saved_scorer_with_rename_and_steps(spark, tmp_path):
    config = {
        **CONFIG,
        "raw_features": ["x 1", "kind"],
        "features": {"continuous": ["x1"], "categorical": ["kind"]},
        "preprocessing": {"rename_columns": {"x 1": "x1"}, "kind": {"encoding": "ordinal"}, "outlier_columns": ["x2"]},
        "metrics": {"report": ["recall"]},
    }
    rows = twelve(spark).withColumn("kind", F.concat(F.lit("k"), F.col("x2") % 3)).withColumnRenamed("x1", "x 1")
    trained = train_stage(rows, config, "id")
    assert "recall" in trained.report.columns and "npv" not in trained.report.columns
    save_scorer(trained.scorer, str(tmp_path / "s"))
    loaded = load_scorer(spark, str(tmp_path / "s"))
    raw = rows.drop("target")
    want = sorted(score(raw, trained.scorer, proba=True).collect())
    assert sorted(score(raw, loaded, proba=True).collect()) == want and len(want) == 12
    raw.write.parquet(str(tmp_path / "in.parquet"))
    out = score_files(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"), str(tmp_path / "s"))
    assert out.count() == 12
    with pytest.raises(PreprocessError, match="x 1"):
        score(raw.drop("x 1"), loaded)
    with pytest.raises(ModelError):
        load_scorer(spark, str(tmp_path / "none"))


def test_late_rows_are_named(spark, tmp_path):
    """Batches out of order: rows seen are rows counted plus rows late; a time is missing; a closed window stays as it was."""
    batches = [
        [(1, "2024-01-01 10:00"), (2, "2024-01-03 12:00"), (None, "2024-01-03 13:00")],
        [(3, "2024-01-01 11:00"), (4, "2024-01-02 23:00"), (5, None)],
        [(None, "2024-01-01 12:00"), (7, "2024-01-06 01:00")],
        [(8, "2024-01-03 05:00"), (9, "2024-01-05 23:59"), (10, None)],
    ]
    schema, source = "value int, at string", str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).selectExpr("value", "cast(at AS timestamp_ntz) AS ts").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("value int, ts timestamp_ntz").parquet(source)
        quality_stream(stream, [{"name": "value", "dtype": "int"}], "ts", str(tmp_path / "out"), str(tmp_path / "cp"), watermark="1 day").awaitTermination()
    windows = {r.window_start.day: (r.n_rows, r.value_missing) for r in latest_windows(spark, str(tmp_path / "out")).collect()}
    late = {r.window_start and r.window_start.day: r.n_late for r in late_rows(spark, str(tmp_path / "out")).collect()}
    assert windows == {1: (1, 0), 2: (1, 0), 3: (2, 1), 5: (1, 0), 6: (1, 0)}
    assert late == {1: 2, 3: 1, None: 2}
    assert sum(n for n, _ in windows.values()) + sum(late.values()) == sum(map(len, batches))
