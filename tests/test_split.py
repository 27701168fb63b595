import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktab.operators import split as s


def two_classes(spark, n_zero, n_one):
    return spark.range(n_zero + n_one).withColumn("y", (F.col("id") >= n_zero).cast("int"))


def sizes(df):
    return {(r.split, r.y): r.n for r in df.groupBy("split", "y").agg(F.count("*").alias("n")).collect()}


def test_known_sizes(spark):
    got = sizes(s.stratified_split(two_classes(spark, 212, 357), "id", "y"))
    assert got == {
        ("train", 0): 127, ("train", 1): 214, ("valid", 0): 43,
        ("valid", 1): 71, ("test", 0): 42, ("test", 1): 72,
    }


def test_same_rows_whatever_the_partitioning(spark):
    df = two_classes(spark, 90, 400)
    first = {(r.id, r.split) for r in s.stratified_split(df, "id", "y").collect()}
    again = {(r.id, r.split) for r in s.stratified_split(df.repartition(7), "id", "y").collect()}
    assert first == again
    assert len(first) == 490


def test_cuts_fall_at_the_ranks(spark, monkeypatch):
    monkeypatch.setattr(s, "SLICE_ROWS", 20)
    df = two_classes(spark, 300, 700)
    ranked = s.rank_in_class(df, "id", "y")
    split = s.stratified_split(df, "id", "y", test=0.3, valid=0.1)
    rows = ranked.join(split.select("id", "split"), "id").collect()
    for label in (0, 1):
        of_class = sorted((r.class_rank, r.split) for r in rows if r.y == label)
        assert [rank for rank, _ in of_class] == list(range(1, len(of_class) + 1))
        order = [name for _, name in of_class]
        assert order == sorted(order, key=["test", "valid", "train"].index)


def test_hold_out_and_plain_split(spark):
    df = two_classes(spark, 50, 50)
    assert {k[0] for k in sizes(s.stratified_split(df, "id", "y", valid=0.0))} == {"test", "train"}
    plain = Counter(r.split for r in s.stratified_split(df, "id", None).collect())
    assert plain == {"test": 20, "valid": 20, "train": 60}


def test_the_split_moves_no_rows(spark, small):
    df = spark.read.parquet(f"{small}/orders.parquet")
    plan = s.stratified_split(df, "o_orderkey", "o_orderstatus")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_many_classes_give_the_same_split(spark, monkeypatch):
    df = spark.range(400).withColumn("y", (F.col("id") % 7).cast("int"))
    few = sorted(s.stratified_split(df, "id", "y").collect())
    monkeypatch.setattr(s, "SENT_CLASSES", 2)
    assert sorted(s.stratified_split(df, "id", "y").collect()) == few


def test_half_and_complement(spark):
    df = spark.range(101)
    half = s.half_sample(df, "id")
    rest = s.complement(df, half, "id")
    assert half.count() == 50 and rest.count() == 51
    assert half.join(rest, "id").count() == 0


def test_folds_are_balanced(spark):
    rows = s.kfold(two_classes(spark, 53, 202), "id", "y", 5).collect()
    per = Counter((r.fold, r.y) for r in rows)
    for label in (0, 1):
        counts = [per[fold, label] for fold in range(5)]
        assert max(counts) - min(counts) <= 1


def test_bad_requests(spark):
    df = two_classes(spark, 3, 3)
    with pytest.raises(s.SplitError):
        s.stratified_split(df, "id", "y", test=0.6, valid=0.5)
    with pytest.raises(s.SplitError):
        s.stratified_split(df.withColumn("y", F.lit(None).cast("int")), "id", "y")
    with pytest.raises(s.SplitError):
        s.kfold(df, "id", "y", 1)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.integers(1, 1000), min_size=1), st.floats(0, 1))
def test_quota_sums(counts, share):
    total = math.floor(share * sum(counts.values()))
    taken = s.quotas(counts, total)
    assert sum(taken.values()) == total
    assert all(0 <= taken[c] <= counts[c] for c in counts)


def test_union_restores_the_table(spark):
    split = s.stratified_split(two_classes(spark, 20, 30), "id", "y")
    parts = [split.where(F.col("split") == n) for n in ("train", "valid", "test")]
    assert sorted(s.union_splits(parts).collect()) == sorted(split.collect())


def test_many_classes(spark):
    df = spark.range(60_000).selectExpr("id", "id % 20000 as label")
    out = s.stratified_split(df, "id", "label", test=0.25, valid=0.25)
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"test": 15_000, "valid": 15_000, "train": 30_000}


@pytest.mark.parametrize("slice_values", [7, 100_000])
@pytest.mark.parametrize("total", [0, 1, 333, 1000])
def test_quota_table_is_quotas(spark, monkeypatch, slice_values, total):
    monkeypatch.setitem(s.running_sums.__globals__, "SLICE_VALUES", slice_values)
    counts = {i: 1 + (i * i) % 7 for i in range(250)}
    want = s.quotas(counts, total)
    table = spark.createDataFrame(list(counts.items()), "label int, n long")
    assert {r.label: r.quota for r in s.quota_table(table, total).collect()} == want


def test_quota_table_of_nothing_and_of_nulls(spark):
    table = spark.createDataFrame([("a", 0), ("b", 0)], "label string, n long")
    assert [r.quota for r in s.quota_table(table, 0).collect()] == [0, 0]
    assert s.quota_table(table.where("false"), 0).count() == 0
    with pytest.raises(s.SplitError):
        s.quota_table(spark.createDataFrame([(None, 3)], "label string, n long"), 1)


def test_split_by_table_is_the_split(spark, monkeypatch):
    monkeypatch.setattr(s, "SLICE_ROWS", 50)
    df = spark.range(900).selectExpr("id", "if(id % 3 = 0, 0, id % 97) as y")
    one = {(r.id, r.split) for r in s.stratified_split(df, "id", "y", 0.3, 0.1).collect()}
    assert {(r.id, r.split) for r in s.stratified_split_by_table(df, "id", "y", 0.3, 0.1).collect()} == one
    assert s.stratified_split_by_table(df.where("false"), "id", "y").count() == 0


def test_a_million_classes(spark):
    df = spark.range(2_000_000).selectExpr("id", "id % 1000000 as label")
    out = s.stratified_split_by_table(df, "id", "label", test=0.25, valid=0.25)
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"test": 500_000, "valid": 500_000, "train": 1_000_000}
