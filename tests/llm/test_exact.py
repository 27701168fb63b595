"""Exact dedup against plain grouping, and the index over deliveries, retries and sessions."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sparktab.llm import exact
from sparktab.llm.exact import DigestIndex, drop_copies, exact_dedup, exact_groups, text_digest
from sparktab.llm.queries import ORACLES, QUERIES
from sparktab.session import scratch_path
from tests.compare import connect, difference


def plain(rows):
    """(id, keep_id, size, digest) of every (id, text)."""
    groups = {}
    for key, text in rows:
        groups.setdefault(sha256((text or "").encode()).digest(), []).append(key)
    keep = {d: max((k for k in g if k is not None), default=None) for d, g in groups.items()}
    return sorted(((k, keep[d], len(groups[d]), d) for k, t in rows for d in [sha256((t or "").encode()).digest()]), key=repr)


def prints_of(df, delivery="all"):
    return df.select(text_digest("text").alias("digest"), F.lit(delivery).alias("delivery"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))


def test_same_as_sql(spark, small):
    assert difference(QUERIES["op13_exact_dedup"](spark, small), connect(small), ORACLES["op13_exact_dedup"]) is None


@pytest.mark.parametrize("deliveries", [1, 2, 5])
def test_odd_rows(spark, odd, deliveries):
    got = exact_dedup(odd, deliveries=deliveries).collect()
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(((r.id, r.keep_id, r.group_size, bytes(r.digest)) for r in got), key=repr) == want
    kept = [bytes(r.digest) for r in got if r.kept]
    assert sorted(kept) == sorted({w[3] for w in want})
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_empty_table(none):
    assert exact_dedup(none).columns == ["id", "keep_id", "group_size", "kept", "digest"]
    assert exact_dedup(none).count() == 0
    assert drop_copies(none).count() == 0


def test_hot_and_cold_groups(spark):
    """A third of all rows equal, groups of every size around the bound that separates the two ways."""
    sizes = [400, *range(1, 40), exact.LEAST_HOT - 1, exact.LEAST_HOT, exact.LEAST_HOT + 1]
    rows = [(i * 1000 + j, f"text {i}") for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup(df).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, bytes(r.digest)) for r in got), key=repr) == plain(rows)
    assert sum(r.kept for r in got) == len(sizes)


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", "y")], "doc_id string, text string")
    got = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()}
    assert got == {("b", "b", 3, True), ("a", "b", 3, False), (None, "b", 3, False), ("c", "c", 1, True)}


def test_later_deliveries(spark):
    """An index keeps what it has; a delivery twice counts once; a new session's index reads the same folder."""
    path = scratch_path(spark, "digests")
    index = DigestIndex.open(spark, path, buckets=3)
    first = prints_of(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string"), "monday")
    later = prints_of(spark.createDataFrame([(9, "a"), (8, "c"), (7, "c")], "doc_id long, text string"), "tuesday")
    index.add(first, "monday")
    index.add(later, "tuesday")
    index.add(later, "tuesday")
    spark.sql(f"DROP TABLE {index.name}")
    again = DigestIndex.open(spark, path)
    assert again.buckets == 3
    found = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_groups(first.unionByName(later), again).collect()}
    assert found == {1: (2, 3, False), 2: (2, 3, True), 3: (3, 1, True), 9: (2, 3, False), 8: (8, 2, True), 7: (8, 2, False)}


def test_half_written_delivery(spark):
    """Rows of an attempt that was never marked complete are not read."""
    index = DigestIndex.open(spark, scratch_path(spark, "digests"), buckets=2)
    lost = spark.createDataFrame([(bytearray(sha256(b"a").digest()), "monday/dead", 1, 1, 1)], "digest binary, delivery string, id long, row long, n long")
    lost.write.mode("append").format("parquet").bucketBy(2, "digest").sortBy("digest").option("path", f"{index.path}/entries").saveAsTable(index.name)
    assert index.entries().count() == 0
    index.add(prints_of(spark.createDataFrame([(5, "a")], "doc_id long, text string"), "monday"), "monday")
    assert [(r.keep_id, r.group_size) for r in index.digests().collect()] == [(5, 1)]


def test_index_is_not_shuffled(spark):
    """The anti join reads the buckets as they are."""
    index = DigestIndex.open(spark, scratch_path(spark, "digests"), buckets=4)
    index.add(prints_of(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")), "all")
    new = prints_of(spark.createDataFrame([(3, "b"), (4, "c")], "doc_id long, text string")).repartition(4, "digest")
    joined = new.hint("merge").join(index.digests().select("digest"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert [r.id for r in joined.collect()] == [4]


def test_drop_copies(odd):
    out = drop_copies(odd)
    assert out.columns == odd.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 4, 5, 6]
