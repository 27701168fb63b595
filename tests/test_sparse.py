"""Sparse one-hot against the dense encoder and dense distances; many categories without rows on the driver."""

import math

import pytest
from pyspark.sql import functions as F

from sparktab.functions.distance import distance
from sparktab.operators import sparse
from sparktab.operators.preprocess import Branch, PreprocessError, Preprocessor
from sparktab.operators.sparse import fit_sparse, sparse_distance, to_dense, to_sparse

ROWS = [(1, "b", 3, 0.5), (2, "a", None, 1.5), (3, None, 7, -2.0), (4, "b", 7, 0.0), (5, "zz", 9, 4.0)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id int, kind string, shop int, size double")


@pytest.mark.parametrize("learn", ["id < 5", "id IN (1, 4)", "id > 0"])
def test_same_as_dense(spark, learn):
    df = table(spark)
    codes = fit_sparse(df.where(learn), ["kind", "shop"], ["size"])
    plan = Preprocessor([Branch("size", "numeric"), Branch("kind", "category", encoding="onehot"), Branch("shop", "category", encoding="onehot")])
    params = plan.fit(df.where(learn))
    names = plan.output_names(params)
    assert codes.size == len(names)
    want = {r.id: [r[n] for n in names] for r in plan.transform(df, params, ["id"]).collect()}
    got = to_sparse(df, codes, keep=["id"]).withColumn("dense", to_dense(F.col("features"), codes)).collect()
    assert {r.id: r.dense for r in got} == want
    assert all(r.features.indices == sorted(set(r.features.indices)) for r in got)


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "minkowski"])
def test_distances_are_those_of_dense_vectors(spark, metric):
    df = table(spark)
    codes = fit_sparse(df.where("id < 4"), ["kind", "shop"], ["size"])
    rows = to_sparse(df, codes, "v", ["id"]).withColumn("d", to_dense(F.col("v"), codes))
    pairs = rows.join(rows.select(F.col("id").alias("other"), F.col("v").alias("w"), F.col("d").alias("e")))
    for r in pairs.select(sparse_distance(F.col("v"), F.col("w"), metric).alias("got"), distance(F.col("d"), F.col("e"), metric).alias("want")).collect():
        assert r.got == pytest.approx(r.want, abs=1e-12)


def test_without_entries(spark):
    df = table(spark, [(1, "new", 1, 0.0)])
    codes = fit_sparse(table(spark), ["kind"])
    row = to_sparse(df, codes, "v").withColumn("d", sparse_distance(F.col("v"), F.col("v"), "cosine")).first()
    assert (row.v.indices, row.v["values"], row.d) == ([], [], 1.0)
    assert to_sparse(df.where("false"), codes).count() == 0
    empty = fit_sparse(df.where("false"), ["kind", "shop"], ["size"])
    assert empty.size == 1 and to_sparse(df, empty, "v").first().v.indices == [0]


def test_errors(spark):
    df = table(spark)
    with pytest.raises(PreprocessError, match="none"):
        fit_sparse(df, ["none"])
    with pytest.raises(ValueError):
        sparse_distance(F.lit(1), F.lit(1), "hamming")
    with pytest.raises(PreprocessError, match="too many"):
        to_dense(F.col("v"), fit_sparse(df, ["kind", "shop"]), most=2)


def test_a_million_categories(spark, monkeypatch):
    """Codes are a table ranked in slices; only counts reach the driver."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    df = spark.range(1_000_000).select("id", F.concat(F.lit("c"), F.lpad(((F.col("id") * 7919) % 1_000_000).cast("string"), 7, "0")).alias("kind"))
    taken, collect = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: taken.append(collect(self)) or taken[-1])
    codes = fit_sparse(df, ["kind"])
    assert codes.size == 1_000_000 and max(map(len, taken), default=0) < 1000
    out = to_sparse(df, codes, "v", ["id"])
    off = out.where((F.size("v.indices") != 1) | (F.col("v.indices")[0] != (F.col("id") * 7919) % 1_000_000))
    assert off.count() == 0 and not math.isnan(codes.columns[0].first)
    assert sparse.SparseCodes((), codes.columns).size == 1_000_000
