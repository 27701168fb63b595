"""Quantile sketches within their error of the exact quantiles, merged over parts; and the preprocessor that asks for them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators.preprocess import Branch, Preprocessor, definition, from_definition
from sparktab.plans.sketches import merge_sketches, quantile_sketches, rank_error, sketch_quantiles, sketched_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def skewed(spark, n=60_000):
    """A third of all values equal, some missing, a long tail."""
    x = F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 101 == 0, F.lit(None)).when(F.col("id") % 103 == 0, float("nan")).otherwise(F.exp((F.col("id") * 7919 % 10007) / 1000.0))
    return spark.range(n).select((F.col("id") % 5).alias("day"), x.alias("x")).repartition(6)


def off(found, values):
    """How far each result lies from the ranks that have its value, as a share."""
    values = np.sort(values)
    n = len(values)
    low, high = np.searchsorted(values, found, "left") / n, np.searchsorted(values, found, "right") / n
    return np.maximum(0, np.maximum(low - SHARES, SHARES - high))


@pytest.mark.parametrize("k", [200, 800])
def test_within_the_error(spark, k):
    df = skewed(spark)
    values = np.array([r.x for r in df.where("x is not null and not isnan(x)").collect()])
    found = sketched_quantiles(df, {"x": F.col("x")}, SHARES, k)["x"]
    assert off(found, values).max() <= rank_error(k)
    assert found[0] == values.min() and found[-1] == values.max()


def test_merged_over_days(spark):
    df = skewed(spark)
    values = np.array([r.x for r in df.where("x is not null and not isnan(x)").collect()])
    days = quantile_sketches(df, {"x": F.col("x")}, ["day"])
    assert days.count() == 5
    row = merge_sketches(days, ["x"]).select(sketch_quantiles(F.col("x"), SHARES).alias("q"), F.kll_sketch_get_n_double("x").alias("n")).first()
    assert row.n == len(values) and off(row.q, values).max() <= rank_error()


def test_few_and_no_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (2.0, None), (None, None)], "a double, b double")
    assert sketched_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.0, 0.5, 1.0]) == {"a": [1.0, 2.0, 3.0], "b": None}
    assert sketched_quantiles(df.where("false"), {"a": F.col("a")}, [0.5]) == {"a": None}


def test_preprocessor_asks_for_sketches(spark):
    df = skewed(spark)
    branches = [Branch("x", "numeric", impute="median", bins=4)]
    exact, close = Preprocessor(branches), Preprocessor(branches, quantile_sketch=800)
    want, got = exact.fit(df), close.fit(df)
    values = np.array([r.x if r.x is not None and r.x == r.x else want["impute"]["x"] for r in df.collect()])
    for a, b in zip(got["edges"]["x"], want["edges"]["x"], strict=True):
        assert abs((values <= a).mean() - (values <= b).mean()) <= 2 * rank_error() or a == b
    assert from_definition(definition(close)).quantile_sketch == 800
