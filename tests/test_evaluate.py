import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import evaluate as e
from sparktab.plans.running import running_sums

SCHEMA = "y_true int, y_pred int, y_proba double"


def test_all_metrics(spark):
    df = spark.createDataFrame([(0, 0, 0.5), (1, 0, 0.5), (1, 0, 0.5), (0, 0, 0.5)], SCHEMA)
    row = e.classification_report(df).first()
    assert row.accuracy == 0.5 and row.roc_auc == 0.5
    assert row.precision == row.recall == row.f1_score == 0.0
    assert row.specificity == 1.0 and row.npv == 0.5
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 0, 2, 0)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0, 0.1)] * 3, SCHEMA)
    row = e.classification_report(df).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (0, 0, 3, 0)
    assert math.isnan(row.roc_auc) and math.isnan(row.specificity)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (5, 0), (3, 1)], "tn int, x int")
    values = [r[0] for r in df.select(e.specificity(F.col("tn"), F.col("x"))).collect()]
    assert math.isnan(values[0]) and values[1:] == [1.0, 0.75]
    values = [r[0] for r in df.select(e.npv(F.col("tn"), F.col("x"))).collect()]
    assert math.isnan(values[0]) and values[1:] == [1.0, 0.75]


def test_no_probability(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "y_true int, y_pred int")
    assert math.isnan(e.classification_report(df).first().roc_auc)


def test_metric_names():
    assert e.resolve_metrics([" F1 ", "npv", "Negative Predictive Value", "bogus"]) == ["f1_score", "npv"]
    assert e.resolve_metrics([]) == []


def scores(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.where(rng.random(n) < 0.33, 0.5, np.round(rng.random(n) * 0.7 + 0.3 * y * rng.random(n), 3))
    return [(int(a), int(b >= 0.5), float(b)) for a, b in zip(y, p, strict=True)]


def test_auc_against_pairs(spark):
    rows = scores()
    pos = np.array([p for y, _, p in rows if y == 1])
    neg = np.array([p for y, _, p in rows if y == 0])
    want = ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())
    assert e.roc_auc(spark.createDataFrame(rows, SCHEMA)).first().roc_auc == pytest.approx(want)


def test_curves(spark):
    df = spark.createDataFrame(scores(), SCHEMA)
    points = sorted((r.fpr, r.tpr) for r in e.roc_curve(df).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    fpr, tpr = np.array(points).T
    assert np.trapezoid(tpr, fpr) == pytest.approx(e.roc_auc(df).first().roc_auc)
    pr = e.pr_curve(df).collect()
    assert any((r.recall, r.precision) == (0.0, 1.0) for r in pr)
    assert max(r.recall for r in pr) == 1.0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_sums_over_slices(spark, by, descending):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), (F.col("id") / 7).alias("x"), (F.col("id") % 5).alias("n"))
    plain = running_sums(df, "x", ["n"], by, descending)
    sliced = running_sums(df, "x", ["n"], by, descending, slice_values=20)
    assert sorted(plain.collect()) == sorted(sliced.collect())


def test_report_per_split_and_long_form(spark):
    rows = [("train", 0, 0, 0.1), ("train", 1, 1, 0.9), ("test", 1, 0, 0.4), ("test", 0, 0, 0.3)]
    df = spark.createDataFrame(rows, "split string, y_true int, y_pred int, y_proba double")
    report = e.classification_report(df, ["split"], ["accuracy", "roc auc"])
    assert {r.split: r.accuracy for r in report.collect()} == {"train": 1.0, "test": 0.5}
    long = {r.name: r.value for r in e.metrics_long(report).collect()}
    assert long == {"train/accuracy": 1.0, "test/accuracy": 0.5, "train/roc_auc": 1.0, "test/roc_auc": 1.0}


def test_empty_input_gives_an_empty_report(spark):
    df = spark.createDataFrame([], "split string, y_true int, y_pred int, y_proba double")
    assert e.classification_report(df, ["split"]).count() == 0


def test_rounding_is_nested(spark):
    df = spark.createDataFrame([(1.23456, "a", (0.98765, 3), [1.23456])], "x double, s string, t struct<u:double,n:int>, l array<double>")
    row = e.round_numbers(df, 2).first()
    assert (row.x, row.s, tuple(row.t), row.l) == (1.23, "a", (0.99, 3), [1.23456])


def test_detail_names(spark):
    df = spark.createDataFrame([(7, 0, 1, 0.7)], "id int, y_true int, y_pred int, y_proba double")
    row = e.prediction_detail(df, "id").first()
    assert (row.true_name, row.pred_name) == ("Benign", "Malignant")
    assert "true_name" not in e.prediction_detail(df, "id", None).columns
