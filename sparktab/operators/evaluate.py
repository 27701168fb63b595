"""Binary classification metrics, curves and reports as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.plans.running import running_sums

# Accepted metric names (any case) and the metric each one means.
METRIC_NAMES = {
    "accuracy": "accuracy",
    "precision": "precision",
    "recall": "recall",
    "f1": "f1_score",
    "f1 score": "f1_score",
    "roc auc": "roc_auc",
    "specificity": "specificity",
    "npv": "npv",
    "negative predictive value": "npv",
    "confusion matrix": "confusion_matrix",
}
CONFUSION = ("tn", "fp", "fn", "tp")
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "specificity", "npv")
DEFAULT_CLASS_NAMES = ("Benign", "Malignant")

NAN = float("nan")


def resolve_metrics(names: Sequence[str] | None) -> list[str]:
    """Canonical metric names; unknown ones are left out, all are taken for None."""
    if names is None:
        return list(METRICS)
    wanted = [METRIC_NAMES.get(n.strip().lower()) for n in names]
    return [m for m in dict.fromkeys(wanted) if m in METRICS]


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _or_nan(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(NAN))


def specificity(tn: Column, fp: Column) -> Column:
    return _or_nan(tn, tn + fp)


def npv(tn: Column, fn: Column) -> Column:
    return _or_nan(tn, tn + fn)


def confusion_counts(y_true: str = "y_true", y_pred: str = "y_pred") -> list[Column]:
    """Counts of the labels 0 and 1; a class that never occurs counts 0."""
    t, p = F.col(y_true), F.col(y_pred)
    return [
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    ]


def confusion_matrix(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return preds.groupBy(*by).agg(*confusion_counts())


def ratio_metrics() -> dict[str, Column]:
    """Metrics as expressions over n, correct and the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    return {
        "accuracy": F.try_divide(F.col("correct"), F.col("n")),
        "precision": _or_zero(tp, tp + fp),
        "recall": _or_zero(tp, tp + fn),
        "f1_score": _or_zero(2 * tp, 2 * tp + fp + fn),
        "specificity": specificity(tn, fp),
        "npv": npv(tn, fn),
    }


def score_groups(preds: DataFrame, by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score: all that the curves need.

    Combined on the map side, so a score that many rows share costs one row
    per task. Rounding scores to ``digits`` is the caller's choice.
    """
    score = F.col("y_proba").cast("double")
    score = F.round(score, digits) if digits is not None else score
    usable = preds.where(F.col("y_proba").isNotNull())
    return usable.groupBy(*by, score.alias("score")).agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") == 0).alias("neg")
    )


def roc_auc(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve from mid-ranks; NaN when a class is absent."""
    groups = running_sums(score_groups(preds, by), "score", ["neg"], by)
    below = F.col("run_neg") - F.col("neg")
    totals = groups.groupBy(*by).agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("wins"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return totals.select(*by, _or_nan(F.col("wins"), pairs).alias("roc_auc"))


def _curve(preds: DataFrame, by: Sequence[str]) -> DataFrame:
    groups = running_sums(score_groups(preds, by), "score", ["pos", "neg"], by, descending=True)
    totals = groups.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    if by:
        return groups.join(totals, list(by)), totals
    row = totals.first()
    counts = [F.lit(row.n_pos).cast("bigint").alias("n_pos"), F.lit(row.n_neg).cast("bigint").alias("n_neg")]
    return groups.select("*", *counts), totals


def roc_curve(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points (fpr, tpr) for every distinct score, and (0, 0) at no threshold."""
    points, totals = _curve(preds, by)
    fpr = _or_nan(F.col("run_neg"), F.col("n_neg"))
    tpr = _or_nan(F.col("run_pos"), F.col("n_pos"))
    points = points.select(*by, F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    start = totals.select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def pr_curve(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points (recall, precision) for every distinct score, and (0, 1) at no threshold."""
    points, totals = _curve(preds, by)
    precision = _or_zero(F.col("run_pos"), F.col("run_pos") + F.col("run_neg"))
    recall = F.coalesce(F.try_divide(F.col("run_pos"), F.col("n_pos")), F.lit(1.0))
    points = points.select(
        *by, F.col("score").alias("threshold"), recall.alias("recall"), precision.alias("precision")
    )
    start = totals.select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"),
    )
    return points.unionByName(start)


def classification_report(
    preds: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] | None = None
) -> DataFrame:
    """Confusion counts, always, and the chosen metrics, per group.

    ``preds`` has ``y_true``, ``y_pred`` and, for ROC AUC, ``y_proba``; without
    it the area is NaN. All groups come from one aggregation.
    """
    chosen = resolve_metrics(metrics)
    by = list(by)
    correct = F.count_if(F.col("y_true") == F.col("y_pred")).alias("correct")
    counts = preds.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), correct, *confusion_counts())
    ratios = ratio_metrics()
    area = F.lit(NAN).alias("roc_auc")
    if "roc_auc" in chosen and "y_proba" in preds.columns:
        areas = roc_auc(preds, by)
        if by:
            same = None
            for c in by:
                part = F.col(f"counts.{c}").eqNullSafe(F.col(f"areas.{c}"))
                same = part if same is None else same & part
            joined = counts.alias("counts").join(areas.alias("areas"), same, "left")
            counts = joined.select("counts.*", "areas.roc_auc")
        else:
            value = areas.first()
            counts = counts.withColumn("roc_auc", F.lit(value.roc_auc if value else None).cast("double"))
        area = F.coalesce(F.col("roc_auc"), F.lit(NAN)).alias("roc_auc")
    picked = [area if m == "roc_auc" else ratios[m].alias(m) for m in chosen]
    return counts.select(*by, "n", *CONFUSION, *picked)


def as_nested(report: DataFrame) -> DataFrame:
    """The four counts as one struct column ``confusion_matrix``."""
    rest = [c for c in report.columns if c not in CONFUSION]
    return report.select(*rest, F.struct(*CONFUSION).alias("confusion_matrix"))


def round_numbers(df: DataFrame, digits: int = 3) -> DataFrame:
    """Round floating columns, inside structs too; other columns stay as they are."""

    def rounded(value: Column, data_type: T.DataType) -> Column:
        if isinstance(data_type, (T.DoubleType, T.FloatType)):
            return F.round(value, digits)
        if isinstance(data_type, T.StructType):
            return F.struct(*[rounded(value[f.name], f.dataType).alias(f.name) for f in data_type])
        return value

    return df.select(*[rounded(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def metrics_long(report: DataFrame, split_col: str = "split") -> DataFrame:
    """One row per split and metric, named ``split/metric``; the matrix is left out."""
    names = [m for m in report.columns if m in METRICS]
    long = report.unpivot([split_col], names, "metric", "value")
    return long.select(F.concat_ws("/", split_col, "metric").alias("name"), split_col, "metric", "value")


def prediction_detail(
    preds: DataFrame, id_col: str, class_names: Sequence[str] | None = DEFAULT_CLASS_NAMES
) -> DataFrame:
    """True label, prediction and probability per row id, with class names if given."""
    columns = [F.col(c) for c in (id_col, "split", "y_true", "y_pred", "y_proba") if c in preds.columns]
    if class_names:
        names = F.array(*[F.lit(n) for n in class_names])
        columns += [
            F.get(names, F.col("y_true").cast("int")).alias("true_name"),
            F.get(names, F.col("y_pred").cast("int")).alias("pred_name"),
        ]
    return preds.select(*columns)
