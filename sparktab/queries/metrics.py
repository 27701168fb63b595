"""Binary metrics and curves, on kNN predictions and on scores with many distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators import evaluate as e
from sparktab.operators.knn import train_model
from sparktab.operators.split import stratified_split
from sparktab.plans.stages import predictions_of
from sparktab.queries.registry import query, table
from sparktab.queries.sql import COUNTS, auc_ctes, report_ctes, scored_ctes

PREDS = scored_ctes()
RATIOS = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "specificity", "npv")


def binary_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings with the ten labels folded into two classes."""
    embeddings = table(spark, folder, "embeddings")
    return embeddings.withColumn("label", (F.col("label") < 5).cast("int"))


def knn_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Every row scored by a model of the training split."""
    split = stratified_split(binary_embeddings(spark, folder), "vec_id", "label")
    model = train_model(split.where(F.col("split") == "train"), "vec_id", "embedding", "label")
    return predictions_of(model, split, "label")


# Labelled documents, scored by their length: nearly every score is distinct.
LENGTHS = """preds AS (
  SELECT doc_id, lang, quality AS y_true, n_chars / (n_chars + 1000.0::DOUBLE) AS y_proba,
    (n_chars / (n_chars + 1000.0::DOUBLE) >= 0.5)::INTEGER AS y_pred
  FROM documents JOIN labels USING (doc_id))"""


def length_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    share = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    scored = documents.join(table(spark, folder, "labels"), "doc_id")
    return scored.select(
        "doc_id",
        "lang",
        F.col("quality").alias("y_true"),
        share.alias("y_proba"),
        (share >= 0.5).cast("int").alias("y_pred"),
    )


def _rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in RATIOS)


@query(f"WITH {LENGTHS}, counted AS (SELECT lang, {COUNTS} FROM preds GROUP BY ALL) SELECT * EXCLUDE (n) FROM counted")
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return e.confusion_matrix(length_scores(spark, folder), ["lang"])


@query(f"WITH {LENGTHS}, whole AS (SELECT *, 1 AS one FROM preds), counted AS (SELECT {COUNTS} FROM preds),"
    f"""{auc_ctes("whole", "one")}
    SELECT n, tn, fp, fn, tp, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
      round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score,
      round(roc_auc, 6) AS roc_auc, round(tn / (tn + fp), 6) AS specificity, round(tn / (tn + fn), 6) AS npv
    FROM counted, areas"""
)
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(e.classification_report(length_scores(spark, folder)), RATIOS)


@query(f"""WITH {LENGTHS}, {auc_ctes("preds", "lang")} SELECT lang, round(roc_auc, 6) AS roc_auc FROM areas""")
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(e.roc_auc(length_scores(spark, folder), ["lang"]), ["roc_auc"])


CURVE = f"""WITH {LENGTHS},
  score_n AS (
    SELECT lang, y_proba AS score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg
    FROM preds GROUP BY ALL),
  run AS (
    SELECT lang, score, sum(pos) OVER w AS pos, sum(neg) OVER w AS neg,
      sum(pos) OVER (PARTITION BY lang) AS n_pos, sum(neg) OVER (PARTITION BY lang) AS n_neg
    FROM score_n WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    f"""{CURVE}
    SELECT lang, round(score, 9) AS threshold, round(neg / n_neg, 6) AS fpr, round(pos / n_pos, 6) AS tpr FROM run
    UNION ALL SELECT DISTINCT lang, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM preds"""
)
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    out = e.roc_curve(length_scores(spark, folder), ["lang"])
    return _rounded(out, ["fpr", "tpr"]).withColumn("threshold", F.round("threshold", 9))


@query(
    f"""{CURVE}
    SELECT lang, round(score, 9) AS threshold, round(pos / n_pos, 6) AS recall,
      round(pos / (pos + neg), 6) AS precision FROM run
    UNION ALL SELECT DISTINCT lang, NULL::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE FROM preds"""
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    out = e.pr_curve(length_scores(spark, folder), ["lang"])
    return _rounded(out, ["recall", "precision"]).withColumn("threshold", F.round("threshold", 9))


@query(
    f"""{PREDS}, {report_ctes()}
    SELECT split, n, tn, fp, fn, tp, round(npv, 6) AS npv, round(f1_score, 6) AS f1_score,
      round(roc_auc, 6) AS roc_auc FROM report"""
)
def metric_selection(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["Negative Predictive Value", "F1", "roc auc", "no such metric", "npv"]
    report = e.classification_report(knn_predictions(spark, folder), ["split"], wanted)
    return _rounded(report, ["npv", "f1_score", "roc_auc"])


@query(f"""{PREDS}, {report_ctes()} SELECT split, n, tn, fp, fn, tp, {ROUNDED} FROM report""")
def metrics_by_split(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(e.classification_report(knn_predictions(spark, folder), ["split"]), RATIOS)


@query(
    f"""{PREDS}
    SELECT vec_id, split, y_true, y_pred, round(y_proba, 6) AS y_proba,
      CASE y_true WHEN 1 THEN 'Malignant' ELSE 'Benign' END AS true_name,
      CASE y_pred WHEN 1 THEN 'Malignant' ELSE 'Benign' END AS pred_name FROM preds"""
)
def prediction_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(e.prediction_detail(knn_predictions(spark, folder), "vec_id"), ["y_proba"])


@query(
    f"""{PREDS}, {report_ctes()}
    SELECT split, n, tn, fp, fn, tp, {", ".join(f"round({m}, 3) AS {m}" for m in RATIOS)} FROM report"""
)
def metrics_rounded(spark: SparkSession, folder: str) -> DataFrame:
    """Rounded with the counts nested, as they are stored, then flat for the comparison."""
    report = e.classification_report(knn_predictions(spark, folder), ["split"])
    nested = e.round_numbers(e.as_nested(report), 3)
    return nested.select("split", "n", "confusion_matrix.*", *RATIOS)


@query(
    f"""{PREDS}, {report_ctes()}
    SELECT split || '/' || metric AS name, split, metric, round(value, 6) AS value
    FROM (UNPIVOT (SELECT split, {", ".join(RATIOS)} FROM report) ON {", ".join(RATIOS)} INTO NAME metric VALUE value)"""
)
def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(e.metrics_long(e.classification_report(knn_predictions(spark, folder), ["split"])), ["value"])
