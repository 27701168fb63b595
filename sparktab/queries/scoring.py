"""Scoring of tables, files, JSON records and streams, and the three stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators import score as s
from sparktab.operators.knn import train_model
from sparktab.operators.preprocess import array_to_columns as to_columns
from sparktab.operators.preprocess import columns_to_array
from sparktab.operators.split import stratified_split
from sparktab.plans.stages import data_stage, infer_stage, train_stage
from sparktab.queries.metrics import RATIOS, ROUNDED, binary_embeddings
from sparktab.queries.registry import query, table
from sparktab.queries.sql import BINARY, neighbour_ctes, report_ctes, scored_ctes, split_ctes, vectors, vote_ctes
from sparktab.session import materialize, scratch_path
from sparktab.sources.readers import read_table
from sparktab.sources.writers import write_predictions
from sparktab.streaming.quality import distinct_stream, late_rows, latest_windows, quality_stream
from sparktab.streaming.score import score_stream, start

DIMS = 64
FEATURES = [f"f{i}" for i in range(DIMS)]

SCORED = scored_ctes()


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """Id, 64 named feature columns and a binary target."""
    rows = binary_embeddings(spark, folder)
    vector = F.col("embedding").cast("array<double>")
    return to_columns(rows.withColumn("embedding", vector), "embedding", FEATURES)


def make_scorer(rows: DataFrame, split: DataFrame | None = None) -> s.Scorer:
    """A model of the training split of a feature table."""
    split = stratified_split(rows, "vec_id", "label") if split is None else split
    train = columns_to_array(split.where(F.col("split") == "train"), FEATURES, "features")
    return s.Scorer(train_model(train, "vec_id", "features", "label"), FEATURES)


FEATURE_LIST = ", ".join(f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(DIMS))


@query(f"SELECT vec_id, label, {FEATURE_LIST} FROM embeddings")
def array_to_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    vector = F.col("embedding").cast("array<double>")
    return to_columns(rows.withColumn("embedding", vector), "embedding", FEATURES)


@query(
    f"""{SCORED} SELECT vec_id, y_true AS label, split, y_pred AS prediction,
      round(y_proba, 6) AS prediction_proba FROM preds"""
)
def score_append(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(stratified_split(feature_table(spark, folder), "vec_id", "label"), "split")
    out = s.score(split, make_scorer(split, split), proba=True)
    return out.drop(*FEATURES).withColumn("prediction_proba", F.round("prediction_proba", 6))


@query(
    f"""{SCORED} SELECT vec_id, CASE WHEN vec_id % 7 < 2 THEN 'rejected' ELSE 'scored' END AS outcome,
      CASE WHEN vec_id % 7 > 1 THEN y_pred END AS prediction, CASE WHEN vec_id % 7 > 1 THEN round(y_proba, 6) END AS prediction_proba,
      CASE vec_id % 7 WHEN 0 THEN 'f3' WHEN 1 THEN 'f0,f63' END AS missing_features FROM preds"""
)
def score_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """By id some rows lack a feature, some hold NaN in one and infinity in another; they are set aside and named."""
    rows = feature_table(spark, folder)
    gaps = rows.withColumns(
        {
            "f3": F.when(F.col("vec_id") % 7 != 0, F.col("f3")),
            "f0": F.when(F.col("vec_id") % 7 == 1, F.lit(float("nan"))).otherwise(F.col("f0")),
            "f63": F.when(F.col("vec_id") % 7 == 1, F.lit(float("-inf"))).otherwise(F.col("f63")),
        }
    )
    good, bad = s.score_or_reject(gaps, make_scorer(rows), proba=True)
    good = good.select("vec_id", F.lit("scored").alias("outcome"), "prediction", F.round("prediction_proba", 6).alias("prediction_proba"), F.lit(None).cast("string").alias("missing_features"))
    none = [F.lit(None).cast("int").alias("prediction"), F.lit(None).cast("double").alias("prediction_proba")]
    return good.unionByName(bad.select("vec_id", F.lit("rejected").alias("outcome"), *none, F.concat_ws(",", "missing_features").alias("missing_features")))


@query(
    f"""{SCORED} SELECT count(*)::BIGINT AS n_predictions, round(avg(y_proba), 6) AS proba_mean,
      round(min(y_proba), 6) AS proba_min, round(max(y_proba), 6) AS proba_max FROM preds"""
)
def prediction_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder)
    out = s.prediction_summary(s.score(rows, make_scorer(rows), proba=True))
    return out.withColumns({c: F.round(c, 6) for c in ("proba_mean", "proba_min", "proba_max")})


@query(f"""{SCORED} SELECT vec_id, 1 - y_proba AS class_0, y_proba AS class_1, y_pred AS prediction FROM preds""")
def predictions_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder)
    path = scratch_path(spark, "predictions")
    write_predictions(make_scorer(rows).predict(rows, proba=True), path, "vec_id")
    return read_table(spark, path, "parquet").withColumns({c: F.round(c, 6) for c in ("class_0", "class_1")})


@query(f"""{SCORED} SELECT vec_id, y_pred AS prediction FROM preds""")
def batch_inference(spark: SparkSession, folder: str) -> DataFrame:
    """A file under the raw names, scored by a stored scorer that renames them."""
    rows = feature_table(spark, folder)
    source, sink = f"{scratch_path(spark, 'input')}.csv", scratch_path(spark, "output")
    scorer = make_scorer(rows)
    scorer.features, scorer.rename = ["first", *FEATURES[1:]], {"first": "f0"}
    stored = scratch_path(spark, "scorer")
    s.save_scorer(scorer, stored)
    features = rows.drop("label").withColumnRenamed("f0", "first")
    features.write.option("header", True).csv(source)
    return s.score_files(spark, source, sink, stored, schema=features.schema)


def _records(rows: DataFrame) -> DataFrame:
    """Rows as JSON records; by id some lack the first field or hold text in it."""
    rest = ", ".join(f"'{c}', {c}" for c in FEATURES[1:])
    return rows.selectExpr(
        "vec_id",
        f"""case vec_id % 10 when 0 then to_json(named_struct({rest}))
          when 1 then to_json(named_struct('f0', 'none', {rest}))
          else to_json(named_struct('f0', f0, {rest})) end as record""",
    )


@query(
    f"""{SCORED} SELECT vec_id, CASE WHEN vec_id % 10 > 1 THEN 'scored' ELSE 'rejected' END AS outcome,
      CASE WHEN vec_id % 10 > 1 THEN y_pred END AS prediction,
      CASE WHEN vec_id % 10 > 1 THEN round(y_proba, 6) END AS probability FROM preds"""
)
def score_json_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder)
    good, bad = s.score_json(_records(rows), "record", make_scorer(rows))
    good = good.select("vec_id", F.lit("scored").alias("outcome"), "prediction", F.round("probability", 6).alias("probability"))
    none = [F.lit(None).cast("int").alias("prediction"), F.lit(None).cast("double").alias("probability")]
    return good.unionByName(bad.select("vec_id", F.lit("rejected").alias("outcome"), *none))


@query(f"""{SCORED} SELECT vec_id, y_pred AS prediction, round(y_proba, 6) AS prediction_proba FROM preds""")
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder)
    arriving = materialize(rows.repartition(3, "vec_id"), "arriving")
    scorer = make_scorer(rows)
    stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 2).parquet(_folder_of(arriving))
    sink, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    score_stream(stream, scorer, sink, checkpoint).awaitTermination()
    scored = spark.read.parquet(f"{sink}/scored")
    return scored.select("vec_id", "prediction", F.round("prediction_proba", 6).alias("prediction_proba"))


def _folder_of(stored: DataFrame) -> str:
    """The folder of a table read from files."""
    return stored.inputFiles()[0].rsplit("/", 1)[0]


EVENT_RULES = [
    {"name": "value", "dtype": "float", "required": True, "min": 1, "max": 100},
    {"name": "event_type", "dtype": "str", "allowed_values": ["click", "purchase", "signup", "view"]},
]


@query(
    """WITH gaps AS (
      SELECT ts, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events)
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
      count(*)::BIGINT AS n_rows, count(*) FILTER (value IS NULL)::BIGINT AS value_missing,
      count(*) FILTER (value < 1)::BIGINT AS value_below_min, count(*) FILTER (value > 100)::BIGINT AS value_above_max,
      count(*) FILTER (event_type IS NULL)::BIGINT AS event_type_missing,
      count(*) FILTER (event_type NOT IN ('click', 'purchase', 'signup', 'view'))::BIGINT AS event_type_invalid
    FROM gaps GROUP BY ALL"""
)
def stream_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in four files whose times overlap, one file a batch; rows may be as late as the month is long."""
    events = table(spark, folder, "events")
    arriving = materialize(events.repartition(4, F.xxhash64("event_id")), "events")
    stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(_folder_of(arriving))
    stream = stream.withColumn("value", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    sink, checkpoint = scratch_path(spark, "quality"), scratch_path(spark, "progress")
    quality_stream(stream, EVENT_RULES, "ts", sink, checkpoint, watermark="60 days").awaitTermination()
    return latest_windows(spark, sink)


@query(
    """WITH firsts AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch FROM events),
    ends AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end FROM firsts),
    mark AS (SELECT max(ts) - INTERVAL 12 DAY AS water FROM firsts WHERE batch = 0),
    judged AS (SELECT window_end, batch = 1 AND window_end <= water AS late FROM ends, mark)
    SELECT window_end::TIMESTAMP AS window_end, count(*) FILTER (NOT late)::BIGINT AS n_rows, count(*) FILTER (late)::BIGINT AS n_late
    FROM judged GROUP BY ALL"""
)
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two thirds of the events come first, the others after them: those of days closed by then are named late, and none is lost."""
    events, path = table(spark, folder, "events"), scratch_path(spark, "events")
    sink, checkpoint = scratch_path(spark, "quality"), scratch_path(spark, "progress")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.where(part).write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.schema).parquet(path)
        quality_stream(stream, EVENT_RULES, "ts", sink, checkpoint, watermark="12 days").awaitTermination()
    both = latest_windows(spark, sink).join(late_rows(spark, sink), ["window_start", "window_end"], "full")
    return both.select("window_end", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_late", F.lit(0)).alias("n_late"))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats of a user and event type are dropped within a watermark longer than the data."""
    stream = distinct_stream(_event_stream(spark, folder), ["user_id", "event_type"], "ts", "400 days")
    sink, checkpoint = scratch_path(spark, "distinct"), scratch_path(spark, "progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("user_id", "event_type").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    start(stream, write, checkpoint, "append").awaitTermination()
    return spark.read.parquet(f"{sink}/batch=*").select("user_id", "event_type")


CUSTOMER_RULES = [
    {"name": "c_custkey", "dtype": "int", "required": True, "min": 1},
    {"name": "c_name", "dtype": "str", "required": True},
    {"name": "c_nationkey", "dtype": "int", "required": True, "min": 0, "max": 24},
    {"name": "c_acctbal", "dtype": "float", "required": False, "min": 0},
    {"name": "c_mktsegment", "dtype": "str", "required": True},
]


@query(
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""
)
def stage_data(spark: SparkSession, folder: str) -> DataFrame:
    """Load a CSV by the rule schema, validate with a warning policy, hand on the table."""
    path = scratch_path(spark, "customer")
    table(spark, folder, "customer").write.option("header", True).csv(path)
    config = {
        "data_source": {"raw_path": path, "type": "csv", "header": 0, "encoding": "utf-8"},
        "schema_from_rules": True,
        "data_validation": {
            "action_on_error": "warn",
            "report_path": scratch_path(spark, "report"),
            "schema": {"columns": CUSTOMER_RULES},
        },
    }
    return data_stage(spark, config)


TRAIN_CONFIG = {
    "target": "label",
    "raw_features": FEATURES,
    "metrics": {"report": ["accuracy", "precision", "recall", "F1 score", "ROC AUC", "specificity", "npv"]},
    "preprocessing": {"rename_columns": {"d1": "f1"}, "f0": {"scaler": "minmax"}, "f1": {"scaler": "standard"}},
    "features": {"continuous": ["f0", "f1"]},
    "data_split": {"test_size": 0.2, "valid_size": 0.2, "random_state": 42},
    "model": {"type": "knn", "params": {"n_neighbors": 5, "metric": "cosine"}},
    "data_validation": {
        "schema": {"columns": [{"name": "vec_id", "dtype": "int", "min": 0}, {"name": "f0", "dtype": "float"}]}
    },
}

# The first feature is scaled to [0, 1] and the second standardised, both by the training split.
STAGE = f"""WITH base AS ({vectors(label=BINARY)}), {split_ctes("base", "vec_id", "label")},
  fitted AS (
    SELECT min(v[1]) AS lo, max(v[1]) AS hi, avg(v[2]) AS m, stddev_pop(v[2]) AS s
    FROM split_rows WHERE split = 'train'),
  ready AS (
    SELECT id, vec_id, label, split, list_concat([(v[1] - lo) / (hi - lo), (v[2] - m) / s], v[3:]) AS v
    FROM split_rows, fitted),
  train_rows AS (SELECT * FROM ready WHERE split = 'train'),
  {neighbour_ctes("ready", "train_rows", 5)}, {vote_ctes()},
  preds AS (
    SELECT r.vec_id, r.split, r.label AS y_true, v.prediction AS y_pred, coalesce(p.share, 0) AS y_proba
    FROM ready r JOIN voted v ON r.id = v.query_id LEFT JOIN shares p ON r.id = p.query_id AND p.label = 1)"""


@query(f"""{STAGE}, {report_ctes()} SELECT split, n, tn, fp, fn, tp, {ROUNDED} FROM report""")
def stage_train(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder).withColumnRenamed("f1", "d1")
    report = train_stage(rows, TRAIN_CONFIG, "vec_id").report
    return report.withColumns({m: F.round(m, 6) for m in RATIOS})


@query(f"""{STAGE} SELECT vec_id, y_pred AS prediction, round(y_proba, 6) AS prediction_proba FROM preds""")
def stage_infer(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_table(spark, folder).withColumnRenamed("f1", "d1")
    stored = scratch_path(spark, "scorer")
    s.save_scorer(train_stage(rows, TRAIN_CONFIG, "vec_id").scorer, stored)
    out = infer_stage(rows.drop("label"), s.load_scorer(spark, stored), TRAIN_CONFIG)
    return out.select("vec_id", "prediction", F.round("prediction_proba", 6).alias("prediction_proba"))
