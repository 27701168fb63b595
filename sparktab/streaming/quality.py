"""Rule counts per time window on a stream, and removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparktab.operators.validate import Rule, checkable, value_checks
from sparktab.session import path_exists, remove_path
from sparktab.streaming.score import start


def rule_conditions(df: DataFrame, rules: Sequence[Rule]) -> dict[str, Column]:
    """The condition under which a row breaks a rule, by the name of its count."""
    return {f"{rule['name']}_{check}": condition for _, rule in checkable(df, rules) for check, condition in value_checks(df, rule).items()}


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(condition).alias(name) for name, condition in rule_conditions(df, rules).items()]


def windowed_quality(
    df: DataFrame, rules: Sequence[Rule], time_col: str, window: str, watermark: str | None = None
) -> DataFrame:
    """Rows and broken rules per tumbling window; the same plan for streams and tables."""
    timed = df.withColumn("_ts", F.col(time_col).cast("timestamp"))
    if watermark and df.isStreaming:
        timed = timed.withWatermark("_ts", watermark)
    counts = timed.groupBy(F.window("_ts", window)).agg(
        F.count(F.lit(1)).alias("n_rows"), *rule_counts(df, rules)
    )
    bounds = [F.col(f"window.{end}").cast("timestamp_ntz").alias(f"window_{end}") for end in ("start", "end")]
    return counts.select(*bounds, *counts.columns[1:])


WINDOW = ["window_start", "window_end"]
LATE, LAST = "n_late", "last_ts"


def quality_stream(
    stream: DataFrame,
    rules: Sequence[Rule],
    time_col: str,
    sink: str,
    checkpoint: str,
    window: str = "1 day",
    *,
    watermark: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the windows as they stand after each batch; ``latest_windows`` and ``late_rows`` read the result.

    Each batch is counted as a table and its counts are added to those of the batch
    before: a batch's folder holds all windows and how late the stream is, folders
    older than that go, and a batch that is run again overwrites its own folder, so
    nothing counts twice. The watermark is the latest time of the batches before less
    the delay the caller names. A row whose window ended by then does not change that
    window; it is counted beside it as late, and so are rows without a time, under no
    window. Rows seen are thus rows counted plus rows late.
    """
    delay = F.expr(f"INTERVAL {watermark}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, f"{sink}/batch={batch_id - 1}"
        batch = batch.withColumn("_ts", F.col(time_col).cast("timestamp")).persist()
        old = spark.read.parquet(before) if path_exists(spark, before) else None
        last = old.agg(F.max(LAST)).first()[0] if old is not None else None
        end = F.window("_ts", window).getField("end")
        late = F.lit(False) if last is None else end <= F.lit(last) - delay
        timed = batch.select("*", late.alias("_late"))
        seen = timed.groupBy(F.window("_ts", window).alias("window")).agg(
            F.count_if(~F.col("_late")).alias("n_rows"),
            *[F.count_if(F.coalesce(condition, F.lit(False)) & ~F.col("_late")).alias(name) for name, condition in rule_conditions(batch, rules).items()],
            F.count_if("_late").alias(LATE),
            F.max("_ts").alias(LAST),
        )
        bounds = [F.col(f"window.{e}").cast("timestamp_ntz").alias(f"window_{e}") for e in ("start", "end")]
        sums = [c for c in seen.columns if c not in ("window", LAST)]
        seen = seen.select(*bounds, *sums, LAST)
        timeless = batch.where("_ts is null").agg(F.count(F.lit(1)).alias(LATE)).where(F.col(LATE) > 0)
        states = [seen, timeless, *([old] if old is not None else [])]
        merged = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), states)
        merged = merged.groupBy(*WINDOW).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.max(LAST).alias(LAST))
        merged.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        batch.unpersist()
        remove_path(spark, f"{sink}/batch={batch_id - 2}")

    return start(stream, write, checkpoint, "append", trigger)


def _last_state(spark: SparkSession, sink: str) -> DataFrame:
    states = spark.read.option("basePath", sink).parquet(f"{sink}/batch=*")
    last = states.agg(F.max("batch")).first()[0]
    return states.where(F.col("batch") == last).drop("batch")


def latest_windows(spark: SparkSession, sink: str) -> DataFrame:
    """The counts of every window after the last batch, without its late rows."""
    return _last_state(spark, sink).where(F.col("n_rows") > 0).drop(LATE, LAST)


def late_rows(spark: SparkSession, sink: str) -> DataFrame:
    """``window_start, window_end, n_late`` where rows came too late; no window for rows without a time."""
    return _last_state(spark, sink).where(F.col(LATE) > 0).select(*WINDOW, LATE)


def distinct_stream(stream: DataFrame, columns: Sequence[str], time_col: str, watermark: str) -> DataFrame:
    """Drop rows that repeat an earlier row's columns within the watermark."""
    timed = stream.withColumn("_ts", F.col(time_col).cast("timestamp")).withWatermark("_ts", watermark)
    return timed.dropDuplicatesWithinWatermark(list(columns)).drop("_ts")
