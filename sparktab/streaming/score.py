"""Scoring of arriving rows against a static model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sparktab.operators.score import Scorer, score_json, score_or_reject


def score_stream(
    stream: DataFrame,
    scorer: Scorer,
    sink: str,
    checkpoint: str,
    proba: bool = True,
    json_col: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score every micro-batch and write it to a folder of its own.

    The neighbour join ranks rows, which a stream plan cannot, so each batch
    is scored as a table. A batch that is run again after a failure overwrites
    its own folder and so adds nothing twice. With ``json_col`` rows are JSON
    records and rejects go to ``<sink>/rejects``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        scored, rejects = score_or_reject(batch, scorer, proba) if json_col is None else score_json(batch, json_col, scorer)
        rejects.write.mode("overwrite").parquet(f"{sink}/rejects/batch={batch_id}")
        scored.write.mode("overwrite").parquet(f"{sink}/scored/batch={batch_id}")
        batch.unpersist()

    return start(stream, write, checkpoint, "append", trigger)


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
