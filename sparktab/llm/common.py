"""Helpers the text operators share: whole-text passes over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name itself, or with underscores where the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: ``pick(df, doc_id="id")``.

    Other columns of the table, whatever they are called, stay outside.
    """
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


#: Spark's setting of the bytes in one Arrow batch, its default, and what whole texts get instead.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def map_texts(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` over whole texts, in small batches unless the session has a size of its own.

    A batch is held by the JVM and by Python at once, for every task of an
    executor; with texts little is gained beyond a few megabytes.
    """
    if df.sparkSession.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        df.sparkSession.conf.set(BATCH_KEY, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a text column as UTF-8, one after the other."""
    for value in column.cast(pa.binary()):
        yield value.as_py()


def append(df: DataFrame, column: str, fn: Callable[[bytes | None], tuple], fields: dict[str, str]) -> DataFrame:
    """Add columns computed from each whole value of one text column.

    ``fn`` gets the UTF-8 bytes (None for null) and returns one value per field.
    Rows stay in their partition and other columns pass through untouched; a new
    name the table has already gets underscores. One value is worked on at a time,
    so memory is that of an Arrow batch.
    """
    made = [fresh(df, k) for k in fields]
    schema = T.StructType([*df.schema.fields, *[T.StructField(k, T._parse_datatype_string(v)) for k, v in zip(made, fields.values(), strict=True)]])
    at, kinds, names = df.columns.index(column), [ARROW[k] for k in fields.values()], [*df.columns, *made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = [fn(v) for v in texts_of(batch.column(at))]
            arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=names)

    return map_texts(df, run, schema)


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks for so many rows: the session's number, or more where tasks would grow."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


#: What stands for a null id in arrays of ids, and a score below all others.
NO_ID, LOWEST = np.iinfo(np.int64).max, np.iinfo(np.int64).min // 2


class Best:
    """The k best (score, id) of one search: higher scores first, then smaller ids, null ids last."""

    __slots__ = ("ids", "k", "null", "scores")

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else LOWEST

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = np.r_[self.scores, scores], np.r_[self.ids, ids], np.r_[self.null, null]
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
