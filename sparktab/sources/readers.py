"""Table scans: by format name, by file suffix, or from a source setting."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import PurePosixPath
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.values import quoted

log = logging.getLogger(__name__)

# Readable formats and the file suffix of each.
SUFFIX_FORMATS = {".csv": "csv", ".json": "json", ".orc": "orc", ".parquet": "parquet"}

LOGICAL_SPARK_TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
}


class SourceError(Exception):
    """A table is missing, unreadable, or of an unknown format."""


def schema_from_rules(rules: list[Mapping[str, Any]]) -> T.StructType:
    """An explicit read schema from column rules, which saves the inference pass."""
    return T.StructType(
        [T.StructField(r["name"], LOGICAL_SPARK_TYPES[r.get("dtype", "str")]) for r in rules]
    )


def format_of(path: str) -> str:
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in SUFFIX_FORMATS:
        raise SourceError(f"unsupported file suffix {suffix!r} in {path}")
    return SUFFIX_FORMATS[suffix]


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Scan a table. Without ``fmt`` the file suffix decides.

    CSV takes a header row and, only when no schema is given, infers types.
    """
    fmt = fmt.lower() if fmt else format_of(path)
    if fmt not in SUFFIX_FORMATS.values():
        raise SourceError(f"unsupported table format {fmt!r}")
    if fmt == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceError(f"table not found: {path}") from error
        raise SourceError(f"cannot read {path}: {error}") from error


def load_source(
    spark: SparkSession,
    source: Mapping[str, Any],
    schema: T.StructType | str | None = None,
    warn_if_empty: bool = True,
) -> DataFrame:
    """Scan the table a ``{raw_path, type, header, encoding}`` setting names."""
    fmt = source.get("type", "csv")
    options: dict[str, Any] = {}
    if fmt.lower() == "csv":
        options["header"] = source.get("header", 0) is not None
        if source.get("encoding"):
            options["encoding"] = source["encoding"]
    df = read_table(spark, source["raw_path"], fmt, schema, **options)
    if warn_if_empty and (not df.columns or df.isEmpty()):
        log.warning("table %s is empty", source["raw_path"])
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """The load stage refuses an empty table."""
    if not df.columns or df.isEmpty():
        raise SourceError("the loaded table is empty")
    return df


def read_rejects(spark: SparkSession, path: str, schema: T.StructType | str, record_col: str = "_record", **options: Any) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that fit the schema, and the text of those that do not, as ``record_col``.

    A row is broken if it has too few or too many fields or a field that cannot be read
    as its type; nothing of it reaches the good rows, and one such row stops no job.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*schema.fields, T.StructField(record_col, T.StringType())])
    df = read_table(spark, path, "csv", whole, mode="PERMISSIVE", columnNameOfCorruptRecord=record_col, **options)
    # always true, but asks for every field, so a row is judged alike whichever columns are read later
    parsed = F.hash(*[quoted(c) for c in schema.fieldNames()]) >= -(1 << 31)
    record = quoted(record_col)
    return df.where(record.isNull() & parsed).drop(record_col), df.where(record.isNotNull() & parsed).select(record)


@contextmanager
def source_errors(path: str) -> Iterator[None]:
    """Errors of reading a table that come only when a job runs, as ``SourceError``."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if "FAILED_READ_FILE" in str(error) or "CANNOT_READ" in str(error) or "MALFORMED_RECORD" in str(error):
            raise SourceError(f"cannot read {path}: {str(error)[:300]}") from error
        raise
