"""Counts, duplicates, samples, schema and fingerprint of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.values import quoted

PIECE = (1 << 20) - 1


def profile(df: DataFrame, name: str = "table") -> DataFrame:
    """One row: row count, column count and the column list."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical row; nulls are equal.

    Rows meet by a 256-bit digest of all their values, so neither long text nor
    wide rows travel, and counting combines on the map side, so many copies of
    one row cost one row per task in the shuffle.
    """
    columns = list(columns or df.columns)
    row = F.unhex(F.sha2(F.concat(*[text_form(df, c) for c in columns]), 256))
    groups = df.groupBy(row.alias("row")).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
    )


def head_sample(df: DataFrame, order_by: Sequence[str], n: int = 100) -> DataFrame:
    """The first n rows by key: a per-task top n, merged; never a full sort."""
    return df.orderBy(*order_by).limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows of ordinal, column name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, type string")


def exact_form(number: Column) -> Column:
    """A double as text without loss.

    Most are a whole part and twice 52 binary places of the fraction, all exact
    and the same in any engine. Others (very large or with more binary places,
    infinities, NaN) keep Spark's text, which tells all doubles apart.
    """
    size, step = F.abs(number), float(1 << 52)
    upper = (size - F.floor(size)) * step
    lower = (upper - F.floor(upper)) * step
    parts = F.concat_ws(".", F.floor(size).cast("string"), F.floor(upper).cast("string"), F.floor(lower).cast("string"))
    plain = F.concat(F.when(number < 0, "-").otherwise(""), parts)
    return F.when((size < 2 * step) & (lower == F.floor(lower)), plain).otherwise(number.cast("string"))


def text_form(df: DataFrame, name: str) -> Column:
    """A closed text form of a value: doubles by mantissa and exponent, times as microseconds.

    Text carries its length, so that no two rows share a form.
    """
    value, data_type = quoted(name), df.schema[name].dataType
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = exact_form(value.cast("double"))
    elif isinstance(data_type, T.TimestampNTZType):
        value = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value).cast("string")
    elif isinstance(data_type, T.TimestampType):
        value = F.unix_micros(value).cast("string")
    elif isinstance(data_type, (T.StringType, T.BinaryType)):
        value = F.concat(F.length(value).cast("string"), F.lit(":"), value if isinstance(data_type, T.StringType) else F.hex(value))
    elif isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        value = F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v"))))
    else:
        value = value.cast("string")
    return F.coalesce(F.concat(value, F.lit("|")), F.lit("-|"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A content hash that no reordering of rows or partitions changes.

    Every row gives an MD5, cut into pieces of 20 bits; the sums of the pieces
    and the row count are combined per task first, so the shuffle carries one
    row per task, and 64-bit sums hold for trillions of rows.
    """
    columns = list(columns or df.columns)
    hashed = df.select(F.md5(F.concat(*[text_form(df, c) for c in columns]).cast("binary")).alias("h"))
    words = hashed.select(
        *[F.conv(F.substring("h", at, 10), 16, 10).cast("bigint").alias(f"w{at}") for at in (1, 11)]
    )
    pieces = [F.shiftright("w1", 20), F.col("w1").bitwiseAND(PIECE), F.shiftright("w11", 20), F.col("w11").bitwiseAND(PIECE)]
    totals = words.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.coalesce(F.sum(p), F.lit(0)).alias(f"s{i}") for i, p in enumerate(pieces)],
    )
    parts = F.concat_ws("|", "n_rows", *[f"s{i}" for i in range(len(pieces))])
    return totals.select("n_rows", F.md5(parts.cast("binary")).alias("fingerprint"))
