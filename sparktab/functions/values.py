"""Missing values, lenient parsing and type families as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The four logical type names a column rule may declare, and the
# Spark types each of them accepts.
LOGICAL_TYPES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "str": (T.StringType, T.VarcharType, T.CharType),
    "bool": (T.BooleanType,),
}

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def sql_name(name: str) -> str:
    """The name as SQL reads it, even if it holds dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(sql_name(name))


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), (T.FloatType, T.DoubleType))


def matches_logical_type(data_type: T.DataType, logical: str) -> bool:
    return isinstance(data_type, LOGICAL_TYPES.get(logical, ()))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    value = quoted(name)
    return value.isNull() | F.isnan(value) if is_floating(df, name) else value.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that aggregates skip it."""
    value = quoted(name)
    return F.when(~F.isnan(value), value) if is_floating(df, name) else value


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double; text that is no number becomes null."""
    value, data_type = quoted(name), type_of(df, name)
    if isinstance(data_type, LOGICAL_TYPES["str"]):
        return F.when(value.rlike(NUMBER_TEXT), F.trim(value).try_cast("double"))
    if isinstance(data_type, T.BooleanType):
        return value.cast("int").cast("double")
    if isinstance(data_type, T.NumericType):
        return present(df, name).cast("double")
    return F.lit(None).cast("double")


def as_timestamp(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """The column as a timestamp; unparseable text becomes null.

    Text is read in ISO form first, then in each of ``formats`` in turn.
    """
    value, data_type = quoted(name), type_of(df, name)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return value
    if isinstance(data_type, T.DateType):
        return value.cast("timestamp_ntz")
    text = value.cast("string")
    attempts = [text.try_cast("timestamp_ntz")]
    attempts += [
        F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz") for pattern in formats
    ]
    return F.coalesce(*attempts)
