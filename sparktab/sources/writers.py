"""Table sinks: split tables, predictions and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One table with a folder per split, so that reading one split prunes the rest."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_predictions(df: DataFrame, path: str, id_col: str, fmt: str = "parquet") -> None:
    """Row id, then class shares where there are any, then the prediction."""
    shares = [c for c in df.columns if c.startswith("class_")]
    writer = df.select(id_col, *shares, "prediction").write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_json(df: DataFrame, path: str) -> None:
    """Reports and metrics as JSON lines; NaN is written as text, null is kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_document(df: DataFrame, name: str = "document") -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))
