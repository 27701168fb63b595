"""Quantiles from mergeable sketches: one pass, binary columns that add up over parts and days.

Opt-in beside the exact quantiles, for tables where one more pass costs more than a
small error of rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 800


def rank_error(k: int = SKETCH_SIZE) -> float:
    """How far the rank of a result may be off, as a share of the values (99 % confidence).

    The published formula of the sketch for two-sided errors.
    """
    return 2.446 / k**0.9433


def quantile_sketches(df: DataFrame, columns: dict[str, Column], by: Sequence[str] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """One binary sketch for each named double expression and group; nulls and NaN are skipped.

    Partial sketches combine before the shuffle, so a hot group is one row per task.
    """
    values = {c: F.when(~F.isnan(v.cast("double")), v.cast("double")) for c, v in columns.items()}
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(v, F.lit(k)).alias(c) for c, v in values.items()])


def merge_sketches(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts (files, days, tables) as those of the groups they make up."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])


def sketch_quantiles(sketch: Column, probabilities: Sequence[float]) -> Column:
    """The values at these shares of the rank, as an array; null for a sketch without values."""
    found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)


def sketched_quantiles(df: DataFrame, columns: dict[str, Column], probabilities: Sequence[float], k: int = SKETCH_SIZE) -> dict[str, list[float] | None]:
    """The result of ``quantiles`` within ``rank_error(k)``, all columns in one pass; the ends are exact."""
    made = quantile_sketches(df, columns, k=k)
    row = made.select(*[sketch_quantiles(F.col(c), probabilities).alias(c) for c in columns]).first()
    return {c: None if row[c] is None else list(row[c]) for c in columns}
