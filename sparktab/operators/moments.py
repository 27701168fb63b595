"""Fitted state of numeric columns as lazy tables: made in parts, merged, and applied without a number on the driver.

A state has one struct per column: rows seen, values among them, their mean, sum
of squared deviations, least and greatest value. States of parts or days are
rows of one table; merging is an aggregation of any number of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.values import present, quoted
from sparktab.operators.preprocess import PreprocessError, require_columns

FIELDS = ("rows", "n", "mean", "m2", "low", "high")


@dataclass(frozen=True)
class Scale:
    """Mean imputation and scaling (``minmax``, ``standard`` or none) of one column."""

    scaler: str | None = None
    impute: bool = False


def fit_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row of states, or one for each group of ``by``; null and NaN are missing.

    A table without rows has one state of nothing, which merges like any other.
    """
    require_columns(df, [*columns, *by])
    made = []
    for c in columns:
        v = present(df, c).cast("double")
        low, high = F.min(v), F.max(v)
        mean = F.least(F.greatest(F.avg(v), low), high)
        m2 = F.when(low == high, 0.0).otherwise(F.coalesce(F.var_pop(v), F.lit(0.0)) * F.count(v))
        parts = (F.count(F.lit(1)), F.count(v), mean, m2, low, high)
        made.append(F.struct(*[p.alias(f) for p, f in zip(parts, FIELDS, strict=True)]).alias(c))
    return df.groupBy(*[quoted(b) for b in by]).agg(*made) if by else df.agg(*made)


def merge_states(states: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The states of all rows as one, or one for each group of ``by``: equal to the state of all data at once.

    Deviations are taken from the merged mean, so no large squares cancel; what is
    left is the rounding of the means (for values near 1e9 with a spread of 20 a
    few parts in 1e9 of the variance).
    """
    whole = [
        F.struct(
            F.sum(quoted(c)["rows"]).alias("rows"),
            F.sum(quoted(c)["n"]).alias("n"),
            (F.sum(quoted(c)["n"] * quoted(c)["mean"]) / F.nullif(F.sum(quoted(c)["n"]), F.lit(0))).alias("mean"),
            F.min(quoted(c)["low"]).alias("low"),
            F.max(quoted(c)["high"]).alias("high"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    picked = states.select(*[quoted(c) for c in (*by, *columns)])
    if by:
        means = picked.groupBy(*[quoted(b).alias(f"_by{i}") for i, b in enumerate(by)]).agg(*whole)
        same = [quoted(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)]
        both = picked.join(means, same)
    else:
        both = picked.withColumn("_all", picked.agg(*whole).select(F.struct("*")).scalar())
        both = both.select(*[quoted(c) for c in columns], "_all.*")
    made = []
    for i, c in enumerate(columns):
        one = {f: F.first(f"_{i}.{f}") for f in FIELDS if f != "m2"}
        mean = F.least(F.greatest(one["mean"], one["low"]), one["high"])
        away = quoted(c)["mean"] - F.col(f"_{i}.mean")
        m2 = F.when(one["low"] == one["high"], 0.0).otherwise(F.coalesce(F.sum(quoted(c)["m2"] + quoted(c)["n"] * away * away), F.lit(0.0)))
        parts = one | {"mean": mean, "m2": m2}
        made.append(F.struct(*[parts[f].alias(f) for f in FIELDS]).alias(c))
    return both.groupBy(*[quoted(b) for b in by]).agg(*made) if by else both.agg(*made)


def _scaled(value: Column, state: Column, how: Scale) -> Column:
    if how.scaler not in (None, "minmax", "standard"):
        raise PreprocessError(f"unknown scaler {how.scaler!r}")
    if how.impute:
        value = F.coalesce(value, state["mean"])
    if how.scaler is None:
        return value
    if how.scaler == "minmax":
        shift, size = state["low"], state["high"] - state["low"]
    else:
        # Values set to the mean add rows without a deviation.
        rows = state["rows"] if how.impute else state["n"]
        shift, size = state["mean"], F.sqrt(state["m2"] / F.when(rows > 0, rows))
    # A column that was constant in fitting is only shifted: the divisor 0 becomes 1.
    return (value - shift) / F.when(size == 0, 1.0).otherwise(size)


def apply_state(df: DataFrame, state: DataFrame, how: Mapping[str, Scale]) -> DataFrame:
    """The table with the named columns imputed and scaled by a one-row state table.

    The state is a scalar subquery of the same plan, so fitting and applying are
    one query. A column the state saw no value of becomes null where it is scaled.
    """
    require_columns(df, list(how))
    require_columns(state, list(how))
    fitted = state.select(F.struct(*[quoted(c) for c in how])).scalar()
    return df.withColumns({c: _scaled(present(df, c).cast("double"), fitted[c], h) for c, h in how.items()})
