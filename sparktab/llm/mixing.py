"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import fresh
from sparktab.session import materialize

#: Rounds of fitting; each rakes every margin once.
ROUNDS = 8
#: Exponent that makes targets from the token shares found; values below the least share are fitted as one.
TEMPER, LEAST_SHARE = 0.9, 0.001
REST = "(rest)"
#: Bits of the sampling number.
DRAW_BITS = 52


@dataclass(frozen=True)
class Margins:
    """Columns to rake and, for each, its target shares (none: tempered shares of the table itself)."""

    columns: tuple[str, ...] = ("source", "lang", "topic")
    targets: dict[str, dict[str, float]] = field(default_factory=dict)


def count(text: Column, characters: str) -> Column:
    """How many of some one-byte characters the whole text has."""
    return F.octet_length(text) - F.octet_length(F.translate(text, characters, ""))


def topic(text: Column) -> Column:
    """A coarse topic from the whole text's marks: table, markup, figures or prose (null and empty: none).

    Most texts have few marks of any kind, which one count tells.
    """
    size = F.octet_length(text)
    return (
        F.when(text.isNull() | (size == 0), F.lit("none"))
        .when(count(text, "|#*$%&<>0123456789") * 100 < size, "prose")
        .when(count(text, "|") * 100 >= size, "table")
        .when(count(text, "#*$%&<>") * 50 >= size, "markup")
        .when(count(text, "0123456789") * 50 >= size, "figures")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """Words between spaces and line ends of the whole text, 1 at least, so that every row has weight."""
    return F.coalesce(count(text, " \n\t") + 1, F.lit(1)).cast("long")


def draw(key: Column) -> Column:
    """A number in [0, 1) from the key's digest, the same wherever and whenever it is computed."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, DRAW_BITS // 4), 16, 10)
    return digits.cast("double") / float(1 << DRAW_BITS)


def _total(df: DataFrame, column: str, of=F.sum) -> float:
    return float(df.agg(of(column)).first()[0] or 0)


def _targets(cells: DataFrame, column: str, wanted: dict[str, float] | None) -> DataFrame:
    """``value, share`` of one margin; shares add up to 1 over the values that occur."""
    sums = cells.groupBy(column).agg(F.sum("n").cast("double").alias("n"))
    if wanted:
        listed = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
        sums = sums.withColumn("raw", F.coalesce(listed[F.col(column)], F.lit(0.0)))
    else:
        sums = sums.withColumn("raw", F.pow("n", F.lit(TEMPER)))
    total = _total(sums, "raw")
    return sums.select(column, (F.col("raw") / total if total else F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, margins: Margins, rounds: int = ROUNDS) -> DataFrame:
    """Cells with the share ``w`` of the fitted table.

    Each step multiplies every cell by target over sum of its margin's value.
    Sums combine before the shuffle, so a value that holds most cells is one row
    per task; target shares lie beside each cell, and the state is written after
    each round.
    """
    state = materialize(cells.withColumn("w", F.col("n") / F.lit(_total(cells, "n") or 1.0)), "cells")
    shares = {c: fresh(state, f"share_{c}") for c in margins.columns}
    for column, share in shares.items():
        state = state.join(_targets(cells, column, margins.targets.get(column)).withColumnRenamed("share", share), column)
    state = materialize(state, "cells")
    for _ in range(rounds):
        for column, share in shares.items():
            sums = state.groupBy(column).agg(F.sum("w").alias("sum_w"))
            factor = F.when(F.col("sum_w") > 0, F.col(share) / F.col("sum_w")).otherwise(0.0)
            state = state.join(sums, column).withColumn("w", F.col("w") * factor).drop("sum_w")
        state = materialize(state, "cells")
    return state.drop(*shares.values())


def mix(df: DataFrame, margins: Margins | None = None, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> tuple[DataFrame, dict[str, str]]:
    """The table with topic, tokens, weight, probability and the sampling decision, and the new columns' names.

    The weight is the cell's target tokens over its tokens; the probability is
    the weight over the largest weight, so that sampled tokens meet the margins
    in expectation and no probability exceeds 1. The draw depends on the id
    alone: repeated ids fall together, a null id counts as empty. A column topic
    that the table has is taken as it is, and none is added. Null margin
    values are a value of their own; values below the least share of tokens are
    fitted together, so that one odd document cannot set the scale. Where
    targets are given, values without one are never drawn.
    """
    margins = margins or Margins()
    names = {k: fresh(df, k) for k in ("n_tokens", "weight", "probability", "kept")}
    names["topic"] = "topic" if "topic" in df.columns else fresh(df, "topic")
    out = df if "topic" in df.columns else df.withColumn(names["topic"], topic(F.col(text_col)))
    out = out.withColumn(names["n_tokens"], tokens(F.col(text_col)))
    n = F.col(names["n_tokens"])
    keys = {c: fresh(out, f"mix_{c}") for c in margins.columns}
    for c, k in keys.items():
        out = out.withColumn(k, F.coalesce(F.col(names.get(c, c)).cast("string"), F.lit("(null)")))
    raw = materialize(out.groupBy(*keys.values()).agg(F.sum(n).alias("n")).select(*[F.col(k).alias(c) for c, k in keys.items()], "n"), "cells")
    least, pooled = LEAST_SHARE * _total(raw, "n"), raw
    for c in margins.columns:
        small = raw.groupBy(c).agg(F.sum("n").alias("own")).select(c, F.when((F.col("own") < least) & ~F.col(c).isin(list(margins.targets.get(c, ()))), F.lit(REST)).otherwise(F.col(c)).alias(f"to_{c}"))
        pooled = pooled.join(small, c)
    pooled = materialize(pooled, "pooled")
    to = [F.col(f"to_{c}").alias(c) for c in margins.columns]
    fitted = rake(pooled.select(*to, "n").groupBy(*margins.columns).agg(F.sum("n").alias("n")), margins, rounds)
    fitted = fitted.withColumn("weight", F.when(F.col("n") > 0, F.col("w") / F.col("n") * _total(fitted, "n")).otherwise(0.0))
    top = _total(fitted, "weight", F.max)
    probability = F.col("weight") / top if top else F.lit(0.0)
    weights = fitted.select(*[F.col(c).alias(f"to_{c}") for c in margins.columns], "weight", probability.alias("probability"))
    weights = pooled.join(weights, [f"to_{c}" for c in margins.columns])
    weights = weights.select(*[F.col(c).alias(k) for c, k in keys.items()], F.col("weight").alias(names["weight"]), F.col("probability").alias(names["probability"]))
    out = out.join(materialize(weights, "weights"), list(keys.values())).drop(*keys.values())
    return out.withColumn(names["kept"], draw(F.col(id_col)) < F.col(names["probability"])), names
