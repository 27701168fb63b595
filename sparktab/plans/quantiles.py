"""Exact quantiles of several columns with linear interpolation.

A sketch brackets each wanted rank between two values; one more pass counts what
lies below the brackets, and another the values inside them, from which the
ranks are read off. All columns share the passes, and no task holds all values
of a column. If a bracket misses its rank it is widened and the passes repeated.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.plans.running import running_sums

SKETCH_ACCURACY = 10_000


def quantiles(df: DataFrame, columns: dict[str, Column], probabilities: Sequence[float]) -> dict[str, list[float] | None]:
    """For each named double expression its quantiles; nulls are skipped."""
    names = list(columns)
    values = df.select(*[columns[c].cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    sizes = values.agg(*[f(F.col(f"v{i}")).alias(f"{n}{i}") for i in range(len(names)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    ranks = {
        i: sorted({r for p in probabilities for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
        for i in range(len(names))
        if (n := sizes[f"n{i}"])
    }
    found: dict[tuple[int, int], float] = {}
    margin = 2.0 / SKETCH_ACCURACY
    while wanted := [(i, r) for i, rs in ranks.items() for r in rs if (i, r) not in found]:
        found.update(_select(values, _brackets(values, wanted, sizes, margin)))
        margin *= 8
    out: dict[str, list[float] | None] = dict.fromkeys(names)
    for i in ranks:
        n, picked = sizes[f"n{i}"], []
        for p in probabilities:
            at = p * (n - 1)
            low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
            picked.append(low + (high - low) * (at - math.floor(at)))
        out[names[i]] = picked
    return out


def _brackets(values: DataFrame, wanted: list[tuple[int, int]], sizes, margin: float) -> list[tuple[int, int, float, float]]:
    """(column, rank, low, high) that should hold each wanted rank."""
    steps: dict[int, list[float]] = {}
    for i, r in wanted:
        n = sizes[f"n{i}"]
        steps.setdefault(i, []).extend((max(0.0, r / n - margin), min(1.0, (r + 1) / n + margin)))
    ends = values.agg(*[F.percentile_approx(f"v{i}", s, SKETCH_ACCURACY).alias(f"e{i}") for i, s in steps.items()]).first()
    out, used = [], dict.fromkeys(steps, 0)
    for i, r in wanted:
        at = used[i]
        used[i] += 2
        low = sizes[f"lo{i}"] if steps[i][at] == 0.0 else ends[f"e{i}"][at]
        high = sizes[f"hi{i}"] if steps[i][at + 1] == 1.0 else ends[f"e{i}"][at + 1]
        out.append((i, r, low, high))
    return out


def _select(values: DataFrame, brackets: list[tuple[int, int, float, float]]) -> dict[tuple[int, int], float]:
    """The values at the ranks whose bracket really holds them."""
    below = values.agg(*[F.count_if(F.col(f"v{i}") < F.lit(lo)).alias(f"b{j}") for j, (i, _, lo, _) in enumerate(brackets)]).first()
    inside = [F.when(F.col(f"v{i}").between(lo, hi), F.struct(F.lit(j).alias("j"), F.col(f"v{i}").alias("v"))) for j, (i, _, lo, hi) in enumerate(brackets)]
    counted = values.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
    summed = running_sums(counted, "v", ["n"], by=["j"])
    start = F.create_map(*[F.lit(x).cast("bigint") for j in range(len(brackets)) for x in (j, below[f"b{j}"])])
    rank = F.create_map(*[F.lit(x).cast("bigint") for j, b in enumerate(brackets) for x in (j, b[1])])
    j = F.col("j").cast("bigint")
    placed = summed.withColumn("end", F.col("run_n") + start[j]).withColumn("rank", rank[j])
    hit = (F.col("end") > F.col("rank")) & (F.col("end") - F.col("n") <= F.col("rank"))
    return {brackets[row.j][:2]: row.v for row in placed.where(hit).select("j", "v").collect()}
