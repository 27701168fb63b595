"""Running sums along a sorted column without gathering the column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.session import materialize

SLICE_VALUES = 100_000


def running_sums(
    df: DataFrame,
    order_col: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    slice_values: int | None = None,
) -> DataFrame:
    """Add ``run_<c>``: the sum of c over all rows up to and including this one.

    ``df`` holds one row per (by, order_col) value. Rows are dealt into ranges
    of the order column, as many as their number asks for, and written with the
    number of their range, which fixes the ranges. Sums run inside a range and
    are shifted by the totals of the ranges before, a table of ranges x ``by``
    groups.
    """
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    df = materialize(df, "ordered")
    slices = -(-df.count() // (slice_values or SLICE_VALUES))
    if slices <= 1:
        inside = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(inside).alias(f"run_{c}") for c in sums])

    dealt = df.repartitionByRange(slices, order).withColumn("_slice", F.spark_partition_id())
    sliced = materialize(dealt, "ranges")
    inside = W.partitionBy(*by, "_slice").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    within = sliced.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])

    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        *by, "_slice", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums]
    )
    joined = within.join(shifts, [*by, "_slice"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_in_{c}") + F.col(f"_b_{c}")).alias(f"run_{c}") for c in sums],
    )
