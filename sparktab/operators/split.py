"""Repeatable stratified splits and folds, keyed by the row id.

A row's place within its class is the order of ``md5(seed|id)``. Cutting that
order at the class quotas needs no shuffle of the table: a count per leading
digits finds the slice that holds each cut, one small selection inside that
slice finds the cut itself, and every row is then compared with the cuts of
its class. Ids must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.plans.running import running_sums
from sparktab.session import materialize

SLICE_ROWS = 100_000
#: Classes up to which their quotas are sent to every task; more of them are joined.
SENT_CLASSES = 100_000


class SplitError(ValueError):
    """The split cannot be made as asked."""


def order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")).cast("binary"))


def class_counts(df: DataFrame, target: str | None) -> dict:
    """Rows per class, one number each; refuses missing labels."""
    if target is None:
        return {None: df.count()}
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.collect()
    if any(r.label is None for r in rows):
        raise SplitError(f"{target} has missing labels")
    return {r.label: r.n for r in sorted(rows, key=lambda r: r.label)}


def quotas(counts: dict, total: int) -> dict:
    """Share ``total`` out over the classes by largest remainder, ties to the smaller label."""
    n = sum(counts.values())
    if n == 0:
        return dict.fromkeys(counts, 0)
    shares = {label: Fraction(total * size, n) for label, size in counts.items()}
    taken = {label: math.floor(share) for label, share in shares.items()}
    by_remainder = sorted(counts, key=lambda label: taken[label] - shares[label])
    for label in by_remainder[: total - sum(taken.values())]:
        taken[label] += 1
    return taken


def quota_table(sizes: DataFrame, total: int, label: str = "label", n: str = "n", quota: str = "quota") -> DataFrame:
    """``quotas`` as a table: sizes per class (whole numbers, labels unique) with the share of each class.

    Remainders are ranked in slices of their order, so any number of classes
    stays distributed; the driver gets two sums. Ties go to the smaller label.
    """
    if sizes.where(F.col(label).isNull()).limit(1).count():
        raise SplitError(f"{label} has missing labels")
    rows = sizes.agg(F.sum(n)).first()[0] or 0
    if rows == 0:
        return sizes.withColumn(quota, F.lit(0).cast("bigint"))
    product = F.col(n).cast("decimal(18,0)") * F.lit(total).cast("decimal(18,0)")
    shares = sizes.withColumn("_product", product).withColumn("_rows", F.lit(rows).cast("decimal(18,0)"))
    shares = shares.withColumn("_floor", F.expr("_product div _rows"))
    ranked = shares.withColumn("_order", F.struct((-(F.col("_product") % F.col("_rows"))).alias("short"), F.col(label).alias("label")))
    ranked = ranked.withColumn("_one", F.lit(1).cast("bigint")).drop("_product", "_rows")
    ranked = materialize(running_sums(ranked, "_order", ["_one"]), "remainders")
    left = total - ranked.agg(F.sum("_floor")).first()[0]
    more = F.when(F.col("run__one") <= left, 1).otherwise(0)
    return ranked.select(*sizes.columns, (F.col("_floor") + more).cast("bigint").alias(quota))


def draw_sizes(n: int, test: float, valid: float) -> tuple[int, int]:
    """Sizes of the test draw, and of the valid draw from what is left."""
    if not (0 <= test < 1 and 0 <= valid < 1 and test + valid < 1):
        raise SplitError("test and valid must be fractions with a sum below 1")
    n_test = math.ceil(round(test * n, 9))
    share = valid / (1 - test)
    return n_test, math.ceil(round(share * (n - n_test), 9))


def _digits(n_rows: int) -> int:
    """Leading hex digits that give slices of about SLICE_ROWS rows."""
    digits = 1
    while n_rows / 16**digits > SLICE_ROWS:
        digits += 1
    return digits


def _label(df: DataFrame, target: str | None) -> Column:
    return F.col(target) if target else F.lit(0)


def _attach(df: DataFrame, label: str, values: dict[Any, dict], fields: dict[str, str]) -> DataFrame:
    """Add one struct per class as column ``of_class``, by a join on the label."""
    schema = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in fields.items()) + ">"
    label_type = df.schema[label].dataType.simpleString()
    rows = [(k, tuple(v[name] for name in fields)) for k, v in values.items()]
    table = df.sparkSession.createDataFrame(rows, f"_label {label_type}, of_class {schema}")
    table = F.broadcast(table) if len(rows) <= SENT_CLASSES else table
    return df.join(table, F.col(label) == F.col("_label")).drop("_label")


def cut_points(
    df: DataFrame, id_col: str, target: str | None, seed: int, positions: dict[str, dict]
) -> dict:
    """The order key at each (class, named position); none at position 0.

    One job counts rows per class and slice and finds the slices that hold a
    position, at most classes x positions rows; another ranks those slices.
    """
    names = list(positions)
    labels = {label for per_class in positions.values() for label in per_class}
    n_rows = max(max(p.values(), default=0) for p in positions.values())
    keyed = df.select(
        _label(df, target).alias("label"),
        order_key(id_col, seed).alias("key"),
        F.substring(order_key(id_col, seed), 1, _digits(n_rows)).alias("slice"),
    )
    at = {0 if target is None else label: {n: positions[n][label] for n in names} for label in labels}
    sizes = keyed.groupBy("label", "slice").agg(F.count(F.lit(1)).alias("n"))
    through = F.sum("n").over(W.partitionBy("label").orderBy("slice"))
    slices = _attach(sizes.withColumn("through", through), "label", at, dict.fromkeys(names, "bigint"))
    holds = "{0} > through - n and {0} <= through"
    wanted = " or ".join("(" + holds.format(f"of_class.{n}") + ")" for n in names)
    held = {}
    for row in slices.where(wanted).collect():
        for n in names:
            nth = row.of_class[n] - row.through + row.n
            if 0 < nth <= row.n:
                held[row.label, n] = {"slice": row.slice, "nth": nth}

    none = {"slice": None, "nth": None}
    chosen = {
        label: {f"{key}_{n}": value for n in names for key, value in held.get((label, n), none).items()}
        for label in at
    }
    fields = {f"{key}_{n}": kind for n in names for key, kind in (("slice", "string"), ("nth", "bigint"))}
    near = _attach(keyed, "label", chosen, fields)
    hits = ", ".join(
        f"if(slice = of_class.slice_{n}, named_struct('name', '{n}', 'nth', of_class.nth_{n}), null)" for n in names
    )
    inside = near.selectExpr("label", "key", f"inline(array_compact(array({hits})))")
    place = F.row_number().over(W.partitionBy("label", "name").orderBy("key"))
    found = inside.withColumn("place", place).where("place = nth").select("label", "name", "key")
    return {(r.label, r.name): r.key for r in found.collect()}


def stratified_split(
    df: DataFrame,
    id_col: str,
    target: str | None,
    test: float = 0.2,
    valid: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: ``test`` is drawn first, ``valid`` from the rest, then ``train``."""
    counts = class_counts(df, target)
    n_test, n_valid = draw_sizes(sum(counts.values()), test, valid)
    in_test = quotas(counts, n_test)
    rest = {label: n - in_test[label] for label, n in counts.items()}
    in_valid = quotas(rest, n_valid)
    ends = {
        "test": in_test,
        "valid": {label: in_test[label] + in_valid[label] for label in counts},
    }
    keys = cut_points(df, id_col, target, seed, ends)
    if target is None:
        marked = df
        cut_test, cut_valid = (F.lit(keys.get((0, name))).cast("string") for name in ends)
    else:
        cuts = {label: {name: keys.get((label, name)) for name in ends} for label in counts}
        marked = _attach(df, target, cuts, {"test": "string", "valid": "string"})
        cut_test, cut_valid = F.col("of_class.test"), F.col("of_class.valid")
    key = order_key(id_col, seed)
    split = F.when(key <= cut_test, "test").when(key <= cut_valid, "valid").otherwise("train")
    return marked.withColumn("split", split).drop("of_class")


def stratified_split_by_table(
    df: DataFrame,
    id_col: str,
    target: str,
    test: float = 0.2,
    valid: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """The split of ``stratified_split`` for any number of classes: sizes and quotas stay tables.

    Rows are ranked in one shuffle on (class, leading digits); the quotas travel
    with the offsets of those slices, so a class that holds most of the table
    is spread over all tasks in the join as well. The driver gets sums only.
    """
    counted = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, "classes")
    rows = counted.agg(F.sum("n")).first()[0] or 0
    n_test, n_valid = draw_sizes(rows, test, valid)
    ends = quota_table(counted, n_test, quota="in_test")
    ends = quota_table(ends.withColumn("rest", F.col("n") - F.col("in_test")), n_valid, n="rest", quota="in_valid")
    ends = ends.select("label", F.struct("in_test", (F.col("in_test") + F.col("in_valid")).alias("through")).alias("of_class"))
    ranked = rank_in_class(df, id_col, target, seed, ends)
    place = F.col("class_rank")
    split = F.when(place <= F.col("of_class.in_test"), "test").when(place <= F.col("of_class.through"), "valid").otherwise("train")
    return ranked.withColumn("split", split).drop("class_rank", "of_class")


def half_sample(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Half of the rows (rounded down), without replacement."""
    keys = cut_points(df, id_col, None, seed, {"half": {None: df.count() // 2}})
    cut = F.lit(keys.get((0, "half"))).cast("string")
    return df.where(order_key(id_col, seed) <= cut)


def complement(df: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is not in the sample."""
    return df.join(sample.select(id_col), id_col, "left_anti")


def rank_in_class(
    df: DataFrame, id_col: str, target: str | None, seed: int = 42, of_class: DataFrame | None = None
) -> DataFrame:
    """Add ``class_rank``, 1 for the first row of its class in hash order.

    ``of_class`` (columns label, of_class) gives every row the value of its class.

    Rows are ranked inside (class, leading digits) and shifted by the rows of
    the slices before, so a class that holds most of the table is spread over
    all tasks. The slice sizes are at most classes x slices rows.
    """
    n_rows = df.count()
    digits = _digits(n_rows)
    keyed = df.withColumn("_label", _label(df, target)).withColumn("_key", order_key(id_col, seed))
    keyed = keyed.withColumn("_slice", F.substring("_key", 1, digits))
    sizes = keyed.groupBy("_label", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_label").orderBy("_slice")) - F.col("_n")
    offsets = sizes.select("_label", "_slice", before.alias("_before"))
    added = []
    if of_class is not None:
        offsets = offsets.join(of_class.select(F.col("label").alias("_label"), "of_class"), "_label")
        added = ["of_class"]
    place = F.row_number().over(W.partitionBy("_label", "_slice").orderBy("_key"))
    placed = keyed.withColumn("_place", place).join(offsets, ["_label", "_slice"])
    rank = (F.col("_place") + F.col("_before")).cast("bigint")
    return placed.withColumn("class_rank", rank).select(*df.columns, "class_rank", *added)


def kfold(df: DataFrame, id_col: str, target: str | None, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1, dealt out within each class."""
    if k < 2:
        raise SplitError("k-fold needs at least two folds")
    ranked = rank_in_class(df, id_col, target, seed)
    fold = F.pmod(F.col("class_rank") - 1, F.lit(k)).cast("int")
    return ranked.withColumn("fold", fold).drop("class_rank")


def split_sizes(df: DataFrame, target: str, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col, target).agg(F.count(F.lit(1)).alias("n_rows"))


def union_splits(parts: Sequence[DataFrame]) -> DataFrame:
    """The splits as one table again, matched by column name."""
    whole, *others = parts
    for part in others:
        whole = whole.unionByName(part)
    return whole
