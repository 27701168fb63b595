"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.session import materialize

MOST_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    return row[0], row[1]


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the smallest node reachable.

    Each round hangs larger neighbours and then smaller ones under the least
    neighbour (two joins on the node, minima combined before the shuffle) and
    writes the edges to the shared folder, so lineage stays short and a lost
    executor costs one round. Loops and edges with a null end are left out;
    repeated edges count once; an empty table gives an empty result.
    """
    edges = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = _state(edges)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
