"""Approximate k-nearest-neighbour join by random hyperplanes, opt-in beside the exact join.

Every row gets a bucket in each of several tables: the sides of a few random
hyperplanes it lies on. A query visits its own bucket of every table and those
reached by crossing its nearest hyperplanes. Rows that meet in a bucket are
compared exactly, so distances and their order are those of the exact join; only
neighbours that share no visited bucket are missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.plans.neighbors import _matrix, _unit, _vector, _with_fields, held_rows, tile_join
from sparktab.session import materialize

#: References a bucket should hold, which sets the number of hyperplanes of a table.
BUCKET_ROWS = 1024
TABLES, FLIPS, SEED = 8, 1, 42
MOST_BITS = 40
#: Rows sent to a task; what a task holds is the references of one bucket, at most a tile of them.
ROWS_PER_TASK = 200_000


def hyperplanes(dim: int, n: int, seed: int = SEED) -> np.ndarray:
    """Normals of random directions; each component comes from the digest of its place, so any engine can make them."""
    parts = [[md5(f"{seed}|{p}|{i}".encode(), usedforsecurity=False).hexdigest() for i in range(dim)] for p in range(n)]
    first = np.array([[int(h[:13], 16) for h in row] for row in parts], np.float64).reshape(n, dim)
    second = np.array([[int(h[13:26], 16) for h in row] for row in parts], np.float64).reshape(n, dim)
    return np.sqrt(-2 * np.log((first + 1) / 2**52)) * np.cos(2 * np.pi * second / 2**52)


def bucket_cells(points: np.ndarray, planes: np.ndarray, tables: int, flips: int) -> np.ndarray:
    """The cells of every row: table number and bucket, with all ways to cross the ``flips`` nearest hyperplanes."""
    bits = len(planes) // tables
    out = []
    for t in range(tables):
        margins = points @ planes[t * bits : (t + 1) * bits].T
        own = ((margins >= 0).astype(np.int64) << np.arange(bits)).sum(1)
        nearest = np.argsort(np.abs(margins), axis=1, kind="stable")[:, :flips]
        cells = own[:, None]
        for j in range(nearest.shape[1]):
            cells = np.hstack([cells, cells ^ (1 << nearest[:, j : j + 1])])
        out.append(cells + (t << MOST_BITS))
    return np.hstack(out)


def _centre(refs: DataFrame, dim: int) -> np.ndarray:
    """The mean of the reference vectors: sums per task, then per component."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch, "ref_vector").sum(0)
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total), pa.array([n] * dim, pa.int64())], names=["i", "s", "n"])

    rows = refs.select("ref_vector").mapInArrow(sums, "i int, s double, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    out = np.zeros(dim)
    for r in rows:
        out[r.i] = r.s / max(r.n, 1)
    return out


def _add_cells(df: DataFrame, vector: str, planes: np.ndarray, centre: np.ndarray | None, tables: int, flips: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch, vector)
            if points.shape[1] != planes.shape[1]:
                raise ValueError("query and reference vectors of unequal length")
            cells = bucket_cells(_unit(points) if centre is None else points - centre, planes, tables, flips)
            offsets = pa.array(np.arange(len(cells) + 1) * cells.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "cells"])

    return df.mapInArrow(add, _with_fields(df.schema, T.StructField("cells", T.ArrayType(T.LongType()))))


def knn_join_approx(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    *,
    id_col: str,
    vector_col: str,
    label_col: str | None = None,
    metric: str = "cosine",
    bar: str | None = None,
    tables: int = TABLES,
    bits: int | None = None,
    flips: int = FLIPS,
    seed: int = SEED,
    tile_rows: int | None = None,
) -> DataFrame:
    """Near reference rows of every query row: ``query_id, ref_id, [ref_label,] dist, rank``.

    Arguments, distances and ties are those of ``knn_join``. A query visits
    ``tables * 2^flips`` buckets; ``bits`` hyperplanes a table make 2^bits of them
    (by default about BUCKET_ROWS references in each). More tables or flips find
    more, more bits compare less; ``recall`` tells what a choice finds. A query
    may get fewer than k rows, or none.

    Of references with the same vector only the first can be neighbours, so the
    rest stays out before buckets are made; a bucket that is still larger than a
    tile is cut in parts on both sides, and pairs are never written out.
    """
    if metric not in ("cosine", "euclidean", "minkowski"):
        raise ValueError(f"unknown metric {metric!r}")
    if min(k, tables) < 1 or flips < 0:
        raise ValueError("k and tables must be at least 1, flips at least 0")
    barred = None if bar is None else "self" if bar == id_col else "group"
    q = queries.select(F.col(id_col).alias("query_id"), _vector(queries, vector_col).alias("query_vector"), *([F.col(bar).alias("query_bar")] if barred == "group" else []))
    r = refs.select(
        F.col(id_col).alias("ref_id"),
        _vector(refs, vector_col).alias("ref_vector"),
        *([F.col(label_col).alias("ref_label")] if label_col else []),
        *([F.col(bar).alias("ref_bar")] if barred == "group" else []),
    )
    q_names, r_names = q.columns, r.columns
    same = W.partitionBy(F.xxhash64("ref_vector"), "ref_vector", *(["ref_bar"] if barred == "group" else [])).orderBy("ref_id")
    once = r.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + (barred == "self")).drop("place")
    once = materialize(once, "references")
    size = once.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("ref_vector")).alias("d")).first()
    if not size.n:
        q = q.where("false")
    dim = max(size.d or 1, 1)
    bits = max(0, round(math.log2(max(size.n, 1) / BUCKET_ROWS))) if bits is None else bits
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be between 0 and {MOST_BITS}")
    planes = hyperplanes(dim, tables * bits, seed)
    centre = None if metric == "cosine" else _centre(once, dim)
    q = materialize(_add_cells(q, "query_vector", planes, centre, tables, min(flips, bits)), "visits")
    r = materialize(_add_cells(once, "ref_vector", planes, centre, tables, 0), "buckets")

    tile_rows = tile_rows or held_rows(dim)
    visits, held = (df.select(F.explode("cells").alias("cell")).groupBy("cell").count() for df in (q, r))
    large = visits.withColumnRenamed("count", "nq").join(held.withColumnRenamed("count", "nr"), "cell")
    large = large.where((F.col("nq") > tile_rows) | (F.col("nr") > tile_rows))
    parts = materialize(large.select("cell", F.ceil(F.col("nr") / tile_rows).cast("int").alias("r_parts"), F.ceil(F.col("nq") / tile_rows).cast("int").alias("q_parts")), "parts")

    def dealt(df: DataFrame, names: list[str], own: str, key: str, other: str) -> DataFrame:
        """A row in its own part, once for every part of the other side."""
        cells = df.select(*names, F.explode("cells").alias("cell")).join(parts, "cell", "left")
        mine = F.pmod(F.xxhash64(key), F.coalesce(f"{own}s", F.lit(1))).cast("int").alias(own)
        return cells.select(*names, "cell", mine, F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}s", F.lit(1)) - 1)).alias(other))

    fields = [q.schema["query_id"], r.schema["ref_id"], *([r.schema["ref_label"]] if label_col else []), T.StructField("dist", T.DoubleType())]
    n_queries = q.count()
    sent = n_queries * tables << min(flips, bits)
    tasks = max(math.ceil((sent + size.n * tables) / ROWS_PER_TASK), min(queries.sparkSession.sparkContext.defaultParallelism, tables << bits))
    found = tile_join(dealt(q, q_names, "q_part", "query_id", "r_part"), dealt(r, r_names, "r_part", "ref_id", "q_part"), k, metric, barred, T.StructType(fields), tasks)
    order = W.partitionBy("query_id").orderBy("dist", "ref_id")
    # a pair found in several tables lies beside itself in the order; repeated queries are told by nothing, as in the exact join
    once_each = found.withColumn("again", F.lag("ref_id").over(order)).where(~F.col("again").eqNullSafe(F.col("ref_id"))).drop("again")
    return once_each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``n_exact`` neighbours of the exact join, and the share of them ``found`` has (1 where there are none)."""
    hit = found.select("query_id", "ref_id", F.lit(1).alias("hit"))
    both = exact.select("query_id", "ref_id").join(hit, ["query_id", "ref_id"], "left")
    share = F.coalesce(F.try_divide(F.count("hit"), F.count(F.lit(1))), F.lit(1.0))
    return both.agg(F.count(F.lit(1)).alias("n_exact"), share.alias("recall"))
