"""Exact k-nearest-neighbour join as an equi-join on tiles.

Reference rows are put into cells, each cell around one of a few pivot rows,
and cells with many rows are cut into several tiles by a hash of the id.
A query row is sent only to the cells that can still hold one of its k
nearest rows; the triangle inequality on the distances to the pivots decides
that, so no neighbour is lost. If that rules out little (distances all alike),
or there are few rows, cells are left aside and the tiles are cut by hash alone.

Both sides are sorted by (cell, reference part, query part), references first.
A task holds the bounded references of one tile, whatever the skew, and its
queries pass by in batches; distances are matrix products, and k rows per query
come out; pairs are never written out. A window then merges the k best of each
tile. Small tiles do not make rows travel more often: see ``_parts``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of reference vectors (as floats) that a task holds.
TILE_BYTES = 64 << 20
CHUNK_CELLS = 1 << 18
CHUNK_QUERIES = 512
BLOCK_REFS = 2048
#: Times a row is sent at most for tiles that are smaller than a task holds.
MOST_COPIES = 4
#: Candidates per query and neighbour that are gathered before they are cut to the k best.
GATHERED = 2
MAX_PIVOTS = 512
MAX_BARS = 100
MAX_PIVOT_VALUES = 1 << 22
CELLS_PER_TILE = 4
RADIUS_STEPS = 64
MIN_TILE_PRODUCTS = 1 << 30
LOWEST_SCORE = -1e30
MAX_TASKS = 50_000
MOST_COMPARED = 0.5
#: Digits distances are ranked by, and cosine distances that are rounding of unit vectors.
DIGITS = 12
NO_DISTANCE = 1e-15
SLACK = 1e-8
SAFETY = 1e-6


def _matrix(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    """The vectors of a list column as a float64 matrix."""
    column = table.column(name)
    return _vectors(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, name)


def _vectors(column: pa.Array, name: str, floats: bool = False) -> np.ndarray:
    """The same of one array; with ``floats``, float arrays stay float."""
    n = len(column)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False)
    if not (floats and values.dtype == np.float32):
        values = values.astype(np.float64, copy=False)
    if column.null_count or flat.null_count or (n and len(values) % n):
        raise ValueError(f"{name}: missing vectors, missing values or unequal lengths")
    matrix = values.reshape(n, -1) if n else values.reshape(0, 0)
    lengths = column.value_lengths()
    if n and pc.min(lengths).as_py() != matrix.shape[1]:
        raise ValueError(f"{name}: vectors of unequal length")
    if not np.isfinite(matrix).all():
        raise ValueError(f"{name}: NaN or infinite values")
    return matrix


def _norms(matrix: np.ndarray) -> np.ndarray:
    """Lengths of the rows, 1 for zero rows."""
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    return np.where(norms > 0, norms, 1.0)


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    return matrix / _norms(matrix)[:, None]


def _points(matrix: np.ndarray, metric: str, side: int) -> np.ndarray:
    """Rows as points whose Euclidean distance orders like the metric.

    For cosine these are unit vectors. Two more axes take the zero vectors,
    one axis per side, which puts a zero vector at cosine distance 1 from all.
    """
    if metric != "cosine":
        return matrix
    unit = _unit(matrix)
    axes = np.zeros((len(unit), 2))
    axes[:, side] = ~unit.any(axis=1)
    return np.hstack([unit, axes])


def _spread(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of points to pivots, computed around the middle of the pivots."""
    middle = pivots.mean(axis=0)
    points, pivots = points - middle, pivots - middle
    squares = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :]
    return np.sqrt(np.maximum(squares - 2.0 * points @ pivots.T, 0.0))


def _matching(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs (i, j) with left[i] == right[j]."""
    order = np.argsort(right, kind="stable")
    low = np.searchsorted(right[order], left, "left")
    n = np.searchsorted(right[order], left, "right") - low
    rows = np.repeat(np.arange(len(left)), n)
    step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, order[np.repeat(low, n) + step]


def _places(rows: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
    return np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))


def _equal_rows(vectors: np.ndarray) -> np.ndarray:
    """A number for every row, the same for the same bytes."""
    data = np.ascontiguousarray(vectors)
    words = data.view(np.uint32 if data.itemsize == 4 else np.uint64)
    odd = np.random.default_rng(0).integers(0, 1 << 63, words.shape[1], np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.empty(len(data), np.uint64)
    for at in range(0, len(data), BLOCK_REFS):
        part = words[at : at + BLOCK_REFS].astype(np.uint64)
        keys[at : at + BLOCK_REFS] = ((part ^ (part >> np.uint64(15))) * odd).sum(axis=1, dtype=np.uint64)
    _, first, same = np.unique(keys, return_index=True, return_inverse=True)
    for at in range(0, len(data), BLOCK_REFS):
        if (words[at : at + BLOCK_REFS] != words[first[same[at : at + BLOCK_REFS]]]).any():
            whole = data.view(np.dtype((np.void, data.itemsize * data.shape[1]))).ravel()
            return np.unique(whole, return_inverse=True)[1]
    return same


def _first_of_equal(vectors: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Rows among the first n of their (equal vector, group), which are all that can win."""
    keep = np.ones(len(vectors), dtype=bool)
    if not vectors.size:
        return keep if len(vectors) <= n else _places(np.zeros(len(vectors))) < n
    same = _equal_rows(vectors)
    order = np.lexsort((np.arange(len(same)), groups, same))
    runs = same[order].astype(np.int64) * (int(groups.max(initial=0)) + 1) + groups[order]
    keep[order[_places(runs) >= n]] = False
    return keep


class _Nearest:
    """The k nearest reference rows of chunks of query rows.

    A matrix product gives a score that grows as the distance falls; it only
    has to be right up to ``slack``. Rows that may be among the k best are kept
    and their distance is then computed exactly.
    """

    def __init__(self, refs: np.ndarray, metric: str, k: int, ref_bars: np.ndarray | None = None, few: bool = True) -> None:
        """``ref_bars``: what bars pairs, a number for each reference; ``few``: of which each bars few."""
        self.metric, self.k, self.refs = metric, k, refs
        self.ref_bars, self.few = ref_bars, few
        if metric == "cosine":
            self.shift, self.half_squares = None, None
            self.norms, self.screen = np.empty(len(refs)), np.empty(refs.shape, np.float32)
            for at in range(0, len(refs), BLOCK_REFS):
                part = refs[at : at + BLOCK_REFS].astype(np.float64)
                self.norms[at : at + BLOCK_REFS] = _norms(part)
                self.screen[at : at + BLOCK_REFS] = part / self.norms[at : at + BLOCK_REFS, None]
        else:
            self.shift = refs.mean(axis=0, dtype=np.float64)
            self.screen = refs - self.shift
            self.half_squares = np.einsum("ij,ij->i", self.screen, self.screen) / 2

    def _scores(self, queries: np.ndarray, block: slice) -> np.ndarray:
        scores = queries @ self.screen[block].T
        if self.half_squares is not None:
            scores -= self.half_squares[block]
        return scores

    def _slack(self, squares: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far a score may be off, and how much rounding may hide."""
        dim = self.screen.shape[1]
        if self.metric == "cosine":
            return np.full(len(squares), (dim + 8) * 1.2e-7 + 4e-9)
        gap = np.sqrt(np.maximum(squares - 2 * np.where(np.isfinite(least), least, 0.0), 0.0))
        size = squares + 2 * self.half_squares.max()
        hidden = 2.0 * 10.0 ** (1 - DIGITS) * gap * gap
        return (dim + 8) * 1e-15 * size + 4e-9 * (gap + np.sqrt((dim + 8) * 1e-15 * size) + 1e-9) + hidden

    def _exact(self, queries: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Distances to DIGITS significant digits; cosine as half the square of the gap of unit vectors."""
        out = np.empty(len(rows))
        step = max(1, CHUNK_CELLS // max(1, queries.shape[1]))
        for at in range(0, len(rows), step):
            q, chosen = queries[rows[at : at + step]], cols[at : at + step]
            r = self.refs[chosen].astype(np.float64, copy=False)
            if self.metric == "cosine":
                r = r / self.norms[chosen, None]
            gap = q - r
            squares = np.einsum("ij,ij->i", gap, gap)
            if self.metric == "cosine":
                dist = np.where(q.any(axis=1) & r.any(axis=1), squares / 2, 1.0)
                out[at : at + step] = np.where(dist < NO_DISTANCE, 0.0, np.minimum(dist, 2.0))
            else:
                out[at : at + step] = np.sqrt(squares)
        return significant(out)

    def _bar(self, block: np.ndarray, bars: np.ndarray, start: int) -> None:
        ref_bars = self.ref_bars[start : start + BLOCK_REFS]
        if self.few:
            i, j = _matching(bars, ref_bars)
            block[i, j] = -np.inf
        else:
            np.putmask(block, bars[:, None] == ref_bars[None, :], -np.inf)

    def _above(self, block: np.ndarray, squares: np.ndarray, least: np.ndarray) -> np.ndarray:
        floor = np.maximum(least - self._slack(squares, least), LOWEST_SCORE)
        return block >= floor.astype(block.dtype)[:, None]

    def __call__(self, queries: np.ndarray, bars: np.ndarray | None):
        """Query rows, reference rows and distances of the k nearest.

        Candidates are cut to the k best by exact distance and place whenever
        there are many, so rows that tie with many references hold few of them;
        the k-th distance so far is the bar for the blocks that follow.
        """
        k, n = self.k, len(queries)
        queries = queries.astype(np.float64, copy=False)
        if self.metric == "cosine":
            queries = _unit(queries)
            screen = queries.astype(np.float32)
            squares = np.ones(n)
        else:
            screen = queries - self.shift
            squares = (screen * screen).sum(axis=1)
        least = np.full(n, -np.inf)
        rows = cols = np.zeros(0, dtype=np.int64)
        dist = np.zeros(0)
        held, fresh = [], 0
        for start in range(0, len(self.refs), BLOCK_REFS):
            block = self._scores(screen, slice(start, start + BLOCK_REFS))
            if bars is not None:
                self._bar(block, bars, start)
            wanted = self._above(block, squares, least)
            if block.shape[1] > k and np.count_nonzero(wanted) > GATHERED * k * n:
                least = np.maximum(least, -np.partition(-block, k - 1, axis=1)[:, k - 1])
                wanted = self._above(block, squares, least)
            i, j = np.divmod(np.flatnonzero(wanted), block.shape[1])
            held.append((i, j + start))
            fresh += len(i)
            last = start + BLOCK_REFS >= len(self.refs)
            if not last and fresh < GATHERED * k * n // 2:
                continue
            new_rows, new_cols = (np.concatenate(part) for part in zip(*held, strict=True))
            held, fresh = [], 0
            rows, cols = np.concatenate([rows, new_rows]), np.concatenate([cols, new_cols])
            dist = np.concatenate([dist, self._exact(queries, new_rows, new_cols)])
            order = np.lexsort((cols, dist, rows))
            places = _places(rows[order])
            order, places = order[places < k], places[places < k]
            rows, cols, dist = rows[order], cols[order], dist[order]
            full = places == k - 1
            kth = dist[full]
            reached = 1.0 - kth if self.metric == "cosine" else (squares[rows[full]] - kth * kth) / 2
            least[rows[full]] = np.maximum(least[rows[full]], reached)
        return rows, cols, dist


def significant(values: np.ndarray, digits: int = DIGITS) -> np.ndarray:
    """Numbers rounded to so many significant digits; 0 stays 0."""
    size = np.floor(np.log10(np.where(values > 0, values, 1.0)))
    return np.where(values > 0, np.round(values / 10.0**size, digits - 1) * 10.0**size, 0.0)


def nearest_distinct(nearest: _Nearest, queries: np.ndarray):
    """The same for any number of queries, without bars; equal queries are searched once."""
    once, same = np.unique(queries, axis=0, return_inverse=True)
    same = same.ravel()
    parts = [nearest(once[at : at + CHUNK_QUERIES], None) for at in range(0, len(once), CHUNK_QUERIES)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rows = np.concatenate([p[0] + i * CHUNK_QUERIES for i, p in enumerate(parts)])
    cols, dist = (np.concatenate([p[x] for p in parts]) for x in (1, 2))
    sizes = np.bincount(rows, minlength=len(once))
    starts = np.cumsum(sizes) - sizes
    repeat = sizes[same]
    out = np.repeat(np.arange(len(queries)), repeat)
    pick = np.repeat(starts[same], repeat) + _places(out)
    return out, cols[pick], dist[pick]


class _Tile:
    """The references of one tile, sorted by id, so that the first of equal ones win."""

    def __init__(self, batches: list[pa.RecordBatch], k: int, metric: str, bar: str | None) -> None:
        vectors = np.concatenate([_equal_lengths(_vectors(b.column("ref_vector"), "ref_vector", floats=True), batches) for b in batches])
        names = [n for n in ("ref_id", "ref_label", "ref_bar") if n in batches[0].schema.names]
        table = pa.Table.from_batches([b.select(names) for b in batches]).combine_chunks()
        codes = None
        self.values = None
        if bar:
            coded = table.column("ref_id" if bar == "self" else "ref_bar").combine_chunks().dictionary_encode(null_encoding="encode")
            codes, self.values = coded.indices.to_numpy(), coded.dictionary
        groups = codes if bar == "group" else np.zeros(len(vectors), np.int64)
        keep = _first_of_equal(vectors, groups, k + 1 if bar == "self" else k)
        if not keep.all():
            table, vectors = table.filter(pa.array(keep)), vectors[keep]
            codes = codes[keep] if bar else None
        self.table, self.bar = table, bar
        self.nearest = _Nearest(vectors, metric, k, codes, bar == "self")

    def search(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """Query ids, places of references and distances, chunk by chunk."""
        ids, queries = batch.column("query_id"), _vectors(batch.column("query_vector"), "query_vector", floats=True)
        if queries.shape[1] != self.nearest.refs.shape[1]:
            raise ValueError("query and reference vectors of unequal length")
        if not self.bar:
            rows, cols, dist = nearest_distinct(self.nearest, queries)
            yield ids.take(pa.array(rows)), cols, dist
            return
        barred = ids if self.bar == "self" else batch.column("query_bar")
        bars = pc.fill_null(pc.index_in(barred, value_set=self.values), -1).to_numpy()
        for at in range(0, len(ids), CHUNK_QUERIES):
            rows, cols, dist = self.nearest(queries[at : at + CHUNK_QUERIES], bars[at : at + CHUNK_QUERIES])
            yield ids.take(pa.array(rows + at)), cols, dist


def _equal_lengths(vectors: np.ndarray, batches: list[pa.RecordBatch]) -> np.ndarray:
    if vectors.shape[1] != len(batches[0].column("ref_vector")[0]):
        raise ValueError("ref_vector: vectors of unequal length")
    return vectors


TILE = ("cell", "r_part", "q_part")


def _tile_join(k: int, metric: str, bar: str | None, names: list[str]):
    """The k nearest references of each query of rows sorted by tile, references before queries.

    ``bar`` is "self" where the barred column is the row id, "group" for
    other columns.
    """

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*TILE, "queries")]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in keys])
        starts = np.r_[0, np.flatnonzero(new) + 1]
        for at, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield tuple(c[at] for c in keys[:3]), bool(keys[3][at]), batch.slice(at, end - at)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, refs, tile = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, queries, part in runs(batch):
                if key != current:
                    current, refs, tile = key, [], None
                if not queries:
                    refs.append(part)
                    continue
                if refs:
                    tile, refs = _Tile(refs, k, metric, bar), []
                if tile is None:
                    continue
                for ids, cols, dist in tile.search(part):
                    at = pa.array(cols)
                    found = [tile.table.column(n).combine_chunks().take(at) for n in names[1:-1]]
                    yield pa.RecordBatch.from_arrays([ids, *found, pa.array(dist)], names=names)

    return join


def tile_join(queries: DataFrame, refs: DataFrame, k: int, metric: str, bar: str | None, fields: T.StructType, tasks: int) -> DataFrame:
    """Both sides, dealt to tiles, brought together and joined; ranks are not merged yet."""
    sides = queries.withColumn("queries", F.lit(True)).unionByName(refs.withColumn("queries", F.lit(False)), allowMissingColumns=True)
    return sides.repartition(tasks, *TILE).sortWithinPartitions(*TILE, "queries", "ref_id").mapInArrow(_tile_join(k, metric, bar, fields.fieldNames()), fields)


def _place_refs(pivots: np.ndarray, metric: str):
    """Adds the nearest pivot and the distance to it."""

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            spread = _spread(_points(_matrix(batch, "ref_vector"), metric, 1), pivots)
            cell = spread.argmin(axis=1)
            columns = [*batch.columns, pa.array(cell.astype(np.int32))]
            columns.append(pa.array(spread[np.arange(len(cell)), cell]))
            names = [*batch.schema.names, "cell", "reach"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return place


def _route_queries(pivots: np.ndarray, metric: str, cells: dict[str, np.ndarray]):
    """Adds the cells that may hold one of the k nearest references."""
    ids, nearest, farthest, kth = (cells[c] for c in ("cell", "nearest", "farthest", "kth"))
    between = _spread(pivots, pivots)

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            spread = _spread(_points(_matrix(batch, "query_vector"), metric, 0), pivots)
            home = spread.argmin(axis=1)
            here = spread[:, ids]
            # What the distances may be off by, taken off every lower bound.
            size = 1.0 + spread.max(axis=1, keepdims=True) + between.max()
            off = SAFETY * size
            bound = (here + kth[None, :]).min(axis=1, keepdims=True) + off
            apart = between[home][:, ids]
            at_home = spread[np.arange(len(home)), home][:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (here**2 - at_home**2 - off**2) / (2.0 * apart)
            plane = np.where(apart > off, plane, 0.0)
            least = np.maximum.reduce([here - farthest, nearest - here, plane]) - off
            wanted = np.maximum(least, 0.0) ** 2 <= bound**2 + SLACK
            offsets = np.concatenate([[0], np.cumsum(wanted.sum(axis=1))]).astype(np.int32)
            chosen = np.broadcast_to(ids, wanted.shape)[wanted].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=[*batch.schema.names, "cells"]
            )

    return route


def _with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


def _pick_pivots(refs: DataFrame, n: int, metric: str) -> np.ndarray:
    """A few reference rows in hash order; at most MAX_PIVOTS rows reach the driver."""
    rows = refs.select("ref_id", "ref_vector").orderBy(F.xxhash64("ref_id"), "ref_id").limit(n)
    vectors = np.array([r.ref_vector for r in rows.collect()], dtype=np.float64)
    return np.unique(_points(vectors, metric, 1), axis=0)


def _cell_bounds(placed: DataFrame, needed: int, barring: bool) -> dict[str, np.ndarray]:
    """Per cell: rows, nearest and farthest reach, and a radius sure to hold enough rows.

    The radius comes from a histogram of the reach, so no cell is gathered.
    ``needed`` rows must lie inside it after the rows barred for any query
    are taken out.
    """
    reach = placed.groupBy("cell").agg(F.max("reach").alias("farthest"), F.min("reach").alias("nearest"))
    edges = {r.cell: (r.nearest, r.farthest) for r in reach.collect()}
    ids = np.array(sorted(edges), dtype=np.int64)
    nearest = np.array([edges[i][0] for i in ids])
    farthest = np.array([edges[i][1] for i in ids])
    width = max(float(farthest.max()), 1e-12) / RADIUS_STEPS
    step = F.least(F.floor(F.col("reach") / F.lit(width)), F.lit(RADIUS_STEPS - 1)).cast("int")
    keys = ["cell", "step"] + (["ref_bar"] if barring else [])
    counted = placed.withColumn("step", step).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if barring:
        counted = counted.groupBy("cell", "step").agg(F.sum("n").alias("n"), F.collect_list(F.struct("ref_bar", "n")).alias("bars"))
    rows = counted.collect()
    kth = np.full(len(ids), np.inf)
    n_rows = np.zeros(len(ids), dtype=np.int64)
    per_cell: dict[int, dict[int, object]] = {}
    for row in rows:
        per_cell.setdefault(row.cell, {})[row.step] = row
    for at, cell in enumerate(ids):
        total, bars = 0, {}
        for s in range(RADIUS_STEPS):
            row = per_cell[cell].get(s)
            if row is None:
                continue
            total += row.n
            if barring:
                for bar in row.bars:
                    bars[bar.ref_bar] = bars.get(bar.ref_bar, 0) + bar.n
            if np.isinf(kth[at]) and total - max(bars.values(), default=0) >= needed:
                kth[at] = min((s + 1) * width * (1 + 1e-9), farthest[at])
        n_rows[at] = total
    return {"cell": ids, "nearest": nearest, "farthest": farthest, "kth": kth, "n": n_rows}


def _vector(df: DataFrame, name: str) -> Column:
    """The vector column; float arrays stay float, which halves what is shuffled."""
    floats = isinstance(df.schema[name].dataType, T.ArrayType) and isinstance(
        df.schema[name].dataType.elementType, T.FloatType
    )
    return F.col(name) if floats else F.col(name).cast("array<double>")


def _parts(n_queries: int, n_refs: int, dim: int, tile_rows: int, parallel: int) -> tuple[int, int]:
    """Reference parts and query parts of a cell: full tiles, or more of them for idle cores.

    Every reference part sends the queries once more, every query part the
    references. Tiles smaller than a task holds are therefore made only as long
    as a row is sent MOST_COPIES times at most: what is sent grows with the
    rows, not with their square.
    """
    holds = max(tile_rows, held_rows(dim))

    def cut(n: int) -> int:
        return max(min(math.ceil(max(n, 1) / tile_rows), MOST_COPIES), math.ceil(n / holds))

    r_parts = cut(n_refs)
    worth = math.ceil(n_queries * n_refs * dim / r_parts / MIN_TILE_PRODUCTS)
    return r_parts, max(cut(n_queries), min(worth, math.ceil(parallel / r_parts)))


def held_rows(dim: int) -> int:
    """Rows of this many values that a task holds."""
    return max(1024, TILE_BYTES // (4 * max(dim, 1)))


def _tasks(parallel: int, n_tiles: int) -> int:
    """Room to spread few tiles, several tiles per task for many."""
    if n_tiles == 1:
        return 1
    return 4 * n_tiles if n_tiles <= parallel else min(MAX_TASKS, max(4 * parallel, n_tiles // 4))


def _count_both(queries: DataFrame, refs: DataFrame) -> tuple[int, int]:
    """Row counts of two tables in one job."""
    sides = [df.select(F.lit(side).alias("side")) for side, df in enumerate((queries, refs))]
    rows = sides[0].unionByName(sides[1]).groupBy("side").count().collect()
    counts = {row.side: row["count"] for row in rows}
    return counts.get(0, 0), counts.get(1, 0)


@dataclass
class _Routed:
    """References with their cell, queries with the cells to visit, and counts per cell."""

    queries: DataFrame
    refs: DataFrame
    sizes: dict[int, int]
    visits: dict[int, int]


def _cells(
    q: DataFrame, r: DataFrame, pivots: int, metric: str, needed: int, barring: bool
) -> _Routed | None:
    """Route by cells; None where the counts per barred value would be too many for the driver."""
    if barring and r.select("ref_bar").distinct().limit(MAX_BARS + 1).count() > MAX_BARS:
        return None
    points = _pick_pivots(r, pivots, metric)
    placed = _with_fields(
        r.schema, T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())
    )
    r = r.mapInArrow(_place_refs(points, metric), placed)
    cells = _cell_bounds(r, needed, barring)
    visiting = _with_fields(q.schema, T.StructField("cells", T.ArrayType(T.IntegerType())))
    q = q.mapInArrow(_route_queries(points, metric, cells), visiting)
    seen = q.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()
    return _Routed(
        queries=q,
        refs=r.drop("reach"),
        sizes=dict(zip(cells["cell"].tolist(), cells["n"].tolist(), strict=True)),
        visits={row.cell: row["count"] for row in seen},
    )


def knn_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    *,
    id_col: str,
    vector_col: str,
    label_col: str | None = None,
    metric: str = "cosine",
    bar: str | None = None,
    tile_rows: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """The k nearest reference rows of every query row.

    Returns ``query_id, ref_id, [ref_label,] dist, rank``; distances have twelve
    significant digits and ties go to the smaller reference id. ``bar`` names a
    column of both sides; pairs with equal values in it are not compared (the
    id for a self join, the fold for cross-validation).
    """
    if metric not in ("cosine", "euclidean", "minkowski"):
        raise ValueError(f"unknown metric {metric!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    q_cols = [F.col(id_col).alias("query_id"), _vector(queries, vector_col).alias("query_vector")]
    r_cols = [F.col(id_col).alias("ref_id"), _vector(refs, vector_col).alias("ref_vector")]
    if label_col:
        r_cols.append(F.col(label_col).alias("ref_label"))
    barred = None if bar is None else "self" if bar == id_col else "group"
    if barred == "group":
        q_cols.append(F.col(bar).alias("query_bar"))
        r_cols.append(F.col(bar).alias("ref_bar"))
    q, r = queries.select(*q_cols), refs.select(*r_cols)
    q_fields, r_fields = q.schema, r.schema

    n_queries, n_refs = _count_both(queries, refs)
    first = r.select(F.size("ref_vector").alias("d")).first()
    dim = first.d if first else 1
    tile_rows = tile_rows or held_rows(dim)
    if pivots is None:
        pivots = 1 if n_refs <= tile_rows else math.ceil(CELLS_PER_TILE * n_refs / tile_rows)
    pivots = max(1, min(pivots, MAX_PIVOTS, MAX_PIVOT_VALUES // max(dim, 1)))

    routed = None
    if pivots > 1:
        routed = _cells(q, r, pivots, metric, k + (barred == "self"), barred == "group")
    if routed is not None:
        compared = sum(routed.visits.get(cell, 0) * n for cell, n in routed.sizes.items())
        routed = routed if compared <= MOST_COMPARED * n_queries * n_refs else None
    if routed is None:
        cells, sizes, visits = ("0", "array(0)"), {0: n_refs}, {0: n_queries}
    else:
        cells, sizes, visits = ("cell", "cells"), routed.sizes, routed.visits
        q, r = routed.queries, routed.refs

    parallel = queries.sparkSession.sparkContext.defaultParallelism
    grid = {c: _parts(visits.get(c, 0), size, dim, tile_rows, parallel) for c, size in sizes.items()}
    n_tiles = sum(a * b for a, b in grid.values())
    layout = ", ".join(f"{c}, named_struct('r', {a}, 'q', {b})" for c, (a, b) in grid.items())
    q_names, r_names = q_fields.fieldNames(), r_fields.fieldNames()
    q = q.selectExpr(*q_names, f"explode({cells[1]}) as cell")
    q = q.selectExpr("*", f"map({layout})[cell] as parts")
    q = q.selectExpr(*q_names, "cell", "cast(pmod(xxhash64(query_id), parts.q) as int) as q_part", "explode(sequence(0, parts.r - 1)) as r_part")
    r = r.selectExpr(*r_names, f"{cells[0]} as cell", f"map({layout})[{cells[0]}] as parts")
    r = r.selectExpr(*r_names, "cell", "cast(pmod(xxhash64(ref_id), parts.r) as int) as r_part", "explode(sequence(0, parts.q - 1)) as q_part")

    out = [q_fields["query_id"], r_fields["ref_id"], *([r_fields["ref_label"]] if label_col else [])]
    out.append(T.StructField("dist", T.DoubleType()))
    found = tile_join(q, r, k, metric, barred, T.StructType(out), _tasks(parallel, n_tiles))
    order = W.partitionBy("query_id").orderBy("dist", "ref_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
