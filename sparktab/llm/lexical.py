"""Ranked word search by K2-treaps over the grid of terms and documents.

Documents are dealt into shards. A shard keeps its terms (commonest first) as rows
and its documents as columns of a grid whose points are postings, weighted with
their impact. The grid is a quadtree without empty cells: a cell with several
points has a mask of its quarters, one with a single point the rest of that
point's path; every cell has the largest impact below it, stored as the fall from
its parent. A search follows the rows of all terms of an item at once, best
document range first, and ends when no range can reach the k-th score.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from zstandard import compress, decompress

from sparktab.llm.common import NO_ID, Best, map_texts, pick, texts_of
from sparktab.session import materialize

RANKS = 10
#: A shard ends with the document that brings it to so many postings or documents.
SHARD_POSTINGS, SHARD_DOCS = 2_000_000, 16_384
#: Pairs of item and term sent to the shards in one pass, and ranges opened at a time.
PASS_TERMS, OPENED = 500_000, 256

#: ASCII characters other than digits and letters end a term; A-Z are lowered.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_POPULATION = np.array([bin(i).count("1") for i in range(16)], np.int32)


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a text with repeats, in order."""
    return (text or b"").translate(_TABLE).split()


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a score a term of weight 1 gives, in whole numbers."""
    length = 100 - 90 + (90 * n.astype(np.int64) * n_docs) // n_terms
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * length)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2^32, a zero between each two."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class Treap:
    """Cells level by level, the children of a cell beside each other in the order of their quarters.

    ``mask`` has the quarters of a cell (row half times two plus column half) that hold
    points, 0 for a cell of one point, whose ``tail_row`` and ``tail_col`` are the lower
    bits of its place. ``first`` is the first child, ``top`` the largest impact.
    """

    height: int
    mask: np.ndarray
    first: np.ndarray
    top: np.ndarray
    tail_row: np.ndarray
    tail_col: np.ndarray

    @classmethod
    def pack(cls, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> dict[str, bytes | int]:
        """The stored form of points (at least one, no place twice)."""
        height = max(1, int(max(rows.max(), cols.max())).bit_length())
        codes = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(codes)
        codes, values, rows, cols = codes[order], values[order], rows[order], cols[order]
        masks, falls, sizes, tail_rows, tail_cols = [], [], [1], [], []
        inside, tops = np.arange(len(codes)), np.array([values.max()])
        root = int(tops[0])
        lone_rows, lone_cols = ([rows[:1]], [cols[:1]]) if len(codes) == 1 else ([], [])
        if len(codes) == 1:
            masks.append(np.zeros(1, np.uint8))
            inside = inside[:0]
        split = np.ones(1, bool)  # which cells of the level have several points
        for level in range(1, height + 1):
            if not len(inside):
                break
            prefix = codes[inside] >> np.uint64(2 * (height - level))
            starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            here = prefix[starts]
            points = np.diff(np.r_[starts, len(inside)])
            parent = here >> np.uint64(2)
            parent_starts = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            mask = np.zeros(len(split), np.uint8)
            mask[split] = np.bitwise_or.reduceat((1 << (here & np.uint64(3))).astype(np.uint8), parent_starts)
            masks.append(mask)
            below = np.maximum.reduceat(values[inside], starts)
            children = np.diff(np.r_[parent_starts, len(here)])
            falls.append(np.repeat(tops[split], children) - below)
            sizes.append(len(here))
            tops, split = below, points > 1
            lone = inside[starts[~split]]
            low = (1 << (height - level)) - 1
            lone_rows.append(rows[lone] & low)
            lone_cols.append(cols[lone] & low)
            inside = inside[np.repeat(split, points)]
            if not len(inside):
                masks.append(np.zeros(len(split), np.uint8))
        tail_rows, tail_cols = np.concatenate(lone_rows), np.concatenate(lone_cols)
        return {
            "height": height,
            "top": root,
            "sizes": np.array(sizes, np.int32).tobytes(),
            "mask": np.concatenate(masks).tobytes(),
            "falls": np.concatenate([*falls, np.zeros(0, np.int64)]).astype(np.int32).tobytes(),
            "tail_rows": tail_rows.astype(np.int32).tobytes(),
            "tail_cols": tail_cols.astype(np.int32).tobytes(),
        }

    @classmethod
    def unpack(cls, stored: dict) -> Treap:
        sizes = np.frombuffer(stored["sizes"], np.int32)
        mask = np.frombuffer(stored["mask"], np.uint8)
        falls = np.frombuffer(stored["falls"], np.int32)
        children = _POPULATION[mask]
        first = np.cumsum(children, dtype=np.int32) - children + 1
        top = np.empty(len(mask), np.int32)
        top[0], at = stored["top"], 1
        for above, size in zip(sizes[:-1], sizes[1:], strict=True):
            parents = slice(at - above, at)
            top[at : at + size] = np.repeat(top[parents], children[parents]) - falls[at - 1 : at - 1 + size]
            at += size
        lone = mask == 0
        tails = []
        for name in ("tail_rows", "tail_cols"):
            whole = np.zeros(len(mask), np.int32)
            whole[lone] = np.frombuffer(stored[name], np.int32)
            tails.append(whole)
        return cls(stored["height"], mask, first, top, *tails)

    def _open(self, nodes: np.ndarray, levels: np.ndarray, rows: np.ndarray, side: int) -> np.ndarray:
        """The cells of the terms in the left or right half of document ranges; -1 where a term has none."""
        there = np.maximum(nodes, 0)
        shift = (self.height - 1 - levels)[:, None]
        mask = self.mask[there]
        lone = mask == 0
        quarter = 2 * ((rows >> shift) & 1) + side
        child = np.minimum(self.first[there] + _POPULATION[mask & ((1 << quarter) - 1)], len(self.mask) - 1)
        has = (nodes >= 0) & ((mask >> quarter) & 1 == 1) & ((self.mask[child] != 0) | (self.tail_row[child] == rows & ((1 << shift) - 1)))
        stays = lone & (nodes >= 0) & ((self.tail_col[there] >> shift) & 1 == side)
        return np.where(stays, nodes, np.where(has & ~lone, child, -1))

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray) -> None:
        """Adds to ``best`` every document that can be among the k best by the sum over these rows.

        Ranges are opened by falling bound, OPENED at a time; a bound is the sum of weight
        times largest impact over the cells of all terms. At the last level it is the score.
        """
        rows, weights = np.asarray(rows, np.int64), np.asarray(weights, np.int64)
        nodes = np.zeros((1, len(rows)), np.int64)
        if not self.mask[0]:
            nodes[0, self.tail_row[0] != rows] = -1
        levels, ranges = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bounds = self._bound(nodes, weights)
        while True:
            open_ = bounds >= max(best.floor(), 1)
            if not open_.all():
                nodes, levels, ranges, bounds = nodes[open_], levels[open_], ranges[open_], bounds[open_]
            if not len(bounds):
                return
            now = np.zeros(len(bounds), bool)
            now[np.argpartition(-bounds, OPENED - 1)[:OPENED] if len(bounds) > OPENED else slice(None)] = True
            halves = [self._open(nodes[now], levels[now], rows, side) for side in (0, 1)]
            made = np.concatenate(halves)
            level = np.tile(levels[now] + 1, 2)
            place = np.concatenate([2 * ranges[now], 2 * ranges[now] + 1])
            bound = self._bound(made, weights)
            last = level == self.height
            done = last & (bound >= max(best.floor(), 1))
            if done.any():
                best.add(bound[done], ids[place[done]], null[place[done]])
            more = ~last & (bound >= max(best.floor(), 1))
            rest = ~now
            nodes = np.concatenate([nodes[rest], made[more]])
            levels, ranges, bounds = np.r_[levels[rest], level[more]], np.r_[ranges[rest], place[more]], np.r_[bounds[rest], bound[more]]

    def _bound(self, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.where(nodes >= 0, self.top[np.maximum(nodes, 0)], 0) @ weights


class _Shard:
    """Collects the postings of documents until there are enough for a grid."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.ids, self.terms, self.tf, self.distinct, self.lengths = [], array("i"), array("i"), array("i"), array("q")

    def add(self, key: int | None, words: list[bytes]) -> None:
        found = Counter(words)
        self.ids.append(key)
        self.terms.extend([self.numbers[w] for w in found])
        self.tf.extend(found.values())
        self.distinct.append(len(found))
        self.lengths.append(len(words))

    def full(self) -> bool:
        return len(self.terms) >= SHARD_POSTINGS or len(self.ids) >= SHARD_DOCS

    def row(self, n_docs: int, n_terms: int) -> dict:
        """The shard as stored: ids, terms (commonest first) with their document counts, and the grid."""
        terms, distinct = np.frombuffer(self.terms, np.int32), np.frombuffer(self.distinct, np.int32)
        counts = np.bincount(terms, minlength=len(self.numbers))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        values = impacts(np.frombuffer(self.tf, np.int32), np.repeat(np.frombuffer(self.lengths, np.int64), distinct), n_docs, n_terms)
        grid = Treap.pack(place[terms], np.repeat(np.arange(len(self.ids)), distinct), values)
        names = list(self.numbers)
        return {"ids": self.ids, "terms": b" ".join([names[i] for i in order]), "counts": counts[order].astype(np.int32).tobytes(), **grid}


SHARD_SCHEMA = "ids array<long>, terms binary, counts binary, height int, top int, sizes binary, mask binary, falls binary, tail_rows binary, tail_cols binary"
_ARROW = {"ids": pa.list_(pa.int64()), "height": pa.int32(), "top": pa.int32()}


@dataclass
class TreapIndex:
    """Stored shards, the number of documents with a term, and the number of all their terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def treap_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> TreapIndex:
    """The index of all whole texts: one pass to count terms, one to write the shards.

    Documents stay in their partition and are dealt into shards there, so nothing is
    shuffled; a shard holds a bounded number of postings, but for one text's own.
    Every row is a document of its own, whatever its id; null texts have no terms.
    """
    docs = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [len(terms_of(t)) for batch in batches for t in texts_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array([sum(s > 0 for s in sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], names=["n", "terms"])

    total = map_texts(docs.select("text"), tell, "n long, terms long").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).first()
    n_docs, n_terms = total.n or 0, total.terms or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for key, text in zip(batch.column(0), texts_of(batch.column(1)), strict=True):
                if words := terms_of(text):
                    shard.add(key.as_py(), words)
                if shard.full():
                    yield _stored(shard.row(n_docs, n_terms))
                    shard = _Shard()
        if shard.ids:
            yield _stored(shard.row(n_docs, n_terms))

    return TreapIndex(materialize(map_texts(docs, build, SHARD_SCHEMA), "treaps"), n_docs, n_terms)


def _stored(row: dict) -> pa.RecordBatch:
    packed = {k: compress(v, 1) if isinstance(v, bytes) else v for k, v in row.items()}
    return pa.RecordBatch.from_arrays([pa.array([v], _ARROW.get(k, pa.binary())) for k, v in packed.items()], names=list(row))


def _read(value: pa.Scalar) -> bytes | int:
    held = value.as_py()
    return decompress(held) if isinstance(held, bytes) else held


def _places(terms: pa.Array, stored: bytes) -> np.ndarray:
    """The rows of terms in a shard, -1 where it has none."""
    return pc.fill_null(pc.index_in(terms, value_set=pa.array(stored.split(b" "), pa.binary())), -1).to_numpy()


def ranked_search(items: DataFrame, index: TreapIndex, k: int = RANKS, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item, scores above 0 only.

    An item's terms count once each. Equal scores go by ascending document id, null
    ids last. Items without terms (null texts too) have no rows; items that repeat are
    searched for themselves. Items go to the shards in blocks of a bounded number of
    terms, two passes a block: document counts of its terms, then the search, in which
    a task returns k rows an item. Other columns are not read.
    """
    spark = items.sparkSession
    wanted = pick(items, item=item_col, text=text_col).withColumn("item", F.col("item").cast("long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(set(terms_of(t))) for t in texts_of(batch.column(1))]
            columns = [batch.column(0), pa.array(sets, pa.list_(pa.binary())), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "terms", "n"])

    stored = materialize(map_texts(wanted, cut, "item long, terms array<binary>, n long").where("n > 0").withColumn("row", F.monotonically_increasing_id()), "items")
    passes = -(-(stored.agg(F.sum("n")).first()[0] or 0) // PASS_TERMS)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for i in range(passes):
        block = [(r.item, [bytes(t) for t in r.terms]) for r in stored.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == i).orderBy("row").collect()]
        terms = sorted({t for _, own in block for t in own})
        sent = spark.sparkContext.broadcast(terms)
        df = {r.term: r.n for r in _counted(index.shards, sent).groupBy("term").agg(F.sum("n").alias("n")).collect()}
        sent.destroy()
        number = {t: j for j, t in enumerate(terms)}
        weights = np.array([weight(df.get(j, 0), index.n_docs) for j in range(len(terms))], np.int64)
        sent = spark.sparkContext.broadcast((terms, weights, [np.array([number[t] for t in own]) for _, own in block]))
        found = _searched(index.shards, sent, k)
        order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        found = materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
        sent.destroy()
        named = spark.createDataFrame(list(enumerate(r[0] for r in block)), "item long, item_id long")
        out = out.unionByName(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def _counted(shards: DataFrame, sent) -> DataFrame:
    """``term, n``: in how many documents of a task's shards each of the terms occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total = pa.array(sent.value, pa.binary()), np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for own, counts in zip(batch.column(0), batch.column(1), strict=True):
                at = _places(terms, _read(own))
                total += np.where(at >= 0, np.frombuffer(_read(counts), np.int32)[at], 0)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], names=["term", "n"])

    return map_texts(shards.select("terms", "counts"), run, "term long, n long")


def _searched(shards: DataFrame, sent, k: int) -> DataFrame:
    """``item, doc_id, score``: the k best documents of each item among a task's shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, items = sent.value
        terms, best = pa.array(names, pa.binary()), [Best(k) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: _read(batch.column(c)[i]) for c in batch.schema.names if c != "ids"}
                keys = batch.column("ids").slice(i, 1).flatten()
                ids, null = keys.fill_null(NO_ID).to_numpy(zero_copy_only=False), keys.is_null().to_numpy(zero_copy_only=False)
                at, treap = _places(terms, row["terms"]), Treap.unpack(row)
                for own, found in zip(items, best, strict=True):
                    mine = own[(at[own] >= 0) & (weights[own] > 0)]
                    if len(mine):
                        treap.search(at[mine], weights[mine], found, ids, null)
        made = [(i, None if n else x, s) for i, b in enumerate(best) for s, x, n in zip(b.scores, b.ids, b.null, strict=True)]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made, strict=True)], names=["item", "doc_id", "score"])

    return map_texts(shards.drop("counts"), run, "item long, doc_id long, score long")
