"""Hard negatives by angular triangle filtering.

Every row is stored with its norm and its angles to a few reference directions.
For an anchor and a row these angles give an interval of the angle between them
(triangle inequality on the sphere), its cosines times both norms an interval of
the score. Only rows whose interval overlaps a wanted window of scores get their
integer inner product; every result rests on such products alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.llm.common import NO_ID, Best, map_texts
from sparktab.session import materialize

#: Components are multiplied by this and rounded down, and held to so many bits.
SCALE, MOST_BITS = 256, 25
POSITIVES, NEGATIVES = 5, 10
#: A negative has between so many and so many hundredths of the positive's score.
LEAST_PERCENT, MOST_PERCENT = 30, 90
#: Reference directions, and rows they are chosen from.
DIRECTIONS, DIRECTION_ROWS = 8, 64
#: What arccos, cosine and the norms may be off by in all, as a share of the product of the norms.
SLACK = 1e-6
#: Bytes of anchors sent to the rows in one pass over the table, and rows of a block whose angles are bounded together.
SEND_BYTES, BLOCK = 32 << 20, 1024


def whole_vector(name: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, x as double; null where a component is null or not finite."""
    top = 1 << MOST_BITS
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(name, lambda x: F.greatest(F.lit(-top), F.least(F.lit(top), F.floor(F.lit(float(scale)) * x.cast("double")))).cast("int"))
    return F.when(F.coalesce(finite, F.lit(False)), whole)


def _lists(column: pa.Array) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def angles_to(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; a vector of zeros, whose scores are all 0, is put at right angles."""
    x = vectors.astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    cosines = x @ directions.T / np.where(norms > 0, norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def pick_directions(vectors: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors out of the given ones, each as far as can be from the line of those before."""
    norms = np.sqrt((vectors * vectors).sum(1))
    unit = vectors[norms > 0] / norms[norms > 0][:, None]
    chosen, near = [], np.zeros(len(unit))
    while len(unit) and len(chosen) < n:
        at = int(near.argmin())
        if chosen and near[at] > 1 - 1e-9:
            break
        chosen.append(unit[at])
        near = np.maximum(near, np.abs(unit @ unit[at]))
    return np.array(chosen).reshape(len(chosen), vectors.shape[1])


@dataclass
class _Anchors:
    """The anchors of one pass, by dimension of their vectors, with what they look for."""

    ids: np.ndarray
    labels: list
    vectors: np.ndarray
    directions: np.ndarray
    positives: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.norms, self.angles = angles_to(self.vectors, self.directions)
        self.place = {c: i for i, c in enumerate(dict.fromkeys(self.labels))}
        self.codes = np.array([self.place[c] for c in self.labels], np.int64)


class _Rows:
    """A block of rows with bounds of their scores with an anchor."""

    def __init__(self, ids: pa.Array, labels: pa.Array, vectors: np.ndarray, norms: np.ndarray, angles: np.ndarray, place: dict) -> None:
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.codes = np.array([place.get(c, -1) for c in labels.to_pylist()], np.int64)
        self.vectors, self.norms, self.angles = vectors.astype(np.int64), norms, angles
        self.least, self.most = angles.min(0), angles.max(0)
        self.biggest = norms.max()

    def highest(self, norm: float, angles: np.ndarray) -> float:
        """An upper bound of all scores of the block."""
        apart = np.maximum(self.least - angles, angles - self.most).max(initial=0.0)
        size = norm * self.biggest
        return max(size * np.cos(apart), 0.0) + SLACK * size + 1.0

    def bounds(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of each score, with room for rounding."""
        nearest = np.abs(self.angles - angles).max(1, initial=0.0)
        both = self.angles + angles
        farthest = np.minimum(both, 2 * np.pi - both).min(1, initial=np.pi)
        size = self.norms * norm
        off = SLACK * size + 1.0
        return size * np.cos(farthest) - off, size * np.cos(nearest) + off


def _search_positives(anchors: _Anchors, k: int):
    """Offers a block of rows to every anchor; rows of its label, itself left out."""
    best = [Best(k) for _ in anchors.ids]

    def offer(rows: _Rows) -> None:
        for i, found in enumerate(best):
            norm, angles = anchors.norms[i], anchors.angles[i]
            same = (rows.codes == anchors.codes[i]) & (rows.null | (rows.ids != anchors.ids[i]))
            if not same.any() or rows.highest(norm, angles) < found.floor():
                continue
            at = np.flatnonzero(same & (rows.bounds(norm, angles)[1] >= found.floor()))
            if len(at):
                found.add(rows.vectors[at] @ anchors.vectors[i], rows.ids[at], rows.null[at])

    def results():
        for i, found in enumerate(best):
            yield from ((anchors.ids[i], None if n else x, s) for s, x, n in zip(found.scores, found.ids, found.null, strict=True))

    return offer, results


def windows(positive: int, least: int = LEAST_PERCENT, most: int = MOST_PERCENT) -> tuple[int, int]:
    """The whole scores between so many hundredths of a positive's score, both ends included; empty if negative."""
    return -((-least * positive) // 100), most * positive // 100


def _search_negatives(anchors: _Anchors, k: int, least: int, most: int):
    """Offers a block of rows to every window of every anchor; rows of other labels."""
    looked = [[((place, p, s), *windows(s, least, most), Best(k)) for place, p, s in own] for own in anchors.positives]
    looked = [[w for w in own if w[1] <= w[2]] for own in looked]

    def offer(rows: _Rows) -> None:
        for i, own in enumerate(looked):
            norm, angles = anchors.norms[i], anchors.angles[i]
            if not own or rows.highest(norm, angles) < min(max(low, found.floor()) for _, low, _, found in own):
                continue
            lower, upper = rows.bounds(norm, angles)
            wanted = np.zeros(len(lower), bool)
            for _, low, high, found in own:
                wanted |= (upper >= max(low, found.floor())) & (lower <= high)
            at = np.flatnonzero(wanted & (rows.codes != anchors.codes[i]))
            if not len(at):
                continue
            scores = rows.vectors[at] @ anchors.vectors[i]
            for _, low, high, found in own:
                inside = (scores >= max(low, found.floor())) & (scores <= high)
                if inside.any():
                    found.add(scores[inside], rows.ids[at][inside], rows.null[at][inside])

    def results():
        for i, own in enumerate(looked):
            for positive, _, _, found in own:
                yield from ((anchors.ids[i], *positive, None if n else x, t) for t, x, n in zip(found.scores, found.ids, found.null, strict=True))

    return offer, results


def _pass(index: DataFrame, sent, search, names: list[str], schema: str) -> DataFrame:
    """One pass of the stored rows by the anchors; a task returns the best of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {size: (a, *search(a)) for size, a in sent.value.items()}
        for batch in batches:
            lengths = batch.column("q").value_lengths().to_numpy(zero_copy_only=False)
            for size, (anchors, offer, _) in searches.items():
                mine = batch.filter(pa.array(lengths == size)) if (lengths != size).any() else batch
                for at in range(0, mine.num_rows, BLOCK):
                    part = mine.slice(at, BLOCK)
                    angles = _lists(part.column("angles"))
                    offer(_Rows(part.column("id"), part.column("label"), _lists(part.column("q")), part.column("norm").to_numpy(), angles, anchors.place))
        for _, _, results in searches.values():
            made = list(results())
            if made:
                columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_texts(index, run, schema)


def angle_index(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``id, label, q, norm, angles`` of the rows that take part, written once, and the directions by dimension.

    Rows stay in their partition and lie by their nearest direction there, so that
    blocks of them have narrow ranges of angles. The directions come from at most
    DIRECTION_ROWS rows of the commonest dimension; rows of another have no angles
    and thus the widest bounds.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), whole_vector(vector_col, scale).alias("q"))
    rows = rows.where("label is not null and q is not null")
    sizes = rows.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0].d if sizes else 0
    some = rows.where(F.size("q") == dim).orderBy(F.xxhash64("q"), "id").limit(DIRECTION_ROWS).select("q").collect()
    directions = {dim: pick_directions(np.array([r.q for r in some], np.float64).reshape(len(some), dim))} if dim else {}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("q").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(lengths):
                part = batch.filter(pa.array(lengths == size))
                norms, angles = angles_to(_lists(part.column("q")), directions.get(int(size), np.zeros((0, int(size)))))
                nearest = angles.argmin(1) if angles.shape[1] else np.zeros(len(norms), np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(norms) + 1) * angles.shape[1], pa.int32()), pa.array(angles.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.filter(pa.array(lengths == size)).columns, pa.array(norms), lists, pa.array(nearest, pa.int32())], names=["id", "label", "q", "norm", "angles", "cell"])

    placed = map_texts(rows, place, "id long, label string, q array<int>, norm double, angles array<double>, cell int")
    return materialize(placed.sortWithinPartitions("cell", "norm").drop("cell"), "angles"), directions


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST_PERCENT,
    most: int = MOST_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Positives of an anchor are its best rows of the same label, negatives the best of
    other labels whose score lies within the percentages of the positive's. The score
    is the inner product of the whole vectors; ties go to the smaller id, null ids last.

    ``anchors`` is a condition on the columns of the table that picks the anchors; of
    rows that repeat an anchor's id the one of least label and vector is it, and no
    row of the anchor's own id is its positive. Repeated rows are rows of their own; a
    positive that repeats has its negatives each time.
    Rows with a null label, a null vector or a component that is null or not finite
    take no part, nor does an anchor without id; vectors are only compared with others
    of their length; components of more than 2^25 after scaling count as that. Other
    columns are not read. An empty table or one without anchors gives no rows.
    """
    spark = df.sparkSession
    index, directions = angle_index(df, id_col, vector_col, label_col, scale)
    picked = df.where(anchors).select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("string").alias("label"), whole_vector(vector_col, scale).alias("q")).alias("row"))
    picked = picked.where("id is not null and row.label is not null and row.q is not null").groupBy("id").agg(F.min("row").alias("row"))
    picked = materialize(picked.select("id", "row.label", "row.q"), "anchors")
    size = picked.agg(F.sum(F.size("q") + 8).alias("n")).first().n or 0
    passes = -(-8 * size // SEND_BYTES)
    out = []
    for i in range(passes):
        got = picked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == i).orderBy("id").collect()
        by_size: dict[int, list] = {}
        for r in got:
            by_size.setdefault(len(r.q), []).append(r)
        block = {
            d: _Anchors(np.array([r.id for r in rows], np.int64), [r.label for r in rows], np.array([r.q for r in rows], np.int64).reshape(len(rows), d), directions.get(d, np.zeros((0, d))))
            for d, rows in by_size.items()
        }
        sent = spark.sparkContext.broadcast(block)
        found = _pass(index, sent, lambda a: _search_positives(a, positives), ["anchor_id", "positive_id", "score"], "anchor_id long, positive_id long, score long")
        best = materialize(_first(found, ["anchor_id"], "score", "positive_id", positives), "positives")
        sent.destroy()
        held: dict[int, list] = {}
        for r in best.collect():
            held.setdefault(r.anchor_id, []).append((r.rank, r.positive_id, r.score))
        for a in block.values():
            a.positives = [held.get(int(x), []) for x in a.ids]
        sent = spark.sparkContext.broadcast(block)
        names = ["anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        found = _pass(index, sent, lambda a: _search_negatives(a, negatives, least, most), names, ", ".join(f"{n} long" for n in names))
        out.append(materialize(_first(found, ["anchor_id", "place", "positive_id", "positive_score"], "negative_score", "negative_id", negatives), "negatives"))
        sent.destroy()
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    made = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for part in out:
        made = part.select(*columns) if part is out[0] else made.unionByName(part.select(*columns))
    return made


def _first(found: DataFrame, keys: list[str], score: str, key: str, k: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc(score), F.col(key).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
