"""Near copies by word shingles: candidates by SimHash, the rest by bands, every link verified on whole shingle sets.

Texts of the same words are one node. A node has the SimHash of its shingles;
fingerprints within a few bits are found by the generalised pigeonhole principle
(``simhash.hamming_links``), and the nodes of a group of them meet in a bucket,
where their whole shingle sets are compared.

Pairs of the wanted similarity mostly lie some ten bits apart, which no pigeonhole
over 64 bits can index. So a node also has the minima of its shingle hashes under
fixed permutations, and nodes that agree in all minima of some band meet as well.
Bands come in rounds: a bucket whose members the rounds before have linked needs
no second look, so most texts are sent once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sparktab.llm.common import append, fresh, map_texts, partitions, texts_of
from sparktab.llm.components import components
from sparktab.llm.simhash import SEED, TILE, hamming_links, majority
from sparktab.session import materialize

#: Words of a shingle, and the least Jaccard similarity of near copies.
WIDTH, SIMILAR = 5, 0.8
#: Bits in which fingerprints of candidates differ at most.
DISTANCE = 3
#: Bands and minima in a band: a pair of similarity s meets with chance 1 - (1 - s^4)^32, at 0.8 all but 5 in 10^8.
BANDS, MINIMA = 32, 4
#: The first band of each round, and the end: most links show in the first bands.
ROUNDS = (0, 4, BANDS)
TEXTS_PER_TASK = 4_000
#: Digests with an id or a bucket (some 100 bytes each) that are sent to every task at most.
SENT_ROWS = 250_000
_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 1 << 64, BANDS * MINIMA, np.uint64, endpoint=False)
_MULTIPLY = _RNG.integers(0, 1 << 64, BANDS * MINIMA, np.uint64, endpoint=False) | np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text with words is one shingle."""
    if len(words) < width:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    return np.unique(np.array([xxh64_intdigest(s, SEED) for s in shingles], np.uint64))


def bands(hashes: np.ndarray) -> bytes:
    """Eight bytes for each band, folded from its minima."""
    least = np.full(BANDS * MINIMA, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, ((hashes[i : i + 512, None] ^ _XOR) * _MULTIPLY).min(0), out=least)
    out = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, MINIMA).T:
        out = (out ^ (out >> np.uint64(29)) ^ column) * _FOLD
    return out.tobytes()


def similar_links(sets: list[np.ndarray], similar: float = SIMILAR) -> list[tuple[int, int]]:
    """A spanning forest of all pairs of non-empty sets with at least that Jaccard similarity."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    there = np.zeros(int(numbers.max()) + 1, np.int64)
    apart, out = np.ones(len(sets), bool), []
    for first in range(len(sets)):
        if not apart[first]:
            continue
        apart[first], queue = False, [first]
        while queue and apart.any():
            i = queue.pop()
            own = numbers[starts[i] : starts[i] + sizes[i]]
            there[own] = 1
            common = np.add.reduceat(there[numbers], starts)
            there[own] = 0
            found = np.flatnonzero(apart & (common + 1e-9 >= similar * (sizes + sizes[i] - common)))
            apart[found] = False
            out += [(i, int(j)) for j in found]
            queue.extend(found.tolist())
    return out


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or b"").lower().split()


def digest_of(words: list[bytes]) -> bytes:
    return md5(b" ".join(words), usedforsecurity=False).digest()


def _prints(rows: DataFrame, width: int) -> DataFrame:
    """``id, digest, fp, bands`` for every row; the last two only where a task sees the digest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests, prints, made = [], [], []
            for words in map(words_of, texts_of(batch.column(1))):
                digests.append(digest_of(words))
                hashes = None if digests[-1] in seen else shingle_set(words, width)
                prints.append(None if hashes is None else majority(hashes) if len(hashes) else 0)
                made.append(None if hashes is None else bands(hashes))
                seen.add(digests[-1])
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(prints, pa.int64()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "fp", "bands"])

    return map_texts(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, digest binary, fp long, bands binary")


def _one_text_each(rows: DataFrame) -> DataFrame:
    """``digest, text``, each digest once for every task that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests, first = [], []
            for text in texts_of(batch.column(0)):
                digests.append(digest_of(words_of(text)))
                first.append(digests[-1] not in seen)
                seen.add(digests[-1])
            out = pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0)], names=["digest", "text"])
            yield out.filter(pa.array(first, pa.bool_()))

    return map_texts(rows.select("text"), run, "digest binary, text string")


def by_fingerprint(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``node, digest, root, band, key``: one key for the nodes whose fingerprints such distances connect."""
    prints = materialize(nodes.select("fp").distinct(), "fingerprints")
    groups = components(hamming_links(prints, prints.count(), distance))
    met = nodes.join(groups.select(F.col("node").alias("fp"), F.col("root").alias("group")), "fp", "left")
    return met.select("node", "digest", "root", F.lit(-1).alias("band"), F.coalesce("group", "fp").alias("key"))


def by_bands(nodes: DataFrame, first: int, end: int) -> DataFrame:
    """The same for these bands: one key for the nodes that agree in all minima of one."""
    members = nodes.select("node", "digest", "root", "bands", F.explode(F.sequence(F.lit(first), F.lit(end - 1))).alias("band"))
    return members.select("node", "digest", "root", "band", F.expr("substring(bands, band * 8 + 1, 8)").alias("key"))


def shingle_links(members: DataFrame, rows: DataFrame, width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """Edges ``u, v`` that connect all nodes whose texts are similar and that meet under a key of some band.

    ``members`` has columns node, digest, band, key and root, the group known so far;
    ``rows`` has column text. Buckets within one group are left out, buckets of the same members
    count once. A bucket of more than TILE members is cut into tiles that meet in pairs;
    a task holds two tiles at a time and returns a forest, never all pairs. Texts are
    sent to their buckets once, and their shingle sets made there.
    """
    spark = members.sparkSession
    sums = [F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    buckets = members.groupBy("band", "key").agg(*sums).where("low <> high").groupBy("n", "low", "high", "x", "y").agg(F.min(F.struct("band", "key")).alias("b"))
    tiles = F.ceil(F.sqrt(F.col("n") / TILE)).cast("long")
    buckets = materialize(buckets.select("b.band", "b.key", tiles.alias("tiles"), F.monotonically_increasing_id().alias("bucket")), "buckets")
    dealt = members.join(buckets, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = materialize(dealt.select("digest", "node", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")), "dealt")
    sent = dealt.count()
    texts = _one_text_each(rows).join(F.broadcast(dealt) if sent <= SENT_ROWS else dealt, "digest")
    group = ["bucket", "a", "b"]
    met = texts.repartition(partitions(spark, sent, TEXTS_PER_TASK), *group).sortWithinPartitions(*group, "node")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (tuple(x.as_py() for x in row) for b in batches for row in zip(*[b.column(c) for c in (*group, "node", "text")], strict=True))
        for _, members in groupby(given, lambda r: r[:3]):
            held = {node: text for *_, node, text in members}
            named, sets = list(held), [shingle_set(words_of((t or "").encode()), width) for t in held.values()]
            found = similar_links(sets, similar) if len(sets) > 1 else []
            if found:
                u, v = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([named[i] for i in u], pa.int64()), pa.array([named[i] for i in v], pa.int64())], names=["u", "v"])

    return map_texts(met.select(*group, "node", "text"), link, "u long, v long")


def shingle_groups(nodes: DataFrame, rows: DataFrame, width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """``nodes`` (node, digest, fp, bands, ...) with ``root``, the least node of the group of similar texts."""
    roots = None
    for first, end in [(None, None), *pairwise(ROUNDS)]:
        known = nodes.select("node", "digest", "fp", "bands")
        if roots is None:
            known = known.withColumn("root", F.col("node"))
        else:
            known = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        members = by_fingerprint(known) if first is None else by_bands(known, first, end)
        links = shingle_links(members, rows, width, similar)
        if roots is not None:
            links = links.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = components(links)
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def shingle_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """The table with one row of each group of near copies: that of the least id, nulls last.

    Words stand between ASCII white space, A-Z in lower case. Texts of the same words
    are copies, so all without words (null ones too) are one group; links of similarity
    ``similar`` or more are followed through. Of rows that repeat the id and the words
    of the row that stays, the one whose values have the least digest stays. Nothing of
    the table is written but ids, digests, fingerprints and bands; it is read once for them,
    once for the fingerprints' links, once for each round of bands and once for the result, and digests and ids of the copies go to
    the rows.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = materialize(_prints(rows, width), "prints")
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"))
    nodes = prints.groupBy("digest").agg(F.min(rank).alias("first"), F.first("fp", ignorenulls=True).alias("fp"), F.first("bands", ignorenulls=True).alias("bands"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = materialize(shingle_groups(nodes, rows, width, similar).select("digest", "root", "first"), "groups")
    winners = placed.groupBy("root").agg(F.min(F.struct("first", "digest")).alias("best")).select("best.digest", F.col("best.first.id").alias("id"))

    digest = fresh(df, "shingle_digest")
    same = [F.col("digest") == F.col(digest), F.col("id").eqNullSafe(F.col("kept_id"))]
    counted = prints.groupBy("digest", "id").agg(F.count("*").alias("n"))
    won = winners.select(F.col("digest").alias(digest), F.col("id").alias("kept_id"))
    gone = materialize(counted.join(won, same, "left_anti").select("digest", "id"), "copies")
    again = materialize(counted.where("n > 1").join(won, same, "left_semi").select("digest", "id"), "repeats")

    key, row = fresh(df, "shingle_key"), fresh(df, "shingle_row")
    marked = append(df, text_col, lambda t: (digest_of(words_of(t)),), {digest: "binary"}).withColumn(key, F.col(id_col))
    theirs, theirs_id = fresh(df, "copy_digest"), fresh(df, "copy_id")
    met = (F.col(digest) == F.col(theirs)) & F.col(key).eqNullSafe(F.col(theirs_id))

    def sent(side: DataFrame) -> DataFrame:
        named = side.select(F.col("digest").alias(theirs), F.col("id").alias(theirs_id))
        return F.broadcast(named) if side.count() <= SENT_ROWS else named

    kept = marked.join(sent(gone), met, "left_anti")
    if again.isEmpty():
        return kept.select(*df.columns)
    values = F.struct(*df.columns)
    once = kept.join(sent(again), met, "left_semi").groupBy(digest, key).agg(F.min_by(values, F.sha2(F.to_json(values), 256)).alias(row))
    return kept.join(sent(again), met, "left_anti").select(*df.columns).unionByName(once.select(f"{row}.*"))
