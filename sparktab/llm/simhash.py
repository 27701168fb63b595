"""Near-duplicates by SimHash, with links found by the generalised pigeonhole principle.

Bits are grouped into partitions of correlated bits and each partition gets a
threshold of its own; thresholds plus one add up to the allowed distance plus
one, so a pair within the distance agrees in some partition up to that
partition's threshold. A dynamic programme over estimated candidate counts
chooses the thresholds; a threshold of -1 leaves a partition out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sparktab.llm.common import append, partitions, pick
from sparktab.llm.components import components
from sparktab.session import materialize

BITS, SEED = 64, 42
#: Fingerprints (expected number) from which bit correlations and candidate counts are estimated.
SAMPLE = 20_000
#: Members of a bucket from which it is cut into tiles; cost of a verified pair against a probe row.
TILE, PAIR_COST = 256, 0.01
ROWS_PER_TASK = 200_000
#: Row numbers (8 bytes each) that are sent to every task at most.
SENT_ROWS = 2_000_000
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint of the word shingles; 0 for null or a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    return majority(np.array([xxh64_intdigest(s, SEED) for s in shingles], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


@dataclass(frozen=True)
class Partition:
    """Bits (a signed 64-bit mask) probed up to a threshold; flips: masks of the probes beside the value itself."""

    mask: int
    threshold: int
    flips: tuple[int, ...]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _collisions(values: np.ndarray) -> int:
    counts = np.unique(values, return_counts=True)[1]
    return int((counts * (counts - 1) // 2).sum())


def _pairs_within(sample: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Pairs of the sample that differ in at most t of the bits, for t from 0 to most.

    Dropping each set of j bits and counting equal values counts a pair that
    differs in k bits comb(w-k, j-k) times, which is solved for k in turn.
    """
    w, exact = len(bits), []
    full = sum(1 << b for b in bits)
    for j in range(min(most, w) + 1):
        dropped = sum(_collisions(sample & np.uint64(full & ~sum(1 << b for b in s))) for s in combinations(bits, j))
        exact.append(dropped - sum(n * comb(w - k, j - k) for k, n in enumerate(exact)))
    return np.cumsum(exact).tolist()


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of equal size; each starts at the bit most correlated with the rest and takes its closest bits."""
    if len(sample) < 2:
        return [list(range(i, BITS, parts)) for i in range(parts)]
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    bits -= bits.mean(0)
    norm = np.sqrt((bits**2).sum(0))
    corr = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-12)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        start = max(sorted(left), key=lambda b: sum(corr[b, x] for x in left if x != b))
        group = [start]
        left.remove(start)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: sum(corr[b, x] for x in group))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def plan_partitions(sample: np.ndarray, rows: int, distance: int) -> list[Partition]:
    """The cheapest grouping and thresholds for so many fingerprints, by dynamic programming."""
    sample = np.asarray(sample, np.uint64)
    scale = (rows / max(1, len(sample))) ** 2
    best: tuple[float, list] | None = None
    for parts in range(2, distance + 2):
        groups = group_bits(sample, parts)
        deepest = min(distance, 2)
        costs = []
        for bits in groups:
            pairs = _pairs_within(sample, bits, 1 if len(bits) > 22 and deepest > 1 and len(sample) > 5000 else deepest)
            by = {-1: 0.0}
            for t, n in enumerate(pairs):
                by[t] = rows * sum(comb(len(bits), k) for k in range(t + 1)) + PAIR_COST * n * scale
            costs.append(by)
        need = distance + 1 - parts
        state: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for by in costs:
            step: dict[int, tuple[float, list]] = {}
            for total, (cost, chosen) in state.items():
                for t, c in by.items():
                    if total + t not in step or cost + c < step[total + t][0]:
                        step[total + t] = (cost + c, [*chosen, t])
            state = step
        if need in state and (best is None or state[need][0] < best[0]):
            best = (state[need][0], list(zip(groups, state[need][1], strict=True)))
    out = []
    for bits, t in best[1]:
        if t >= 0:
            flips = tuple(_signed(sum(1 << b for b in s)) for k in range(1, t + 1) for s in combinations(bits, k))
            out.append(Partition(_signed(sum(1 << b for b in bits)), t, flips))
    return out


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the pairs, those that join what was apart."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    for a, b in pairs:
        if (ra := find(a)) != (rb := find(b)):
            root[ra] = rb
            out.append((a, b))
    return out


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which signed fingerprints differ (of signed numbers numpy would count those of the absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _spread(values: np.ndarray, home: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Search from member to member of a large bucket: each member that is reached leaves the rest."""
    rest = np.arange(len(values))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = differing(values[rest], values[i]) <= distance
            if not home[i]:
                near &= home[rest]
            found = rest[near]
            yield from ((int(values[i]), int(values[j])) for j in found)
            queue.extend(found)
            rest = rest[~near]


def _links(distance: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = [b for b in batches if b.num_rows]
        if not keep:
            return
        got = pa.Table.from_batches(keep)
        cols = [got.column(c).to_numpy() for c in ("part", "value", "a", "b")]
        fp, home = got.column("fp").to_numpy(), got.column("home").to_numpy(zero_copy_only=False)
        order = np.lexsort((fp, *reversed(cols)))
        cols, fp, home = [c[order] for c in cols], fp[order], home[order]
        new = np.ones(len(fp), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        run_id = np.cumsum(new) - 1
        sizes = np.bincount(run_id)
        small = sizes[run_id] <= 32
        found: list[tuple[int, int]] = []
        s_fp, s_home, s_run = fp[small], home[small], run_id[small]
        for k in range(1, min(32, len(s_fp))):
            hit = s_run[k:] == s_run[:-k]
            if not hit.any():
                break
            hit &= (differing(s_fp[k:], s_fp[:-k]) <= distance) & (s_home[k:] | s_home[:-k]) & (s_fp[k:] != s_fp[:-k])
            at = np.flatnonzero(hit)
            found += zip(s_fp[at].tolist(), s_fp[at + k].tolist(), strict=True)
        starts = np.flatnonzero(new)
        for i in np.flatnonzero(sizes > 32):
            part = slice(starts[i], starts[i] + sizes[i])
            found += _spread(fp[part], home[part], distance)
        out = _forest(p for p in found if p[0] != p[1])
        for i in range(0, len(out), 50_000):
            u, v = zip(*out[i : i + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def _members(i: int, p: Partition) -> Column:
    """The rows of one fingerprint for one partition: its own value, and the values it probes."""
    value = F.col("fp").bitwiseAND(F.lit(p.mask))

    def row(x: Column, home: bool) -> Column:
        return F.struct(F.lit(i).alias("part"), x.alias("value"), F.lit(home).alias("home"))

    own = F.array(row(value, True))
    if not p.flips:
        return own
    return F.concat(own, F.transform(F.array(*map(F.lit, p.flips)), lambda x: row(value.bitwiseXOR(x), False)))


def hamming_links(nodes: DataFrame, rows: int, distance: int = 3) -> DataFrame:
    """Edges ``u, v`` that connect all fingerprints (column fp, distinct) within the distance.

    Each task returns a spanning forest of the links it verified, so no group is
    written as all its pairs, yet the components are those of all links. Buckets
    of more than TILE members are cut into about sqrt(members / TILE) tiles that
    meet in pairs: a task holds two tiles, never a whole hot bucket.
    """
    spark = nodes.sparkSession
    share = min(1.0, SAMPLE / max(1, rows))
    picked = nodes.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else nodes
    sample = np.array([r[0] for r in picked.select("fp").collect()], np.int64).astype(np.uint64)
    plan = plan_partitions(sample, rows, distance)
    members = F.concat(*[_members(i, p) for i, p in enumerate(plan)])
    rows_out = rows * sum(1 + len(p.flips) for p in plan)
    exploded = nodes.select("fp", F.explode(members).alias("m")).select("fp", "m.part", "m.value", "m.home")
    hot = materialize(exploded.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > TILE), "buckets")
    tiles = F.ceil(F.sqrt(F.coalesce("n", F.lit(1)) / TILE)).cast("long")
    dealt = exploded.join(hot, ["part", "value"], "left").withColumn("tiles", F.when(F.col("n").isNull(), 1).otherwise(tiles))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(2)), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select("part", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "home")
    dealt = dealt.repartition(partitions(spark, rows_out, ROWS_PER_TASK), "part", "value", "a", "b")
    return dealt.mapInArrow(_links(distance), "u long, v long")


def grouped(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``fp, first`` for each fingerprint: the least ``rank`` (nulls last) of its component.

    ``prints`` has columns fp (signed 64 bits) and rank (any ordered type).
    """
    smallest = F.min(F.struct(F.col("rank").isNull().alias("none"), F.col("rank").alias("rank"))).alias("first")
    nodes = materialize(prints.groupBy("fp").agg(smallest), "fingerprints")
    roots = components(hamming_links(nodes.select("fp"), nodes.count(), distance))
    placed = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = placed.groupBy("root").agg(F.min("first").alias("least"))
    return placed.join(firsts, "root").select("fp", F.col("least.rank").alias("first"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3, width: int = 3) -> DataFrame:
    """``id, fingerprint, component_id`` for every row.

    Texts are whole; a null text has no words, a text without words has
    fingerprint zero and links like any other. Repeated rows are rows of their
    own. A null id is ignored as long as its component has another id. An empty
    table gives an empty result; other columns are not looked at.
    """
    prints = append(pick(df, id=id_col, text=text_col), "text", lambda t: (simhash(t, width),), {"fp": "long"}).select("id", "fp")
    prints = materialize(prints, "prints")
    groups = grouped(prints.select("fp", F.col("id").alias("rank")), distance)
    out = prints.join(groups, "fp", "left")
    return out.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))
