import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from sparktab.llm.components import components
from sparktab.llm.queries import QUERIES
from sparktab.llm.simhash import hamming_links, plan_partitions, simhash, simhash_groups


def plain_print(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in words.replace(b"\n", b" ").replace(b"\t", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Root per value by comparing all pairs."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    rng = random.Random(1)
    for text in [None, "", "One", "one TWO", "a b c", *(" ".join(rng.choices("aA bB c d é x".split(" "), k=n)) for n in (3, 4, 9, 50))]:
        assert simhash(None if text is None else text.encode()) % (1 << 64) == plain_print(text)


@pytest.mark.parametrize("rows", [100, 1_000_000, 10**9])
def test_plan_leaves_no_pair_out(rows):
    rng = np.random.default_rng(2)
    sample = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    plan = plan_partitions(sample, rows, 3)
    signed = [x % (1 << 64) for p in plan for x in [p.mask]]
    assert sum(m.bit_count() for m in signed) <= 64
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))
        assert any((diff & m).bit_count() <= p.threshold for p, m in zip(plan, signed, strict=True))


def test_links_with_a_hot_group(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    prints = {center}
    while len(prints) < 900:  # all share many blocks: buckets beyond a tile
        prints.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5]))))
    while len(prints) < 1500:
        prints.add(rng.getrandbits(64))
    df = spark.createDataFrame([(as_signed(p),) for p in prints], "fp long")
    links = hamming_links(df, len(prints))
    assert all(((r.u ^ r.v) % (1 << 64)).bit_count() <= 3 for r in links.collect())
    assert links.count() < 8 * len(prints)
    got = {r.node: r.root for r in components(links).collect()}
    want = plain_components([as_signed(p) % (1 << 64) for p in prints])
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(got.get(as_signed(p), as_signed(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (None, 3), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    prints = {r.doc_id: plain_print(r.text) for r in docs}
    roots = plain_components(prints.values())
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, small).collect()}
    assert got == {d: (f"{p:016x}", least[roots[p]]) for d, p in prints.items()}


def test_odd_rows(odd, none):
    rows = simhash_groups(odd).collect()
    assert len(rows) == 8
    assert {r.component_id for r in rows if r.id in (1, 2, 3)} == {1}
    assert Counter(r.component_id for r in rows)[4] == 3
    assert simhash_groups(none).count() == 0
