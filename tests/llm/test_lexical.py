"""Ranked search against scoring every document in plain code; the grid against its points."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from sparktab.llm import lexical
from sparktab.llm.common import Best
from sparktab.llm.lexical import Treap, ranked_search, terms_of, treap_index
from sparktab.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    held = [(key, Counter(plain_terms(t))) for key, t in docs]
    held = [(key, c) for key, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        wanted = set(plain_terms(text))
        scored = []
        for key, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted & set(c))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_same_as_sql(spark, small):
    assert difference(QUERIES["op12_ranked_search"](spark, small), connect(small), ORACLES["op12_ranked_search"]) is None


def test_terms():
    for text in (None, "", "A-b_C 9é\x7fÉ x1y", " .,;\n", "Straße'İ漢字\x00\x1cq"):
        assert [t.decode() for t in terms_of(None if text is None else text.encode())] == plain_terms(text)


@pytest.mark.parametrize("n", [1, 2, 17, 900])
def test_grid_holds_its_points(n):
    """Every row's path finds the row's points and their values, and only those; the tops are maxima."""
    rng = np.random.default_rng(n)
    places = rng.choice(60 * 200, n, replace=False)
    rows, cols, values = places // 200, places % 200, rng.integers(1, 1_000_000, n)
    treap = Treap.unpack(Treap.pack(rows, cols, values))
    assert treap.top[0] == values.max()
    for row in range(60):
        best = Best(1000)
        treap.search(np.array([row]), np.array([1]), best, np.arange(256), np.zeros(256, bool))
        assert sorted(zip(best.ids.tolist(), best.scores.tolist(), strict=True)) == sorted(zip(cols[rows == row].tolist(), values[rows == row].tolist(), strict=True))


@pytest.mark.parametrize("opened", [1, 256])
def test_search_is_exact(monkeypatch, opened):
    """Against summing the rows, with many equal scores and a floor from before."""
    monkeypatch.setattr(lexical, "OPENED", opened)
    rng = np.random.default_rng(5)
    places = rng.choice(80 * 500, 4000, replace=False)
    rows, cols, values = places // 500, places % 500, rng.integers(1, 4, 4000) * 1000
    treap = Treap.unpack(Treap.pack(rows, cols, values))
    for _ in range(20):
        mine, weights = rng.choice(80, 7, replace=False), rng.integers(1, 3, 7)
        own = np.zeros(80, np.int64)
        own[mine] = weights
        scores = np.bincount(cols, own[rows] * values, 500).astype(np.int64)
        order = np.lexsort((np.arange(500), -scores))[:10]
        best = Best(10)
        treap.search(mine, weights, best, np.arange(512), np.zeros(512, bool))
        assert best.scores.tolist() == scores[order].tolist() and best.ids.tolist() == order.tolist()


@pytest.mark.parametrize("postings, pairs", [(2_000_000, 500_000), (40, 30)])
def test_against_all_documents(spark, small, monkeypatch, postings, pairs):
    """One shard a task and many, one pass and many."""
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "PASS_TERMS", pairs)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").limit(4).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked_search(asked, treap_index(df))) == plain(docs, items)


def test_odd_rows(spark, odd):
    """Null, empty and very long texts, repeated rows and ids, ties, clashing columns on both sides."""
    docs = odd.selectExpr("*", "1 AS id", "2 AS terms", "3 AS row").unionByName(odd.selectExpr("*", "1 AS id", "2 AS terms", "3 AS row"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "one two three mit LICENSE"), (1, "word"), (2, None), (3, "; ;"), (None, "hunter2222 end word word"), (4, "nowhere"), (5, "ünï 漢字 é"), (6, "word " * 1000)]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS n", "3 AS terms")
    assert got(ranked_search(asked, treap_index(docs))) == plain(rows, items)
    assert got(ranked_search(asked, treap_index(docs), k=3)) == plain(rows, items, 3)


def test_empty_tables(spark, odd, none):
    asked = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search(asked, treap_index(none)).count() == 0
    out = ranked_search(asked.where("false"), treap_index(odd))
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
