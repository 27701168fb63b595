import random
import re

import numpy as np

from sparktab.llm.quality import COUNTS, Rule, fit_rules, learn_rules, quality, text_counts
from sparktab.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = {}
    for i in range(n - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_counts():
    rng = random.Random(4)
    texts = [None, "", " \n", "a", "x y \x1c z", "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h"]
    texts += [" ".join(rng.choices(["a", "b", "é#", "c\n", "\n"], k=rng.randint(1, 120))) for _ in range(200)]
    for t in texts:
        assert text_counts(None if t is None else t.encode())[:5] == plain(t)


def test_rules_find_the_thresholds():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.2) & (x[:, 2] > 0.5))
    rules = learn_rules(["a", "b", "c"], x, bad)
    covered = np.zeros(len(x), bool)
    for r in rules:
        covered |= r.covers(["a", "b", "c"], x)
    assert (covered & bad).sum() > 0.97 * bad.sum()
    assert (covered & ~bad).sum() < 0.02 * (~bad).sum()
    assert learn_rules(["a"], x[:, :1], np.zeros(len(x), bool)) == []
    assert learn_rules(["a"], x[:0, :1], bad[:0]) == []
    noise = learn_rules(["a", "b", "c"], x, rng.random(len(x)) < 0.3)
    assert len(noise) <= 2  # without a pattern hardly a rule is as precise as asked for


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op2_quality_rules"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed
        assert r.kept == (not failed and r.rule is None)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rules = fit_rules(docs, labels.where("doc_id % 2 = 0"))
    judged, _ = quality(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), rules)
    n = {(r.quality, r.kept): r["count"] for r in judged.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, False), 0) >= 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (4, 1), (4, 1), (5, 0), (99, 1)], "doc_id long, quality int")
    rules = fit_rules(odd, labels)
    judged, names = quality(odd, rules)
    assert judged.count() == 8
    assert set(odd.columns) < set(judged.columns)
    assert names["n_words"] != "n_words" and names["kept"] != "kept"
    rows = {r.doc_id: r[names["n_words"]] for r in judged.collect()}
    assert rows[1] == rows[2] == rows[3] == 0 and rows[5] == 200_001
    assert fit_rules(odd, labels.where("false")) == []
    assert fit_rules(none, labels) == []
    assert quality(none, [Rule((("words", ">", 1.0),))])[0].count() == 0
    assert list(COUNTS)[0] == "n_words"
