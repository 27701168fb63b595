import hashlib

import numpy as np
import pytest

from sparktab.llm import mixing
from sparktab.llm.mixing import Margins, mix, rake, topic
from sparktab.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference


def fitted(n, targets, rounds):
    """Iterative proportional fitting on a dense array."""
    w = n / n.sum()
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            other = tuple(a for a in range(w.ndim) if a != axis)
            shape = [1] * w.ndim
            shape[axis] = -1
            w = w * (np.asarray(target) / w.sum(axis=other)).reshape(shape)
    return w


def test_rake(spark):
    rng = np.random.default_rng(10)
    n = rng.integers(1, 100, (4, 3, 2)).astype(float)
    n[0] *= 50
    targets = [[0.1, 0.2, 0.3, 0.4], [0.5, 0.25, 0.25], [0.3, 0.7]]
    rows = [(f"a{i}", f"b{j}", f"c{k}", float(n[i, j, k])) for i in range(4) for j in range(3) for k in range(2)]
    margins = Margins(("a", "b", "c"), {x: {f"{x}{i}": t for i, t in enumerate(ts)} for x, ts in zip("abc", targets, strict=True)})
    got = {(r.a, r.b, r.c): r.w for r in rake(spark.createDataFrame(rows, "a string, b string, c string, n double"), margins, 8).collect()}
    want = fitted(n, targets, 8)
    for i in range(4):
        for j in range(3):
            for k in range(2):
                assert got[f"a{i}", f"b{j}", f"c{k}"] == pytest.approx(want[i, j, k], rel=1e-9)
    for axis, target in enumerate(targets):
        assert np.allclose(want.sum(axis=tuple(a for a in range(3) if a != axis)), target, atol=1e-4)


def test_probabilities_meet_the_margins(spark):
    folder = "/root/testdata/sf0.1"
    mixed, _ = mix(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source", "lang"))
    rows = mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept").collect()
    assert max(r.probability for r in rows) == pytest.approx(1.0) and min(r.probability for r in rows) > 0
    expected = sum(r.probability * r.n_tokens for r in rows)
    for column in ("source", "lang", "topic"):
        tokens, drawn = {}, {}
        for r in rows:
            tokens[r[column]] = tokens.get(r[column], 0) + r.n_tokens
            drawn[r[column]] = drawn.get(r[column], 0) + r.probability * r.n_tokens
        tempered = {k: v**mixing.TEMPER for k, v in tokens.items()}
        for k, v in tempered.items():
            assert drawn[k] / expected == pytest.approx(v / sum(tempered.values()), abs=2e-3)
    kept = sum(r.n_tokens for r in rows if r.kept)
    assert kept == pytest.approx(expected, rel=0.1)
    for r in rows[:200]:
        u = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) / 2**52
        assert r.kept == (u < r.probability)


def test_native_plan(spark, small):
    plan = mix(spark.read.parquet(f"{small}/documents.parquet"))[0]._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", ["op4_url_filter", "op6_mix"])
def test_same_as_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None


def test_topics(spark):
    texts = [(None, "none"), ("", "none"), ("plain words", "prose"), ("a | b | c", "table"), ("#### x $$$ %", "markup"), ("1234 and 99", "figures"), ("é" * 300 + "|", "prose")]
    df = spark.createDataFrame(texts, "text string, want string")
    assert df.withColumn("got", topic(df.text)).where("got <> want").count() == 0


def test_odd_rows(spark, odd, none):
    mixed, names = mix(odd)
    rows = mixed.collect()
    assert len(rows) == 8 and names["weight"] != "weight" and names["kept"] != "kept"
    assert all(0 < r[names["probability"]] <= 1 for r in rows)
    assert len({r[names["kept"]] for r in rows if r.doc_id == 4}) == 1
    assert mix(none)[0].count() == 0
    given, names = mix(odd, Margins(("source", "lang"), {"lang": {"x": 0.5, "y": 0.5}}))
    rows = given.collect()
    assert len(rows) == 8 and all((r[names["probability"]] > 0) == (r.lang is not None) for r in rows)
    unmet, names = mix(odd, Margins(("lang",), {"lang": {"z": 1.0}}))
    assert not any(r[names["kept"]] for r in unmet.collect())
