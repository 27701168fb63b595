import hashlib
import itertools
import random
import re

import pytest

from pyspark.sql import functions as F

from sparktab.llm.queries import QUERIES
from sparktab.llm.secrets import find_secrets, guess_cost, load_words, mask_secrets, masked, secret_spans

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


@pytest.fixture(scope="module")
def words():
    return load_words()


def plain(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def base(spans):
    return [s for s in spans if s[0] != "guess"]


def test_base_patterns(words):
    rng = random.Random(6)
    bits = ["password", "PassWD", "token", "api_key", "apikey", "ſecret", "=", ":", " ", '"', "é", "abcdef12", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "\n", "漢"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 12)))
        assert base(find_secrets(text.encode(), words)[0]) == plain(text)


def test_cost_is_the_cheapest_segmentation(words):
    few = {"pass": 10, "word": 20, "password": 3, "dragon": 50}
    assert guess_cost("password", few) < guess_cost("dragonpass", few) < guess_cost("xk2qz9vw", few)

    def brute(value):
        """All cuts into listed words and single brute-force characters."""
        import math

        best = float(len(value))
        for cuts in itertools.product([0, 1], repeat=len(value) - 1):
            parts, part = [], value[0]
            for c, cut in zip(value[1:], cuts, strict=True):
                if cut:
                    parts.append(part)
                    part = ""
                part += c
            parts.append(part)
            cost, hard = 0.0, False
            for i, p in enumerate(parts):
                if p in few:
                    cost += math.log10(few[p] + 1) + (0.3 if i else 0.0)
                    hard = False
                else:
                    cost += len(p) + (0.0 if hard or not i else 0.3)
                    hard = True
            best = min(best, cost)
        return best

    for value in ("passq", "qpassz", "wordpass", "zzq", "xpasswordy", "dragonx1"):
        assert guess_cost(value, few) <= brute(value) + 1e-9
    for value in ("passqk", "qpassz", "wordpass", "dragonq8"):
        assert guess_cost(value, few) == pytest.approx(brute(value))


def test_weak_and_strong_values(words):
    weak = ["aaaaaaaaaaaa", "qwertyuiop", "12345678", "password", "20200131", "abcabcabcabc", "letmein"]
    strong = ["x9Kq2vLw8TzR", "7602ad27cf5550de1c", "gR4!kd83hZ"]
    assert max(guess_cost(v, words) for v in weak) < 8 <= min(guess_cost(v, words) for v in strong)
    assert guess_cost("ab" * 100_000, words) < 12


def test_contexts(words):
    spans, most = find_secrets("é pwd: x9Kq2vLw8TzR, url https://me:x9Kq2vLw8TzR@host bearer x9Kq2vLw8TzR".encode(), words)
    assert [s[0] for s in spans] == ["guess"] * 3 and most > 8
    assert all("é pwd: x9Kq2vLw8TzR, url https://me:x9Kq2vLw8TzR@host bearer x9Kq2vLw8TzR"[s:e] == "x9Kq2vLw8TzR" for _, s, e in spans)
    assert find_secrets(b"pwd: letmein", words)[0] == []


def test_masking(words):
    def find(t):
        return find_secrets(t, words)[0]

    assert masked(None, find) is None
    assert masked("né clean".encode(), find) == "né clean"
    assert masked(b"a password=x9Kq2vLw8TzR, b AKIAABCDEFGH1234ZZ", find) == "a [secret], b [secret]"


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op3_secret_scan"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        kinds = [k for k, _, _ in want]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()


def test_odd_rows(odd, none):
    narrow = odd.select("doc_id", "text", "kept", "host")
    rows = secret_spans(narrow).collect()
    assert len(rows) == 8
    assert {r.doc_id: r.n_assign for r in rows} == {1: 0, 2: 0, 3: 0, 4: 1, None: 1, 5: 0, 6: 0}
    out = mask_secrets(odd)
    assert out.columns == odd.columns and out.count() == 8
    assert secret_spans(none.select("doc_id", "text")).count() == mask_secrets(none).count() == 0


def test_taken_names(odd):
    """Columns that bear the new names keep their values; the new ones get underscores, with the same results."""
    plain = secret_spans(odd.select("doc_id", "text"))
    new = plain.columns[2:]
    both = odd.select("doc_id", "text", *[F.lit(f"own {c}").alias(c) for c in new])
    got = secret_spans(both)
    assert got.columns == ["doc_id", "text", *new, *[c + "_" for c in new]]
    assert sorted(map(repr, (tuple(r[c + "_"] for c in new) for r in got.collect()))) == sorted(map(repr, (tuple(r[c] for c in new) for r in plain.collect())))
    assert all(r[c] == f"own {c}" for r in got.collect() for c in new)
