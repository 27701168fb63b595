import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from sparktab.llm.pii import BASE, find_pii, iban_valid, luhn, pii_spans
from sparktab.llm.queries import QUERIES

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="a1@.-+ ()%é0259\n", max_size=40))
def test_base_is_that_of_the_patterns(text):
    assert [s for s in find_pii(text) if s[0] in BASE] == plain(text)


def test_base_in_longer_mixtures():
    rng = random.Random(11)
    bits = ["4337166598464399", "4111 1111 1111 1111", "-", " ", ".", "255", "256.1.1.1", "1.2.3.4", "0001.02.3.4", "+1 (988) 555-2485", "a.b@c-d.e", "@", "x", "漢", "+", "12"]
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 10)))
        assert [s for s in find_pii(text) if s[0] in BASE] == plain(text), text


@pytest.mark.parametrize(
    "text,kind,value",
    [
        ("pay to IBAN: DE89 3704 0044 0532 0130 00 now", "iban", "DE89 3704 0044 0532 0130 00"),
        ("account no. 1234567890 closed", "account", "1234567890"),
        ("SSN 078-05-1120.", "ssn", "078-05-1120"),
        ("see https://me:pw@host.org/x", "userinfo", "me:pw"),
        ("at 12 Old Mill Road today", "street", "12 Old Mill Road"),
    ],
)
def test_own_kinds(text, kind, value):
    assert [text[s:e] for k, s, e in find_pii(text) if k == kind] == [value]


def test_no_false_kinds():
    assert find_pii("IBAN: DE88 3704 0044 0532 0130 00x account of the Road https://host.org/@x ssn 12") == []
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert iban_valid("GB82WEST12345698765432") and not iban_valid("GB82")


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        kinds = [k for k, _, _ in want]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(kinds.count, PATTERNS))
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)


def test_odd_rows(odd, none):
    rows = {r.doc_id: r for r in pii_spans(odd.select("doc_id", "text", "kept", "host")).collect()}
    assert rows[1].spans == rows[2].spans == rows[5].spans == "" and rows[4].n_email == rows[None].n_email == 1
    assert pii_spans(none.select("doc_id", "text")).count() == 0
    assert find_pii("1" * 300_000 + "." + "a" * 300_000 + "@") == []


def test_taken_names(odd):
    """Columns that bear the new names keep their values; the new ones get underscores, with the same results."""
    plain = pii_spans(odd.select("doc_id", "text"))
    new = plain.columns[2:]
    both = odd.select("doc_id", "text", *[F.lit(f"own {c}").alias(c) for c in new])
    got = pii_spans(both)
    assert got.columns == ["doc_id", "text", *new, *[c + "_" for c in new]]
    assert sorted(map(repr, (tuple(r[c + "_"] for c in new) for r in got.collect()))) == sorted(map(repr, (tuple(r[c] for c in new) for r in plain.collect())))
    assert all(r[c] == f"own {c}" for r in got.collect() for c in new)
