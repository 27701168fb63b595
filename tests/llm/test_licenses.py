import random
import re

from pyspark.sql import functions as F

from sparktab.llm.licenses import NOTICES, TEMPLATES, WHOLE, Index, document_counts, license_scan, words_of
from sparktab.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def plain(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(k, i) for k, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for _, i in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for k, _ in places}))


def test_base_places():
    index = Index(TEMPLATES, {}, 0)
    rng = random.Random(7)
    bits = ["MIT", "license", "Apache", "general", "public", "License.", "é", "x", "-", "mit-license", "\n", "Kelvin\u212a"]
    for _ in range(2000):
        text = " ".join(rng.choices(bits, k=rng.randint(0, 25)))
        n, found = index.scan(text.encode())
        base = [(k, at) for k, at, _ in found if index.templates[k].base]
        starts = [at for _, at in base]
        assert (n, len(base), min(starts, default=None), max(starts, default=None)) == plain(text)[:4]


def test_notices_and_edits():
    index = Index(TEMPLATES, {b"license": 900, b"the": 990, b"software": 5}, 1000)
    for t in NOTICES:
        words = ["lead"] * 30 + t.text.split() + ["trail"] * 30
        found = {index.templates[k].label: share for k, at, share in index.scan(" ".join(words).encode())[1] if not index.templates[k].base}
        assert found.get(t.label) == 1.0, t.label
    long = next(t for t in NOTICES if t.label == "bsd").text.split()
    edited = long[:6] + ["new"] + long[6:9] + long[10:]
    assert [index.templates[k].label for k, _, _ in index.scan(" ".join(edited).encode())[1]] == ["bsd"]
    without_key = ["usage"] + long[1:]
    assert index.scan(" ".join(without_key).encode())[1] == []
    assert index.scan(b"the software is provided with any license of conditions")[1] == []


def test_rarity_counts_every_document(spark):
    df = spark.createDataFrame([("MIT mit license",), ("license",), (None,), ("x",)], "text string").repartition(3)
    assert document_counts(df, "text", {b"mit", b"license", b"gpl"}) == ({b"mit": 1, b"license": 2}, 4)
    assert document_counts(df.where("false"), "text", {b"mit"}) == ({}, 0)


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op1_license_scan"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_odd_rows(odd, none):
    rows = {r.doc_id: r for r in license_scan(odd.select("doc_id", "text", "kept")).collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and rows[1].first_word is None
    assert rows[4].base_labels == rows[None].base_labels == "mit" and rows[5].n_words == 200_001
    assert license_scan(none.select("doc_id", "text")).count() == 0
    assert words_of(None) == []


def test_taken_names(odd):
    """Columns that bear the new names keep their values; the new ones get underscores, with the same results."""
    plain = license_scan(odd.select("doc_id", "text"))
    new = plain.columns[2:]
    both = odd.select("doc_id", "text", *[F.lit(f"own {c}").alias(c) for c in new])
    got = license_scan(both)
    assert got.columns == ["doc_id", "text", *new, *[c + "_" for c in new]]
    assert sorted(map(repr, (tuple(r[c + "_"] for c in new) for r in got.collect()))) == sorted(map(repr, (tuple(r[c] for c in new) for r in plain.collect())))
    assert all(r[c] == f"own {c}" for r in got.collect() for c in new)


def test_whole_texts_with_edits():
    """Whole licences are found with a holder's name put in and words lost; without a key phrase they are not."""
    index = Index(TEMPLATES, {w: 1 + len(w) for t in WHOLE for w in words_of(t.text.encode())}, 100_000)
    rng = random.Random(5)

    def labels(words):
        return {index.templates[k].label: (at, share) for k, at, share in index.scan(" ".join(words).encode())[1]}

    for t in WHOLE:
        words = [w.decode() for w in words_of(t.text.encode())]
        assert labels(["lead"] * 40 + words + ["trail"] * 40)[t.label] == (40, 1.0), t.label
        kept = {w for p in t.phrases for w in p.split()}
        loose = [i for i, w in enumerate(words) if w not in kept]
        gone = set(rng.sample(loose, len(words) // 25))
        edited = [w for i, w in enumerate(words) if i not in gone]
        edited[len(edited) // 2 : len(edited) // 2] = ["acme"] if len(words) > 60 else []
        found = labels(["lead"] * 40 + edited + ["trail"] * 40) if all(" ".join(p.split()) in " ".join(edited) for p in t.phrases) else {t.label: (40, 1.0)}
        assert found[t.label][1] > 0.9, t.label
        phrase = t.phrases[-1].split()
        broken = " ".join(words).replace(" ".join(phrase), " ".join(phrase[:-1] + ["other"])).split()
        assert t.label not in labels(broken), t.label
