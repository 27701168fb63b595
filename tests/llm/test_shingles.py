import random

import numpy as np

import corpus_pipeline
from sparktab.llm import shingles
from sparktab.llm.shingles import BANDS, MINIMA, shingle_dedup


def plain_kept(rows, similar=0.8):
    """Least id of each group by comparing all pairs of shingle sets."""
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {find(i) for i in sets}


def edited(words, at):
    return [w if i not in at else f"new{i}" for i, w in enumerate(words)]


def test_stage_drops_edited_copies_only(spark):
    """One edited word in 60 leaves 51 of 61 shingles (0.84) but many more than 3 bits apart; two leave fewer than 0.8."""
    rows = []
    for d in range(40):
        words = [f"d{d}w{i}" for i in range(60)]
        rows += [(10 * d, " ".join(words)), (10 * d + 1, " ".join(edited(words, {30}))), (10 * d + 2, " ".join(edited(words, {15, 45})))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == sorted(plain_kept(rows)) == sorted([10 * d for d in range(40)] + [10 * d + 2 for d in range(40)])


def test_large_group_against_all_pairs(spark):
    """A chain of edits whose ends are not similar, and a group beyond one tile."""
    rng = random.Random(4)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(400):
        rows.append((i, " ".join(edited(base, set(rng.sample(range(120), rng.choice([1, 2, 3, 4])))))))
    chain = [f"c{i}" for i in range(90)]
    for i in range(8):
        rows.append((1000 + i, " ".join(edited(chain, set(range(i))))))
    rows += [(2000, "x y"), (2001, "X  y"), (2002, "x z"), (2003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in shingle_dedup(docs).collect()} == plain_kept(rows)
    assert (1 - 0.8**MINIMA) ** BANDS < 1e-7


def test_odd_rows(odd, none):
    kept = shingle_dedup(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    clash = odd.selectExpr("*", "1 AS id", "2 AS digest", "3 AS shingle_digest", "4 AS node", "5 AS bands", "6 AS root", "7 AS copy_id")
    kept = shingle_dedup(clash)
    assert kept.columns == clash.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    assert shingle_dedup(none).count() == 0


def test_one_of_repeated_ids(spark):
    """Rows of one id and the same words, with other values and spaces; nulls for ids; the same row whatever the order."""
    rows = [(7, "a b  c d e f", "x"), (7, "a b c d e f", "y"), (7, "a b c d e f", "y"), (8, "a b c d e f", "z"), (None, "n o p", "u"), (None, "N o p", "v"), (9, "q r s", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    once = sorted(map(tuple, shingle_dedup(df).collect()), key=repr)
    assert sorted((r[0] for r in once), key=repr) == [7, 9, None]
    assert once == sorted(map(tuple, shingle_dedup(df.repartition(5)).collect()), key=repr)


def test_more_copies_than_are_sent(spark, monkeypatch):
    """Both ways of the joins give the same rows."""
    rows = [(i, " ".join(edited([f"g{i % 7}w{j}" for j in range(60)], {i % 3} if i % 2 else set()))) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_kept(rows)
    assert {r.doc_id for r in shingle_dedup(df).collect()} == want
    monkeypatch.setattr(shingles, "SENT_ROWS", 3)
    assert {r.doc_id for r in shingle_dedup(df).collect()} == want


def test_similar_pairs_of_the_table_meet(spark):
    """Every pair of distinct texts of sf0.1 at 0.8 or more, found by their shared shingles, agrees in some band."""
    sets = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").distinct().collect():
        words = shingles.words_of((r.text or "").encode())
        sets[shingles.digest_of(words)] = shingles.shingle_set(words)
    sets = {d: s for d, s in sets.items() if len(s) >= 16}
    names, held = list(sets), list(sets.values())
    _, number, often = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    holders, at = {}, 0
    for d, s in zip(names, held, strict=True):
        own = number[at : at + len(s)]
        at += len(s)
        # similar sets share one of the rarest fifth of each, by any one order of all shingles
        rarest = own[np.lexsort((own, often[own]))[: int(0.2 * len(s)) + 1]]
        for h in rarest[often[rarest] > 1].tolist():
            holders.setdefault(h, []).append(d)
    pairs = {(a, b) for own in holders.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    near = [(a, b) for a, b in pairs if (c := len(np.intersect1d(sets[a], sets[b]))) + 1e-9 >= 0.8 * (len(sets[a]) + len(sets[b]) - c)]
    made = {d: np.frombuffer(shingles.bands(sets[d]), np.uint64) for pair in near for d in pair}
    assert len(near) >= 40 and all((made[a] == made[b]).any() for a, b in near)


def test_fingerprints_find_candidates_by_the_pigeonhole(spark, monkeypatch):
    """without bands, all similar texts whose fingerprints are within three bits are still found, and no others."""
    rng, rows = random.Random(9), []
    for d in range(12):
        base = [f"d{d}w{i}" for i in range(900)]
        rows += [(100 * d + i, " ".join(edited(base, {rng.randrange(900)}) if i else base)) for i in range(6)]
    rows += [(5000, "x y"), (5001, "x z"), (5002, "")]
    prints = {i: shingles.majority(s) if len(s) else 0 for i, s in ((i, shingles.shingle_set(shingles.words_of(t.encode()))) for i, t in rows)}
    near = [(a, b) for a in prints for b in prints if a < b and ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= shingles.DISTANCE]
    assert len(near) >= 12
    root = {i: i for i in prints}
    for a, b in sorted(near):
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    monkeypatch.setattr(shingles, "ROUNDS", (0,))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in shingle_dedup(df).collect()}
    # groups of fingerprints hold edits of one text only, all of them similar
    assert got == set(root.values()) and plain_kept(rows) < got
