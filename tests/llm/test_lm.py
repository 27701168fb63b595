import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sparktab.llm import attention as A
from sparktab.llm import lm
from sparktab.llm.lm import RANKS, Lexicon, Tokenizer, frequent, lm_scores, load_ranks, words_of


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(load_ranks(RANKS))


@pytest.fixture(scope="module")
def tiny():
    rng = np.random.default_rng(13)
    counts = np.append(rng.integers(0, 50, 300), 10).astype(float)
    pieces = A.arrange(counts)
    return pieces, A.initial(pieces)


def by_hand(params, ids, pieces):
    """Log probability of one document, place by place, with the windows' contexts."""
    rows = np.append(pieces.row[pieces.size + A.BEGIN], pieces.row[ids])
    goals = np.append(ids, pieces.size + A.END)
    total = 0.0
    x = params["rows"].astype(float)
    for i, goal in enumerate(goals):
        first = i // A.STRIDE * A.STRIDE - A.CONTEXT
        lo = max(0, first)
        q = x[rows[i], A.Q] + params["pq"][i - first - A.CONTEXT]
        weights = [np.exp(q @ (x[rows[j], A.K] + params["pk"][j - first]) + x[rows[j], A.B]) for j in range(lo, i + 1)]
        h = sum(w * x[rows[j], A.V] for w, j in zip(weights, range(lo, i + 1), strict=True)) / sum(weights) + x[rows[i], A.R]
        logits = params["w"] @ h + params["o"]
        total += logits[pieces.cls[goal]] - np.log(np.exp(logits).sum()) + pieces.inside[goal]
    return total / math.log(10)


def test_scores_are_those_place_by_place(tiny):
    pieces, params = tiny
    rng = np.random.default_rng(14)
    lengths = np.array([0, 1, 63, 64, 65, 127, 128, 300, 0])
    ids = rng.integers(0, 300, lengths.sum())
    got = A.score(params, ids, lengths, pieces, batch=3)
    ends = np.cumsum(lengths)
    for i, n in enumerate(lengths):
        assert got[i] == pytest.approx(by_hand(params, ids[ends[i] - n : ends[i]], pieces), rel=1e-4)
    assert len(A.score(params, ids[:0], lengths[:0], pieces)) == 0


def test_chances_add_up(tiny):
    pieces, params = tiny
    total = sum(10 ** A.score(params, np.array([p]), np.array([1]), pieces)[0] / 10 ** tail(params, p, pieces) for p in range(300))
    end = 10 ** A.score(params, np.array([], int), np.array([0]), pieces)[0]
    specials = np.exp(pieces.inside[[300, 302]]) @ first_class(params, pieces)[pieces.cls[[300, 302]]]
    assert total + end + specials == pytest.approx(1, abs=1e-3)


def first_class(params, pieces):
    row = pieces.row[pieces.size + A.BEGIN]
    logits = params["w"] @ (params["rows"][row, A.V] + params["rows"][row, A.R]) + params["o"]
    return np.exp(logits) / np.exp(logits).sum()


def tail(params, piece, pieces):
    """Log chance of END after one piece."""
    first = np.log10(first_class(params, pieces)[pieces.cls[piece]]) + pieces.inside[piece] / math.log(10)
    return A.score(params, np.array([piece]), np.array([1]), pieces)[0] - first


def test_gradients_are_those_of_the_loss(tiny):
    pieces, params = tiny
    params = {k: v.astype(np.float64) for k, v in params.items()}
    stream = A.Stream.of(np.random.default_rng(15).integers(0, 300, 150), np.array([150]), pieces)
    rows, at, scored = stream.cut(*stream.windows())
    classes = pieces.cls[stream.target[at]]
    _, used, of_rows, grads = A.gradients(params, rows, classes, scored)
    assert used.tolist() == np.unique(rows).tolist()
    grads["rows"] = np.zeros_like(params["rows"])
    grads["rows"][used] = of_rows
    rng = np.random.default_rng(16)
    for name in grads:
        where_used = np.argwhere(np.abs(grads[name]) > 1e-5)
        for where in rng.permutation(where_used)[: 40 if name == "rows" else 4]:
            where = tuple(where)
            keep = params[name][where]
            params[name][where] = keep + 1e-5
            up = A.gradients(params, rows, classes, scored)[0]
            params[name][where] = keep - 1e-5
            down = A.gradients(params, rows, classes, scored)[0]
            params[name][where] = keep
            assert grads[name][where] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-6), name


def test_training_beats_counts_on_held_out_text(spark, tokenizer):
    texts = [r.text.encode() for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'").limit(700).collect()]
    lexicon = Lexicon(tokenizer, {})
    _, _, ids, lengths = lexicon.read(texts[:500])
    counts = np.append(np.bincount(ids, minlength=tokenizer.size), 500).astype(float)
    pieces = A.arrange(counts)
    params = A.initial(pieces)
    _, _, held, sizes = lexicon.read(texts[500:])
    before = A.score(params, held, sizes, pieces).sum()
    A.train(params, ids, lengths, pieces, 0.2)
    after = A.score(params, held, sizes, pieces).sum()
    n = sizes.sum() + len(sizes)
    unigram = (pieces.inside + pieces.class_log[pieces.cls])[held].sum() / math.log(10)
    assert after / n > before / n + 0.2 and after > unigram


@pytest.fixture(scope="module")
def learnt(spark, tokenizer):
    """Documents (id, text), and the pieces arranged by their counts."""
    rows = [(i, r.text) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").limit(300).collect())]
    _, _, ids, _ = Lexicon(tokenizer, {}).read([t.encode() for _, t in rows])
    return rows, A.arrange(np.append(np.bincount(ids, minlength=tokenizer.size), len(rows)).astype(float))


def test_rounds_and_shards_are_those_of_plain_code(spark, tokenizer, learnt):
    """Every document is learnt once; rows are averaged by use, whatever tasks the shards fall to."""
    rows, pieces = learnt
    df = spark.createDataFrame(rows, "id long, text string")
    digests = {r.id: r.d for r in df.selectExpr("id", "xxhash64(id, text) d").collect()}
    rounds, each = 2, 3
    given, seen = A.initial(pieces), 0
    for r in range(rounds):
        weight, sums, shared, places = np.zeros(len(pieces.row)), np.zeros(given["rows"].shape), 0.0, 0
        for s in range(each):
            mine = sorted((digests[i], t) for i, t in rows if digests[i] % rounds == r and (digests[i] >> 20) % each == s)
            seen += len(mine)
            own = {k: v.copy() for k, v in given.items()}
            _, _, ids, lengths = Lexicon(tokenizer, {}).read([t.encode() for _, t in mine])
            _, used = A.train(own, ids, lengths, pieces, 0.2 * 0.5**r, seed=r)
            weight, sums = weight + used, sums + own["rows"] * used[:, None]
            shared, places = shared + A.flat(own) * used.sum(), places + used.sum()
        at = np.flatnonzero(weight)
        given["rows"][at] = sums[at] / weight[at, None]
        given |= A.unflat(shared / places, given)
    assert seen == len(rows)
    got = lm.train_model(df.repartition(4), spark.sparkContext.broadcast(tokenizer), pieces, shards=rounds * each, rounds=rounds, rate=0.2)
    for k in given:  # a step divides by the size of its gradient, so that rounding shows in rows of hardly any gradient
        assert np.isclose(got[k], given[k], rtol=1e-2, atol=1e-3).mean() > 0.999, k


def test_more_documents_teach_more(spark, tokenizer, learnt):
    rows, pieces = learnt
    sent = spark.sparkContext.broadcast(tokenizer)
    _, _, held, sizes = Lexicon(tokenizer, {}).read([t.encode() for _, t in rows[200:]])
    scores = [A.score(A.initial(pieces), held, sizes, pieces).sum()]
    for n in (20, 200):
        scores.append(A.score(lm.train_model(spark.createDataFrame(rows[:n], "id long, text string"), sent, pieces, shards=2), held, sizes, pieces).sum())
    assert scores[0] < scores[1] < scores[2]


def test_pieces_spell_the_words(tokenizer):
    back = {v: k for k, v in tokenizer.ranks.items()}
    texts = ["Ünï 漢字 Xy".encode(), b"", None, b"a" * 3000]
    numbers, sizes, ids, lengths = Lexicon(tokenizer, {b"xy": 3}).read(texts)
    assert sizes.tolist() == [3, 0, 0, 1] and len(numbers) == 4
    ends = np.cumsum(lengths)
    for t, n, e in zip(texts, lengths, ends, strict=True):
        assert b"".join(back[i] for i in ids[e - n : e]) == b"".join(b" " + w for w in words_of(t))


def plain(rows):
    training = [(d, t) for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
    counts = Counter(w for _, t in training for w in [*words_of(t), None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*words_of(t), None]
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        out.append((zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, len(tokens), sum(counts[w] > 0 for w in tokens), total, score))
    return out


@pytest.mark.parametrize("head_words", [0, 30, 10_000])
def test_base_scores(spark, small, head_words):
    rows = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = dict(zip([d for d, _ in rows], plain(rows), strict=True))
    got = lm_scores(spark.read.parquet(f"{small}/documents.parquet"), head_words=head_words).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, score = want[r.id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9) and -20 * n * 4 < r.score < 0


def test_frequent_words(spark):
    words = spark.createDataFrame([("a", 100), ("b", 50), ("c", 50), ("d", 1)], "word string, n long")
    assert frequent(words, 3) == {b"a": 100, b"b": 50, b"c": 50}
    assert frequent(words, 2) == {b"a": 100} and frequent(words, 0) == {} and frequent(words.where("false"), 5) == {}


def test_odd_rows(odd, none):
    rows = sorted(odd.select("doc_id", "text").collect(), key=str)
    want = sorted(plain([(r.doc_id, None if r.text is None else r.text.encode()) for r in rows]), key=str)
    got = lm_scores(odd).collect()
    assert sorted([(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got], key=str) == sorted([w[:4] for w in want], key=str)
    assert sorted(r.base_score for r in got) == pytest.approx(sorted(w[4] for w in want), rel=1e-9)
    assert len({r.score for r in got if r.n_tokens == 1}) == 1
    assert lm_scores(none).count() == 0


def test_a_run_of_windows_is_learnt_like_its_windows_one_by_one(tiny):
    """Windows side by side share their contexts; losses and gradients stay those of the windows alone."""
    pieces, params = tiny
    params = {k: v.astype(np.float64) for k, v in params.items()}
    lengths = np.array([300, 0, 63, 64, 500, 1])
    stream = A.Stream.of(np.random.default_rng(17).integers(0, 300, lengths.sum()), lengths, pieces)
    windows = stream.windows()
    rows, at, scored = stream.cut(*windows)
    loss, used, of_rows, shared = A.gradients(params, rows, pieces.cls[stream.target[at]], scored)
    for run in (1, 4, 7):
        run_rows, classes, there, fresh, doc = A.side_by_side(stream, pieces.cls[stream.target], run)
        assert there.sum() == scored.sum() == len(stream.rows) and doc.tolist() == windows[0].tolist()
        got, run_used, run_of_rows, run_shared = A.gradients(params, run_rows, classes, there, fresh)
        assert got == pytest.approx(loss, rel=1e-9)
        own, run_own = used != pieces.pad, run_used != pieces.pad
        assert used[own].tolist() == run_used[run_own].tolist()
        np.testing.assert_allclose(run_of_rows[run_own], of_rows[own], rtol=1e-6, atol=1e-12)
        for k in shared:
            np.testing.assert_allclose(run_shared[k], shared[k], rtol=1e-6, atol=1e-12)


def test_scores_do_not_hang_on_the_batch_and_stay_finite(tiny):
    pieces, params = tiny
    lengths = np.array([700, 0, 64, 5, 129])
    ids = np.random.default_rng(18).integers(0, 300, lengths.sum())
    assert A.score(params, ids, lengths, pieces, batch=1) == pytest.approx(A.score(params, ids, lengths, pieces), rel=1e-6)
    wide = {k: v * 200 for k, v in params.items()}
    wide["rows"][:, A.ONE], wide["rows"][pieces.pad, A.B] = 1, -2 * A.LIMIT
    assert np.isfinite(A.score(wide, ids, lengths, pieces)).all()
    lost = A.gradients(wide, *(x for x in A.side_by_side(A.Stream.of(ids, lengths, pieces), pieces.cls[A.Stream.of(ids, lengths, pieces).target], 4)[:4]))
    assert np.isfinite(lost[0]) and np.isfinite(lost[2]).all()


def test_known_words_are_not_cut_again(tokenizer):
    cut = []

    class Counting:
        def pieces(self, word):
            cut.append(word)
            return tokenizer.pieces(word)

    known = lm.Known(tokenizer, [b"one", b"two"], {b"one": 3})
    texts = [b"two new one", b"", None, b"new one"]
    lexicon = Lexicon(Counting(), {}, known)
    got, want = lexicon.read(texts), Lexicon(tokenizer, {b"one": 3}).read(texts)
    assert cut == [b" new"] and all(a.tolist() == b.tolist() for a, b in zip(got[1:], want[1:], strict=True))
    assert [lexicon.words[i] for i in got[0]] == [b"two", b"new", b"one", b"new", b"one"]
    assert lexicon.log[0] == pytest.approx(math.log10(3.5)) and np.isnan(lexicon.log[1:]).all()
    lexicon.empty()
    assert lexicon.read([b"one two"])[0].tolist() == [0, 1] and cut == [b" new"]
