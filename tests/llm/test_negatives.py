"""Hard negatives against all pairs in plain code, bounds against true scores, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.llm import negatives
from sparktab.llm.negatives import _Rows, angles_to, hard_negatives, pick_directions, windows
from sparktab.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, n_pos=5, n_neg=10):
    """rows: (id, vector, label); every pair scored."""
    ready = [(i, [int(np.floor(256 * float(x))) for x in v], c) for i, v, c in rows if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, v, c in ready:
        if i is not None and is_anchor(i):
            anchors[i] = min(anchors.get(i, (c, v)), (c, v))
    out = []
    for a, (label, vector) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, vector, strict=True)), i is None, i, c) for i, v, c in ready if len(v) == len(vector)]
        scored.sort(key=lambda t: (t[0], t[1], t[2] or 0))
        pos = [(i, -s) for s, _, i, c in scored if c == label and i != a][:n_pos]
        for p, ps in pos:
            neg = [(i, -s) for s, _, i, c in scored if c != label and 30 * ps <= -100 * s <= 90 * ps][:n_neg]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(neg)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_same_as_sql(spark, small):
    assert difference(QUERIES["op11_hard_negatives"](spark, small), connect(small), ORACLES["op11_hard_negatives"]) is None


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold(seed):
    """No score leaves its interval, and the intervals do rule rows out."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 16))
    rows = np.floor(256 * (centres[rng.integers(0, 4, 500)] + 0.1 * rng.normal(size=(500, 16)))).astype(np.int64)
    rows[:5] = 0
    rows[5:10] = rows[10]
    rows[11] = -rows[10]
    directions = pick_directions(rows.astype(np.float64))
    norms, angles = angles_to(rows, directions)
    import pyarrow as pa

    block = _Rows(pa.array(range(500)), pa.array(["x"] * 500), rows, norms, angles, {})
    outside = 0
    for i in range(0, 500, 7):
        lower, upper = block.bounds(norms[i], angles[i])
        scores = rows @ rows[i]
        assert (lower <= scores).all() and (scores <= upper).all()
        assert scores.max() <= block.highest(norms[i], angles[i])
        outside += (upper < np.sort(scores)[-20]).sum()
    assert outside > 1000


def test_windows_are_whole():
    for score in [*range(-25, 60), 1001, 65536]:
        low, high = windows(score)
        for s in range(-40, 80):
            assert (low <= s <= high) == (30 * score <= 100 * s <= 90 * score)


@pytest.mark.parametrize("sent", [1 << 25, 2000])
def test_against_all_pairs(spark, monkeypatch, sent):
    """Clustered rows, a third of them one vector, ties throughout; the anchors in one pass and in several."""
    monkeypatch.setattr(negatives, "SEND_BYTES", sent)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8))
    rows = []
    for i in range(600):
        c = int(rng.integers(0, 5))
        v = centres[0] if i % 3 == 0 else np.round(centres[c] + 0.3 * rng.normal(size=8), 1)
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 4))))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    assert got(hard_negatives(df, F.col("vec_id") % 20 == 0)) == plain(rows, lambda i: i % 20 == 0)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 0.5], 2), (1, [1.0, 0.4], 1), (1, [1.0, 0.4], 1), (2, [0.5, 0.4], 2), (2, [0.5, 0.4], 2),
        (None, [0.6, 0.4], 2), (None, [1.0, 1.0], 1), (3, None, 1), (4, [1.0, None], 1), (5, [1.0, nan], 2), (6, [inf, 1.0], 2), (7, [1.0, 1.0], None),
        (8, [0.0, 0.0], 2), (9, [], 1), (10, [], 1), (11, [], 2), (100, [1.0, 0.1, 0.1], 1), (12, [0.5, 0.1, 0.1], 2), (13, [1.0, 0.2, 0.1], 1), (200, [0.0, 0.0], 2), (14, [1e300, 1.0], 3),
    ]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS id", "2 AS q", "3 AS angles", "4 AS norm")
    capped = [(i, v and [min(x, 2.0**17) if x is not None else x for x in v], c) for i, v, c in rows if i != 6]
    assert got(hard_negatives(df, F.col("vec_id") % 100 == 0)) == plain(capped, lambda i: i % 100 == 0)


def test_empty(spark):
    df = spark.createDataFrame(odd_rows(), "vec_id long, embedding array<double>, label int")
    for none in (hard_negatives(df.where("false"), F.col("vec_id") % 100 == 0), hard_negatives(df, F.lit(False))):
        assert none.columns == COLUMNS and none.count() == 0


def test_float_vectors_and_numbers_kept(spark):
    """Fewer rows than asked for give what there is; parameters set the numbers."""
    rows = [(i, [float(np.float32(np.sin(i + j))) for j in range(6)], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got(hard_negatives(df, F.col("vec_id") < 4)) == plain(rows, lambda i: i < 4)
    assert got(hard_negatives(df, F.col("vec_id") < 4, positives=2, negatives=3)) == plain(rows, lambda i: i < 4, 2, 3)
