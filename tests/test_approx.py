"""The approximate neighbour join: exact where buckets hold everything, near-exact on clusters, hot vectors, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.plans.approx import bucket_cells, hyperplanes, knn_join_approx, recall
from sparktab.plans.neighbors import knn_join
from tests.test_neighbors import SCHEMA, brute, clustered, joined, same


def test_cells():
    """Own bucket first; with flips every crossing of the nearest hyperplanes, no cell twice."""
    rng = np.random.default_rng(0)
    points, planes = rng.normal(size=(50, 7)), hyperplanes(7, 12)
    own, visited = bucket_cells(points, planes, 3, 0), bucket_cells(points, planes, 3, 2)
    assert own.shape == (50, 3) and visited.shape == (50, 12)
    for i in range(50):
        for t in range(3):
            margins = planes[4 * t : 4 * t + 4] @ points[i]
            want = sum(1 << j for j in range(4) if margins[j] >= 0)
            near = np.argsort(np.abs(margins))[:2]
            ways = {want, want ^ 1 << near[0], want ^ 1 << near[1], want ^ 1 << near[0] ^ 1 << near[1]}
            assert own[i, t] == want + (t << 40)
            assert set(visited[i, 4 * t : 4 * t + 4].tolist()) == {w + (t << 40) for w in ways}


def test_planes_are_normal():
    planes = hyperplanes(50, 200)
    assert abs(planes.mean()) < 0.03 and abs(planes.std() - 1) < 0.03
    assert (planes == hyperplanes(50, 200)).all() and (planes != hyperplanes(50, 200, seed=1)).any()


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("bar", [None, "id", "fold"])
@pytest.mark.parametrize("tile_rows", [None, 30])
def test_one_bucket_is_exact(spark, metric, bar, tile_rows):
    """Without hyperplanes all rows meet, in tables that repeat each other and tiles in several parts."""
    rows = clustered(240, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join_approx(df, df, 6, id_col="id", vector_col="v", label_col="y", metric=metric, bar=bar, tables=2, bits=0, tile_rows=tile_rows))
    barred = {None: lambda a, b: False, "id": lambda a, b: a[0] == b[0], "fold": lambda a, b: a[2] == b[2]}[bar]
    same(got, brute(rows, rows, 6, metric, barred))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_clusters(spark, metric):
    """Recall above 0.9 on clusters, distances as in the exact join, and far fewer pairs compared."""
    rng = np.random.default_rng(3)
    centres = 3 * rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.4 * rng.normal(size=16)).tolist()) for i in range(1600)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    exact = knn_join(df, df, 5, id_col="id", vector_col="v", metric=metric, bar="id")
    found = knn_join_approx(df, df, 5, id_col="id", vector_col="v", metric=metric, bar="id", tables=6, bits=7, flips=1)
    assert recall(found, exact).first().recall >= 0.9
    want = {(r.query_id, r.ref_id): r.dist for r in exact.collect()}
    got = found.collect()
    assert all(want[r.query_id, r.ref_id] == r.dist for r in got if (r.query_id, r.ref_id) in want)
    assert max(r["rank"] for r in got) == 5 and len({(r.query_id, r.ref_id) for r in got}) == len(got)
    points = np.array([v for _, v in rows])
    points = points - points.mean(0) if metric != "cosine" else points
    planes = hyperplanes(16, 42)
    own, visited = bucket_cells(points, planes, 6, 0), bucket_cells(points, planes, 6, 1)
    compared = sum(int((visited[:, 2 * t : 2 * t + 2, None] == own[:, t]).sum()) for t in range(6))
    assert compared < 0.4 * 1600 * 1600


def test_hot_vector_leaves_buckets_small(spark):
    """References that repeat a vector stay out of the buckets but for the first, and nothing is lost by it."""
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(np.sin(i)), float(np.cos(3 * i)), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(4)
    got = joined(knn_join_approx(df, df, 4, id_col="id", vector_col="v", bar="id", tables=4, bits=2, flips=2))
    want = brute(rows, rows, 4, "cosine", lambda a, b: a[0] == b[0])
    for q, found in want.items():
        if rows[q][0] % 3 == 0:
            assert [i for _, i in got[q]] == [i for _, i in found]


def test_recall_counts(spark):
    exact = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (2, 4)], "query_id long, ref_id long")
    found = spark.createDataFrame([(1, 2), (2, 9), (2, 4), (3, 1)], "query_id long, ref_id long")
    assert tuple(recall(found, exact).first()) == (4, 0.5)
    assert tuple(recall(found, exact.where("false")).first()) == (0, 1.0)


def test_odd_input(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id bigint, v array<double>")
    none = df.where("false")
    for q, r in ((df, none), (none, df), (none, none)):
        assert knn_join_approx(q, r, 3, id_col="id", vector_col="v").count() == 0
    assert knn_join_approx(df, df, 3, id_col="id", vector_col="v").count() == 4
    for bad in ({"metric": "hamming"}, {"tables": 0}, {"flips": -1}, {"bits": 41}):
        with pytest.raises(ValueError):
            knn_join_approx(df, df, 3, id_col="id", vector_col="v", **bad)
    wide = spark.createDataFrame([(3, [1.0, 2.0, 3.0])], "id bigint, v array<double>")
    with pytest.raises(Exception, match="unequal length"):
        knn_join_approx(wide, df, 1, id_col="id", vector_col="v").collect()


def test_same_after_repartition(spark):
    df = spark.createDataFrame(clustered(200, 7), SCHEMA)
    once = joined(knn_join_approx(df, df, 3, id_col="id", vector_col="v", bits=3))
    assert once == joined(knn_join_approx(df.repartition(9), df.orderBy(F.desc("id")), 3, id_col="id", vector_col="v", bits=3))
