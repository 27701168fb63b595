import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparktab.functions import distance as d
from sparktab.operators import knn
from sparktab.plans import neighbors
from sparktab.plans.neighbors import _parts, held_rows, knn_join

SCHEMA = "id bigint, v array<double>, y int, fold int"


def brute(q, r, k, metric, barred=lambda a, b: False):
    out = {}
    for qi, qv, *qrest in q:
        found = []
        for ri, rv, *rrest in r:
            if barred((qi, *qrest), (ri, *rrest)):
                continue
            a, b = np.array(qv), np.array(rv)
            if metric == "cosine":
                size = np.linalg.norm(a) * np.linalg.norm(b)
                dist = 1 - (a @ b / size if size else 0.0)
            else:
                dist = np.sqrt(((a - b) ** 2).sum())
            found.append((0.0 if metric == "cosine" and dist < 1e-15 else float(f"{dist:.11e}"), ri))
        out[qi] = sorted(found)[:k]
    return out


def joined(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.dist, r.ref_id))
    return out


def same(got, want):
    assert set(got) == {q for q, found in want.items() if found}
    for q, found in got.items():
        assert [i for _, i in found] == [i for _, i in want[q]]
        assert [x for x, _ in found] == pytest.approx([x for x, _ in want[q]], abs=2e-9)


def clustered(n, seed, spread=0.05):
    """Clusters, a third of all rows equal, and some zero vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = centres[0]
        elif i % 41 == 1:
            v = np.zeros(8)
        else:
            v = centres[rng.integers(6)] + spread * rng.normal(size=8)
        rows.append((i, v.tolist(), int(i % 2), int(i % 5)))
    return rows


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "minkowski"])
@pytest.mark.parametrize("tiles", [{}, {"tile_rows": 40, "pivots": 9}, {"tile_rows": 25, "pivots": 1}])
def test_same_as_brute_force(spark, metric, tiles):
    rows = clustered(300, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join(df, df, 7, id_col="id", vector_col="v", label_col="y", metric=metric, bar="id", **tiles))
    same(got, brute(rows, rows, 7, metric, lambda a, b: a[0] == b[0]))


@pytest.mark.parametrize("tiles", [{}, {"tile_rows": 40, "pivots": 9}])
def test_fold_bar(spark, tiles):
    rows = clustered(200, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join(df, df, 6, id_col="id", vector_col="v", bar="fold", **tiles))
    same(got, brute(rows, rows, 6, "cosine", lambda a, b: a[2] == b[2]))


def test_cells_are_skipped_and_no_neighbour_is_lost(spark):
    rows = clustered(400, 3, spread=0.01)
    df = spark.createDataFrame(rows, SCHEMA)
    q, r = df.where("id % 4 = 1"), df.where("id % 4 <> 1")
    got = joined(knn_join(q, r, 5, id_col="id", vector_col="v", metric="euclidean", tile_rows=50, pivots=20))
    same(got, brute([x for x in rows if x[0] % 4 == 1], [x for x in rows if x[0] % 4 != 1], 5, "euclidean"))


def test_string_ids_and_fewer_refs_than_k(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, v array<double>")
    got = joined(knn_join(df, df, 9, id_col="id", vector_col="v", bar="id"))
    assert [i for _, i in got["c"]] == ["a", "b"]
    assert got["a"] == [(0.0, "b"), (1.0, "c")]


def test_far_apart_scales(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (1e4 + rng.normal(size=3) * 1e-3).tolist(), 0, 0) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join(df, df, 4, id_col="id", vector_col="v", metric="euclidean", bar="id", tile_rows=30, pivots=5))
    same(got, brute(rows, rows, 4, "euclidean", lambda a, b: a[0] == b[0]))


def test_tight_groups_far_from_the_origin(spark):
    rng = np.random.default_rng(6)
    centres = 1e5 + rng.normal(size=(8, 4))
    rows = [(i, (centres[i % 8] + 1e-3 * rng.normal(size=4)).tolist(), 0, 0) for i in range(320)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join(df, df, 4, id_col="id", vector_col="v", metric="euclidean", bar="id", tile_rows=30, pivots=24))
    same(got, brute(rows, rows, 4, "euclidean", lambda a, b: a[0] == b[0]))


def test_bad_vectors_are_refused(spark):
    for bad in ([1.0], [float("nan"), 1.0], None):
        df = spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "id int, v array<double>")
        with pytest.raises(Exception, match="unequal|NaN|missing"):
            knn_join(df, df, 1, id_col="id", vector_col="v").collect()
    with pytest.raises(ValueError, match="metric"):
        knn_join(df, df, 1, id_col="id", vector_col="v", metric="hamming")


def test_no_refs_gives_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<double>")
    assert knn_join(df, df.where("id > 5"), 1, id_col="id", vector_col="v").count() == 0


def test_column_distances(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    rows = df.select(*[d.distance(df.a, df.b, m).alias(m) for m in d.METRICS]).collect()
    assert rows[0].cosine == 1.0 and rows[0].euclidean == 5.0
    assert rows[1].cosine == pytest.approx(1 - 1 / np.sqrt(2)) and rows[1].minkowski == pytest.approx(1.0)


def neighbours(spark, rows):
    return spark.createDataFrame(rows, "query_id int, ref_id int, ref_label int, dist double, rank int")


def test_vote_ties_go_to_the_smallest_label(spark):
    near = neighbours(spark, [(1, 1, 2, 0.1, 1), (1, 2, 1, 0.2, 2), (2, 1, 2, 0.1, 1), (2, 3, 2, 0.3, 2), (2, 4, 0, 0.4, 3)])
    got = {r.query_id: r for r in knn.knn_predict(near, [0, 1, 2]).collect()}
    assert got[1].prediction == 1 and got[2].prediction == 2
    assert got[2].class_2 == pytest.approx(2 / 3) and got[2].class_1 == 0.0


def test_exact_matches_win_alone(spark):
    near = neighbours(spark, [(1, 1, 0, 0.0, 1), (1, 2, 1, 0.1, 2), (1, 3, 1, 0.1, 3), (2, 1, 0, 0.1, 1), (2, 2, 1, 0.3, 2), (2, 3, 1, 0.3, 3)])
    got = {r.query_id: r for r in knn.knn_predict(near, [0, 1], "distance").collect()}
    assert got[1].class_0 == 1.0 and got[1].prediction == 0
    assert got[2].class_0 == pytest.approx(10 / (10 + 20 / 3)) and got[2].prediction == 0


def test_grid_is_the_same_as_single_runs(spark):
    rows = clustered(150, 7, spread=0.8)
    df = spark.createDataFrame(rows, SCHEMA)
    grid = {(r.weights, r.k): r.accuracy for r in knn.knn_grid(df, "id", "v", "y", max_k=5).collect()}
    assert len(grid) == 10
    for weights, k in (("uniform", 3), ("distance", 5)):
        near = knn_join(df, df, k, id_col="id", vector_col="v", label_col="y", bar="fold", metric="euclidean")
        preds = knn.knn_predict(near, weights=weights).withColumnRenamed("query_id", "id").join(df, "id")
        by_fold = preds.groupBy("fold").agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("a"))
        assert grid[weights, k] == pytest.approx(by_fold.agg(F.avg("a")).first()[0])


def test_running_votes(spark):
    """The winner after every rank, with ties, vanishing weights and labels that catch up; no explode, no new shuffle."""
    rng = np.random.default_rng(11)
    rows = []
    for q in range(40):
        dist = np.sort(rng.integers(0, 6, 12)) / 4
        rows += [(q, j + 1, int(rng.integers(0, 3)), float(dist[j])) for j in range(int(rng.integers(1, 13)))]
    near = spark.createDataFrame(rows, "query_id long, rank int, ref_label int, dist double").repartition(3, "query_id")
    weighted = knn.with_weights(near, "distance").withColumnRenamed("weight", "distance").withColumn("uniform", F.lit(1.0))
    chosen = knn._choices(weighted, knn.WEIGHTS)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
    got = {(r.query_id, r.k): (r.uniform, r.distance) for r in chosen.collect()}
    held = {}
    for r in weighted.collect():
        held.setdefault(r.query_id, {})[r["rank"]] = r
    want = {}
    for q, own in held.items():
        for k in own:
            votes = {w: {} for w in knn.WEIGHTS}
            for j in range(1, k + 1):
                for w in knn.WEIGHTS:
                    votes[w][own[j].ref_label] = votes[w].get(own[j].ref_label, 0.0) + own[j][w]
            want[q, k] = tuple(min(votes[w], key=lambda c: (-round(votes[w][c], 9), c)) for w in knn.WEIGHTS)  # noqa: B023
    assert got == want


def test_model_asks_either_join(spark):
    rows = clustered(200, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    model = knn.train_model(df, "id", "v", "y", params={"n_neighbors": 4})
    assert joined(model.neighbours(df, bar="id")) == joined(model.neighbours(df, bar="id", approximate={"tables": 1, "bits": 0}))


def test_grid_of_many_classes(spark):
    rows = [(i, v, int(i % 60), f) for i, v, _, f in clustered(180, 8, spread=0.8)]
    df = spark.createDataFrame(rows, SCHEMA)
    grid = {(r.weights, r.k): r.accuracy for r in knn.knn_grid(df, "id", "v", "y", max_k=3).collect()}
    near = knn_join(df, df, 3, id_col="id", vector_col="v", label_col="y", bar="fold", metric="euclidean")
    preds = knn.knn_predict(near).withColumnRenamed("query_id", "id").join(df, "id")
    by_fold = preds.groupBy("fold").agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("a"))
    assert grid["uniform", 3] == pytest.approx(by_fold.agg(F.avg("a")).first()[0])


def test_small_distances_are_told_apart(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9e-11, 0.0]), (2, [1e-11, 0.0])], "id int, v array<double>")
    got = joined(knn_join(df, df, 2, id_col="id", vector_col="v", metric="euclidean", bar="id"))
    assert got[0] == [(1e-11, 2), (9e-11, 1)] and [i for _, i in got[1]] == [2, 0]
    angles = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate([0.0, 3e-6, 1e-6, 2.0])]
    got = joined(knn_join(*[spark.createDataFrame(angles, "id int, v array<double>")] * 2, 3, id_col="id", vector_col="v", bar="id"))
    assert [i for _, i in got[0]] == [2, 1, 3] and got[0][0][0] == pytest.approx(5e-13, rel=1e-6)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_rows_that_tie_with_all_references(spark, metric):
    """Zero, binary and one-hot vectors, thousands of equal queries: as brute force, in little time."""
    rng = np.random.default_rng(21)
    refs = [(i, v) for i, v in enumerate([np.zeros(6)] * 5 + list(np.eye(6)) * 20 + list(rng.integers(0, 2, (400, 6)).astype(float)))]
    queries = [(i, refs[i % 500][1]) for i in range(3000)]
    as_df = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id int, v array<double>")
    got = joined(knn_join(as_df(queries), as_df(refs), 4, id_col="id", vector_col="v", metric=metric))
    want = brute(queries[:500], refs, 4, metric)
    for i, _ in queries:
        assert [j for _, j in got[i]] == [j for _, j in want[i % 500]]


def test_many_barred_values(spark, monkeypatch):
    monkeypatch.setattr("sparktab.plans.neighbors.MAX_BARS", 3)
    rows = clustered(150, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    got = joined(knn_join(df, df, 4, id_col="id", vector_col="v", bar="fold", tile_rows=30, pivots=6))
    same(got, brute(rows, rows, 4, "cosine", lambda a, b: a[2] == b[2]))


def test_best_params(spark):
    grid = spark.createDataFrame(
        [("distance", 3, 0.9), ("uniform", 3, 0.9), ("uniform", 5, 0.9), ("uniform", 1, 0.8)],
        "weights string, k int, accuracy double",
    )
    assert tuple(knn.best_params(grid).first()) == ("uniform", 3, 0.9)


def test_model_errors_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame(clustered(60, 9), SCHEMA)
    with pytest.raises(knn.ModelError):
        knn.train_model(df, "id", "v", "y", "svm")
    with pytest.raises(knn.ModelError):
        knn.train_model(df.drop("y"), "id", "v", "y")
    with pytest.raises(knn.ModelError):
        knn.load_model(spark, str(tmp_path / "none"))
    model = knn.train_model(df, "id", "v", "y", params={"n_neighbors": 3, "weights": "distance"})
    knn.save_model(model, str(tmp_path / "m"))
    again = knn.load_model(spark, str(tmp_path / "m"))
    assert again.settings() == model.settings()
    assert sorted(again.predict(df, True).collect()) == sorted(model.predict(df, True).collect())


@pytest.mark.parametrize(
    "params",
    [{"n_neighbours": 3}, {"metric_params": {}}, {"metric": "hamming"}, {"weights": "rank"}, {"metric": "minkowski", "p": 1}, {"n_neighbors": 0}, {"n_neighbors": "3"}, {"n_neighbors": True}],
)
def test_settings_that_mean_nothing_are_refused(params):
    with pytest.raises(knn.ModelError):
        knn.checked_params(params)


def test_settings_and_defaults():
    assert knn.checked_params(None) == knn.checked_params({}) == knn.DEFAULT_PARAMS
    given = {"n_neighbors": 7, "metric": "minkowski", "p": 2, "algorithm": "auto", "leaf_size": 30, "n_jobs": -1, "random_state": 42}
    assert knn.checked_params(given) == {"n_neighbors": 7, "metric": "minkowski", "weights": "uniform"}
    assert knn.checked_params({"p": 1})["metric"] == "cosine"


def test_small_tiles_send_a_row_a_bounded_number_of_times():
    """tiles of 200 rows once sent every row of 100,000 to 500 tasks; what is sent grows with the rows now."""
    for n in (2_000, 10_000, 100_000, 500_000):
        assert max(_parts(n, n, 64, 200, 12)) <= 4
    # what a task holds is bounded all the same
    assert _parts(600_000, 600_000, 64, held_rows(64), 12)[0] == 3
    assert _parts(10**7, 10, 1024, 200, 12)[0] == 1 and _parts(10, 10**7, 1024, 200, 12)[0] == -(-(10**7) // held_rows(1024))
    assert max(_parts(300, 300, 8, 100, 12)) == 3


def _tile_batches(refs, queries, step):
    """One tile as a task gets it: references, then queries in small batches."""
    for name, rows in (("ref", refs), ("query", queries)):
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            n = len(part)
            ids, vectors = pa.array(range(at, at + n), pa.int64()), pa.array(part.tolist(), pa.list_(pa.float32()))
            none = [pa.nulls(n, pa.int64()), pa.nulls(n, vectors.type)]
            q, r = ([ids, vectors], none) if name == "query" else (none, [ids, vectors])
            keys = [pa.array([0] * n, pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([*q, *r, *keys, pa.array([name == "query"] * n)], names=["query_id", "query_vector", "ref_id", "ref_vector", *neighbors.TILE, "queries"])


def test_queries_pass_by_a_tile():
    """a task answers its queries batch by batch and never holds them all."""
    rng, taken = np.random.default_rng(5), []
    refs, queries = rng.normal(size=(300, 16)).astype(np.float32), rng.normal(size=(4000, 16)).astype(np.float32)

    def given():
        for batch in _tile_batches(refs, queries, 100):
            taken.append(batch.num_rows)
            yield batch

    out, seen = [], 0
    for found in neighbors._tile_join(3, "cosine", "self", ["query_id", "ref_id", "dist"])(given()):
        seen += found.num_rows // 3
        assert sum(taken) - len(refs) <= seen + 100
        out += found.to_pylist()
    cos = (queries / np.linalg.norm(queries, axis=1)[:, None]).astype(float) @ (refs / np.linalg.norm(refs, axis=1)[:, None]).astype(float).T
    cos[np.arange(300), np.arange(300)] = -2
    want = np.argsort(-cos, axis=1)[:, :3]
    assert len(out) == 12000 and {(r["query_id"], r["ref_id"]) for r in out} == {(i, j) for i in range(4000) for j in want[i].tolist()}


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_blocks_after_the_first_are_seldom_cut(monkeypatch, metric):
    """the k-th distance so far spares most blocks the selection of their k best, which took most of the time."""
    rng, cuts, real = np.random.default_rng(6), [], np.partition
    refs, queries = rng.normal(size=(6000, 16)), rng.normal(size=(40, 16))
    monkeypatch.setattr(neighbors, "BLOCK_REFS", 200)
    monkeypatch.setattr(np, "partition", lambda *a, **k: cuts.append(1) or real(*a, **k))
    bars = np.arange(6000) % 5
    rows, cols, dist = neighbors._Nearest(refs, metric, 10, bars, False)(queries, np.arange(40) % 5)
    assert len(cuts) <= 3
    points = [x / np.linalg.norm(x, axis=1)[:, None] if metric == "cosine" else x for x in (queries, refs)]
    gap = np.linalg.norm(points[0][:, None] - points[1][None], axis=2)
    gap[np.arange(40)[:, None] % 5 == bars[None]] = np.inf
    assert (cols.reshape(40, 10) == np.argsort(gap, axis=1, kind="stable")[:, :10]).all()
