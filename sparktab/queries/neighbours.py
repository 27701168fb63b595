"""Neighbour joins and kNN classification on the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.distance import distance
from sparktab.operators import knn
from sparktab.operators.split import kfold, stratified_split
from sparktab.plans.approx import SEED, knn_join_approx, recall
from sparktab.plans.neighbors import knn_join
from sparktab.queries.registry import query, table
from sparktab.queries.sql import neighbour_ctes, split_ctes, vectors, vote_ctes
from sparktab.session import materialize, scratch_path

SELF = f"""WITH base AS ({vectors()}), {neighbour_ctes("base", "base", 5, "q.id <> r.id")}"""


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def _self_join(embeddings: DataFrame, metric: str = "cosine") -> DataFrame:
    return knn_join(
        embeddings,
        embeddings,
        5,
        id_col="vec_id",
        vector_col="embedding",
        label_col="label",
        metric=metric,
        bar="vec_id",
    )


@query(SELF + "SELECT query_id, ref_id, ref_label, round(dist, 9) AS dist, rank FROM near")
def knn_self(spark: SparkSession, folder: str) -> DataFrame:
    return _self_join(_embeddings(spark, folder)).withColumn("dist", F.round("dist", 9))


@query(SELF + "SELECT query_id, ref_id, ref_label, round(dist, 9) AS dist, rank FROM near")
def knn_self_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same join by way of cells around pivots and several tiles, as large tables take it."""
    embeddings = _embeddings(spark, folder)
    found = knn_join(
        embeddings, embeddings, 5, id_col="vec_id", vector_col="embedding", label_col="label", bar="vec_id", tile_rows=200, pivots=16
    )
    return found.withColumn("dist", F.round("dist", 9))


#: Settings of the approximate join for vectors that hardly cluster, as the embeddings are.
APPROX = {"tables": 16, "bits": 6, "flips": 2}


def buckets_sql(source: str, dim: int, tables: int, bits: int, flips: int) -> str:
    """CTEs ending in ``own`` (id, table, bucket) and ``visited`` (id, table, bucket of every crossing)."""
    crossings = " UNION ALL ".join(
        f"SELECT id, t, xor(bucket, {' + '.join(f'(1 << near[{j + 1}])' for j in range(flips) if way >> j & 1) or '0'}) AS bucket FROM sided" for way in range(1 << flips)
    )
    return f"""
    drawn AS (
      SELECT p, i, md5('{SEED}|' || p || '|' || i) AS h
      FROM (SELECT unnest(range({tables * bits})) AS p) CROSS JOIN (SELECT unnest(range({dim})) AS i)),
    planes AS (
      SELECT p, list(sqrt(-2 * ln((('0x' || substr(h, 1, 13))::BIGINT + 1) / pow(2, 52)))
        * cos(2 * pi() * ('0x' || substr(h, 14, 13))::BIGINT / pow(2, 52)) ORDER BY i) AS plane FROM drawn GROUP BY p),
    margins AS (SELECT id, p // {bits} AS t, p % {bits} AS j, list_dot_product(v, plane) AS m FROM {source}, planes),
    sided AS (
      SELECT id, t, sum(CASE WHEN m >= 0 THEN 1 << j ELSE 0 END)::BIGINT AS bucket, list(j ORDER BY abs(m)) AS near FROM margins GROUP BY ALL),
    own AS (SELECT id, t, bucket FROM sided),
    visited AS ({crossings})"""


@query(
    f"""WITH base AS ({vectors()}), {buckets_sql("base", 64, **APPROX)},
    {neighbour_ctes("base", "base", 5, "q.id <> r.id")},
    met AS (SELECT DISTINCT q.id AS query_id, r.id AS ref_id FROM visited q JOIN own r ON q.t = r.t AND q.bucket = r.bucket AND q.id <> r.id),
    found AS (
      SELECT query_id, ref_id, ref_label, dist, row_number() OVER (PARTITION BY query_id ORDER BY dist, ref_id)::INTEGER AS rank
      FROM met JOIN pairs USING (query_id, ref_id) QUALIFY rank <= 5)
    SELECT query_id, ref_id, ref_label, round(dist, 9) AS dist, rank,
      (SELECT count(f.ref_id) / count(*) FROM near n LEFT JOIN found f USING (query_id, ref_id)) AS recall FROM found"""
)
def knn_self_approx(spark: SparkSession, folder: str) -> DataFrame:
    """The self join by hyperplane buckets, with its recall against the exact join beside every row."""
    embeddings = _embeddings(spark, folder)
    found = knn_join_approx(embeddings, embeddings, 5, id_col="vec_id", vector_col="embedding", label_col="label", bar="vec_id", **APPROX)
    found = materialize(found, "found")
    share = recall(found, _self_join(embeddings)).select("recall")
    return found.withColumn("dist", F.round("dist", 9)).crossJoin(F.broadcast(share))


@query(
    f"""WITH base AS ({vectors()}), {neighbour_ctes("base", "base", 5, "q.id <> r.id", "euclidean")}
    SELECT query_id, ref_id, ref_label, round(dist, 6) AS dist, rank FROM near"""
)
def knn_self_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    found = _self_join(_embeddings(spark, folder), "euclidean")
    return found.withColumn("dist", F.round("dist", 6))


@query(
    SELF
    + """SELECT query_id, ref_id, round(1 - list_dot_product(a.v, b.v)
        / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cosine,
      round(list_distance(a.v, b.v), 6) AS euclidean, round(list_distance(a.v, b.v), 6) AS minkowski
    FROM near JOIN base a ON query_id = a.id JOIN base b ON ref_id = b.id"""
)
def distance_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """All three distances between every row and its nearest rows."""
    embeddings = _embeddings(spark, folder)
    pairs = _self_join(embeddings).select("query_id", "ref_id")
    left = embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("a"))
    right = embeddings.select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("b"))
    both = pairs.join(left, "query_id").join(right, "ref_id")
    metrics = ("cosine", "euclidean", "minkowski")
    return both.select(
        "query_id",
        "ref_id",
        *[F.round(distance(F.col("a"), F.col("b"), m), 6).alias(m) for m in metrics],
    )


TRAIN_TEST = f"""WITH base AS ({vectors()}), {split_ctes("base", "vec_id", "label")},
  train_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
  other_rows AS (SELECT * FROM split_rows WHERE split <> 'train'),
  {neighbour_ctes("other_rows", "train_rows", 5)}"""


def _model(spark: SparkSession, folder: str, **params) -> tuple[knn.KnnModel, DataFrame]:
    """A model of the training split, and the rows of the other two."""
    split = stratified_split(_embeddings(spark, folder), "vec_id", "label")
    train = split.where(F.col("split") == "train")
    model = knn.train_model(train, "vec_id", "embedding", "label", params=params)
    return model, split.where(F.col("split") != "train")


@query(
    f"""WITH base AS ({vectors()}), {split_ctes("base", "vec_id", "label")}
    SELECT vec_id, label, len(v)::INTEGER AS n_values FROM split_rows WHERE split = 'train'"""
)
def knn_fit(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = _model(spark, folder)
    return model.refs.select("vec_id", "label", F.size("embedding").alias("n_values"))


@query(f"""{TRAIN_TEST}, {vote_ctes()} SELECT query_id AS vec_id, prediction FROM voted""")
def knn_predict(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = _model(spark, folder)
    return model.predict(rows)


SHARES = ", ".join(f"coalesce(round(max(share) FILTER (label = {c}), 6), 0) AS class_{c}" for c in range(10))


@query(
    f"""{TRAIN_TEST}, {vote_ctes()}
    SELECT query_id AS vec_id, prediction, {SHARES} FROM shares JOIN voted USING (query_id) GROUP BY ALL"""
)
def knn_proba(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = _model(spark, folder)
    found = model.predict(rows, proba=True)
    return found.withColumns({f"class_{c}": F.round(f"class_{c}", 6) for c in range(10)})


@query(
    f"""{TRAIN_TEST}, {vote_ctes("distance")}
    SELECT query_id AS vec_id, prediction, {SHARES} FROM shares JOIN voted USING (query_id) GROUP BY ALL"""
)
def knn_weighted(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = _model(spark, folder, weights="distance")
    found = model.predict(rows, proba=True)
    return found.withColumns({f"class_{c}": F.round(f"class_{c}", 6) for c in range(10)})


GRID = f"""WITH base AS ({vectors()}),
  folds AS (
    SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || vec_id)) - 1) % 5 AS fold FROM base),
  {neighbour_ctes("folds", "folds", 50, "q.fold <> r.fold")},
  two AS (
    SELECT query_id, rank, ref_label, 'uniform' AS weights, 1.0::DOUBLE AS w FROM near
    UNION ALL
    SELECT query_id, rank, ref_label, 'distance', CASE WHEN min(dist) OVER (PARTITION BY query_id) = 0
      THEN (dist = 0)::INTEGER::DOUBLE ELSE 1 / dist END FROM near),
  at_k AS (
    SELECT t.query_id, t.weights, k.k, t.ref_label, sum(t.w) AS votes
    FROM two t JOIN (SELECT unnest(range(1, 51))::INTEGER AS k) k ON t.rank <= k.k GROUP BY ALL),
  chosen AS (
    SELECT query_id, weights, k, ref_label FROM at_k
    QUALIFY row_number() OVER (PARTITION BY query_id, weights, k ORDER BY round(votes, 9) DESC, ref_label) = 1),
  by_fold AS (
    SELECT weights, k, fold, avg((ref_label = label)::INTEGER) AS acc
    FROM chosen JOIN folds ON query_id = id GROUP BY ALL),
  grid AS (SELECT weights, k, round(avg(acc), 6) AS accuracy FROM by_fold GROUP BY ALL)"""


def _grid(spark: SparkSession, folder: str) -> DataFrame:
    folds = materialize(kfold(_embeddings(spark, folder), "vec_id", "label"), "folds")
    grid = knn.knn_grid(folds, "vec_id", "embedding", "label", metric="cosine")
    return grid.withColumn("accuracy", F.round("accuracy", 6))


@query(GRID + "SELECT weights, k, accuracy FROM grid")
def knn_grid_search(spark: SparkSession, folder: str) -> DataFrame:
    return _grid(spark, folder)


@query(GRID + "SELECT weights, k, accuracy FROM grid ORDER BY accuracy DESC, k, weights = 'distance' LIMIT 1")
def knn_best_params(spark: SparkSession, folder: str) -> DataFrame:
    return knn.best_params(_grid(spark, folder), 6)


def _scored(spark: SparkSession, folder: str, only_held_out: bool) -> DataFrame:
    split = stratified_split(_embeddings(spark, folder), "vec_id", "label")
    model = knn.train_model(split.where(F.col("split") == "train"), "vec_id", "embedding", "label")
    rows = split.where(F.col("split") != "train") if only_held_out else split
    return rows.select("vec_id", "split", "label").join(model.predict(rows), "vec_id")


@query(
    f"""{TRAIN_TEST}, {vote_ctes()}
    SELECT count(*)::BIGINT AS n_rows, round(avg((label <> prediction)::INTEGER), 6) AS error_rate
    FROM other_rows JOIN voted ON id = query_id"""
)
def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    out = knn.error_rate(_scored(spark, folder, True), "label")
    return out.withColumn("error_rate", F.round("error_rate", 6))


@query(
    f"""WITH base AS ({vectors()}), {split_ctes("base", "vec_id", "label")},
    train_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
    {neighbour_ctes("split_rows", "train_rows", 5)}, {vote_ctes()}
    SELECT split, count(*)::BIGINT AS n_rows, round(avg((label = prediction)::INTEGER) * 100, 2) AS accuracy_pct
    FROM split_rows JOIN voted ON id = query_id GROUP BY ALL"""
)
def accuracy_by_split(spark: SparkSession, folder: str) -> DataFrame:
    return knn.accuracy_by(_scored(spark, folder, False), "split", "label")


@query(f"""{TRAIN_TEST}, {vote_ctes()} SELECT query_id AS vec_id, prediction FROM voted""")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = _model(spark, folder)
    path = scratch_path(spark, "model")
    knn.save_model(model, path)
    return knn.load_model(spark, path).predict(materialize(rows, "rows"))
