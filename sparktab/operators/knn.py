"""Nearest-neighbour classification: model, votes, shares, and one-pass grid search."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparktab.functions.distance import METRICS
from sparktab.functions.values import quoted
from sparktab.operators.split import class_counts
from sparktab.plans.approx import knn_join_approx
from sparktab.plans.neighbors import _matrix, _Nearest, _vectors, knn_join, nearest_distinct
from sparktab.session import materialize

# The vote weightings and the parameters of a model that names none.
WEIGHTS = ("uniform", "distance")
DEFAULT_PARAMS = {"n_neighbors": 5, "metric": "cosine", "weights": "uniform"}
#: Settings that say how neighbours are found, not which: taken and not looked at.
NO_EFFECT = ("algorithm", "leaf_size", "n_jobs", "random_state")

VOTE_DIGITS = 9
#: Bytes of reference vectors up to which a model is sent to the rows instead of the rows to tiles.
LOCAL_BYTES = 64 << 20


class ModelError(ValueError):
    """The model cannot be built or read."""


@dataclass
class KnnModel:
    """Reference rows (id, vector, label) as a table, and how to vote."""

    refs: DataFrame
    id_col: str
    vector_col: str
    label_col: str
    classes: list
    n_neighbors: int = 5
    metric: str = "cosine"
    weights: str = "uniform"
    _local: Any = field(default=None, init=False, repr=False, compare=False)

    def local(self) -> Local | None:
        """The references on the driver if they are few enough, counted first; kept for later calls."""
        if self._local is None:
            size = self.refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(self.vector_col)).alias("d")).first()
            if 8 * size["n"] * max(size["d"] or 0, 1) > LOCAL_BYTES:
                return None
            got = self.refs.orderBy(self.id_col).select(self.vector_col, self.label_col).toArrow()
            place = {c: i for i, c in enumerate(sorted(self.classes))}
            codes = np.array([place[c] for c in got.column(1).to_pylist()], dtype=np.int64)
            vectors = _matrix(got, self.vector_col) if len(codes) else np.zeros((0, 0))
            spark = self.refs.sparkSession
            self._local = spark.sparkContext.broadcast(Local(vectors, codes, sorted(self.classes), self.n_neighbors, self.metric, self.weights))
        return self._local

    def neighbours(self, queries: DataFrame, bar: str | None = None, approximate: Mapping[str, Any] | None = None) -> DataFrame:
        """The nearest references of every row; exact unless settings of the approximate join are given."""
        join = knn_join if approximate is None else knn_join_approx
        return join(
            queries,
            self.refs,
            self.n_neighbors,
            id_col=self.id_col,
            vector_col=self.vector_col,
            label_col=self.label_col,
            metric=self.metric,
            bar=bar,
            **(approximate or {}),
        )

    def predict(self, queries: DataFrame, proba: bool = False) -> DataFrame:
        """``<id>, prediction`` and, if asked, ``class_0..class_n`` vote shares; one row for every row."""
        queries = queries.select(self.id_col, self.vector_col)
        out = self.append(queries, proba).drop(self.vector_col)
        return out.select(self.id_col, *[f"class_{i}" for i in range(len(self.classes)) if proba], "prediction")

    def append(self, df: DataFrame, proba: bool = False) -> DataFrame:
        """The rows with ``[class_0..class_n,] prediction``; needs no id in them.

        A small model is sent to the rows, which then neither move nor join.
        Before a large one the rows are numbered and written, and the number
        stands for the row in the join.
        """
        local = self.local()
        if local is not None:
            return vote_in_place(df, self.vector_col, local, self.refs.schema[self.label_col].dataType, proba)
        row = "_row"
        numbered = materialize(df.withColumn(row, F.monotonically_increasing_id()), "rows")
        refs = self.refs.select(F.col(self.id_col).alias(row), self.vector_col, self.label_col)
        near = knn_join(numbered, refs, self.n_neighbors, id_col=row, vector_col=self.vector_col, label_col=self.label_col, metric=self.metric)
        found = knn_predict(near, self.classes if proba else None, self.weights).withColumnRenamed("query_id", row)
        return numbered.join(found, row, "left").select(*map(quoted, df.columns), *[c for c in found.columns if c != row])

    def settings(self) -> dict[str, Any]:
        """Everything but the reference rows."""
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("refs", "_local")}


@dataclass
class Local:
    """The references in memory: vectors by id, class codes, classes, and how to vote."""

    vectors: np.ndarray
    codes: np.ndarray
    classes: list
    n_neighbors: int
    metric: str
    weights: str

    def vote(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class code (-1 without references) and vote share of each class for every query."""
        votes = np.zeros((len(queries), max(1, len(self.classes))))
        if not len(self.codes) or not len(queries):
            return np.full(len(queries), -1), votes
        if queries.shape[1] != self.vectors.shape[1]:
            raise ValueError("query and reference vectors of unequal length")
        rows, cols, dist = nearest_distinct(_Nearest(self.vectors, self.metric, self.n_neighbors), queries)
        weight = np.ones(len(rows))
        if self.weights == "distance":
            exact = np.zeros(len(queries), bool)
            exact[rows[dist == 0]] = True
            weight = np.where(exact[rows], dist == 0, 1.0 / np.where(dist > 0, dist, 1.0))
        np.add.at(votes, (rows, self.codes[cols]), weight)
        return np.round(votes, VOTE_DIGITS).argmax(axis=1), votes / votes.sum(axis=1, keepdims=True)


def vote_in_place(df: DataFrame, vector_col: str, local, label_type: T.DataType, proba: bool) -> DataFrame:
    """Add the votes of a broadcast model to every row, in its partition.

    Only the vector goes to Python; the other columns of the row wait in the JVM.
    """
    shares = [f"class_{i}" for i in range(len(local.value.classes))] if proba else []
    voted = T.StructType([*[T.StructField(c, T.DoubleType()) for c in shares], T.StructField("prediction", label_type)])
    label_arrow = to_arrow_type(label_type)

    @F.arrow_udf(voted)
    def vote(vectors: pa.Array) -> pa.Array:
        model = local.value
        codes, votes = model.vote(_vectors(vectors, vector_col))
        labels = pa.array([model.classes[c] if c >= 0 else None for c in codes], label_arrow)
        return pa.StructArray.from_arrays([*[pa.array(votes[:, i]) for i in range(len(shares))], labels], names=voted.names)

    name = "_vote"
    while name in df.columns:
        name += "_"
    out = df.withColumn(name, vote(quoted(vector_col)))
    return out.select(*map(quoted, df.columns), *[F.col(name).getField(c).alias(c) for c in voted.names])


def checked_params(params: Mapping[str, Any] | None) -> dict[str, Any]:
    """Model settings with the defaults of those not given.

    A name that is not known is refused, so that no setting is dropped in silence.
    ``p`` is the exponent of the Minkowski distance, of which only 2 is there;
    other metrics do not use it.
    """
    given = dict(params or {})
    unknown = sorted(set(given) - {*DEFAULT_PARAMS, *NO_EFFECT, "p"})
    if unknown:
        raise ModelError(f"unknown model settings: {', '.join(unknown)}; known: {', '.join([*DEFAULT_PARAMS, 'p', *NO_EFFECT])}")
    out = {name: given.get(name, default) for name, default in DEFAULT_PARAMS.items()}
    if out["metric"] not in METRICS:
        raise ModelError(f"unknown metric {out['metric']!r}")
    if out["weights"] not in WEIGHTS:
        raise ModelError(f"unknown weights {out['weights']!r}")
    if out["metric"] == "minkowski" and given.get("p", 2) != 2:
        raise ModelError(f"the Minkowski distance has p = 2 only, not {given['p']!r}")
    if isinstance(out["n_neighbors"], bool) or not isinstance(out["n_neighbors"], int) or out["n_neighbors"] < 1:
        raise ModelError(f"n_neighbors must be a whole number of 1 or more, not {out['n_neighbors']!r}")
    return out


def fit_knn(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, params: Mapping[str, Any] | None = None
) -> KnnModel:
    """Write the training rows once, with the sorted classes."""
    params = checked_params(params)
    for name in (id_col, vector_col, label_col):
        if name not in df.columns:
            raise ModelError(f"missing column {name!r}")
    refs = materialize(df.select(id_col, vector_col, label_col), "references")
    return KnnModel(
        refs=refs,
        id_col=id_col,
        vector_col=vector_col,
        label_col=label_col,
        classes=list(class_counts(refs, label_col)),
        n_neighbors=params["n_neighbors"],
        metric=params["metric"],
        weights=params["weights"],
    )


MODEL_TYPES: dict[str, Callable[..., KnnModel]] = {"knn": fit_knn}


def train_model(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    label_col: str,
    model_type: str = "knn",
    params: Mapping[str, Any] | None = None,
) -> KnnModel:
    if model_type not in MODEL_TYPES:
        raise ModelError(f"unknown model type {model_type!r}; known: {', '.join(MODEL_TYPES)}")
    return MODEL_TYPES[model_type](df, id_col, vector_col, label_col, params)


def save_model(model: KnnModel, path: str) -> None:
    """Reference rows as Parquet, settings as one JSON text beside them."""
    spark = model.refs.sparkSession
    model.refs.write.mode("overwrite").parquet(f"{path}/refs")
    text = json.dumps(model.settings())
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> KnnModel:
    try:
        settings = json.loads(spark.read.text(f"{path}/settings").first().value)
        refs = spark.read.parquet(f"{path}/refs")
    except AnalysisException as error:
        raise ModelError(f"no model at {path}") from error
    return KnnModel(refs=refs, **settings)


def with_weights(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Add ``weight``: 1, or 1/distance where exact matches win alone."""
    if weights == "uniform":
        return neighbours.withColumn("weight", F.lit(1.0))
    if weights != "distance":
        raise ModelError(f"unknown weights {weights!r}")
    least = F.min("dist").over(W.partitionBy("query_id"))
    weight = F.when(least == 0, (F.col("dist") == 0).cast("double")).otherwise(
        F.try_divide(F.lit(1.0), F.col("dist"))
    )
    return neighbours.withColumn("weight", weight)


def knn_predict(
    neighbours: DataFrame, classes: Sequence | None = None, weights: str = "uniform"
) -> DataFrame:
    """Majority vote per query, ties to the smallest label.

    With ``classes`` also the vote share of each as ``class_<i>``, in sorted
    order. The neighbour join leaves its rows partitioned by query, so the
    vote adds no shuffle.
    """
    votes = with_weights(neighbours, weights).groupBy("query_id", "ref_label")
    votes = votes.agg(F.sum("weight").alias("votes"))
    best = F.struct(-F.round("votes", VOTE_DIGITS), F.col("ref_label"))
    shares = [
        F.coalesce(
            F.try_divide(F.sum(F.when(F.col("ref_label") == F.lit(c), F.col("votes"))), F.sum("votes")),
            F.lit(0.0),
        ).alias(f"class_{i}")
        for i, c in enumerate(sorted(classes or []))
    ]
    return votes.groupBy("query_id").agg(*shares, F.min_by("ref_label", best).alias("prediction"))


def _choices(weighted: DataFrame, weights: Sequence[str]) -> DataFrame:
    """The prediction at every k, on the row of rank k: ``query_id, k`` and one column for each weighting.

    A label's votes never fall along the rank, so the winner among the first k rows is
    the best running count any of them has. Both windows run in the partitioning of the
    join, whatever the number of classes, and hold one row per neighbour.
    """
    own = W.partitionBy("query_id", "ref_label").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    so_far = W.partitionBy("query_id").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    counted = weighted.select("query_id", "rank", "ref_label", *[F.round(F.sum(w).over(own), VOTE_DIGITS).alias(w) for w in weights])
    best = [F.min(F.struct(-F.col(w), F.col("ref_label"))).over(so_far).getField("ref_label").alias(w) for w in weights]
    return counted.select("query_id", F.col("rank").alias("k"), *best)


def knn_grid(
    folds: DataFrame,
    id_col: str,
    vector_col: str,
    label_col: str,
    fold_col: str = "fold",
    max_k: int = 50,
    weights: Sequence[str] = WEIGHTS,
    metric: str = "euclidean",
) -> DataFrame:
    """Cross-validated accuracy of every k up to ``max_k`` under each weighting.

    One join finds the ``max_k`` nearest rows outside the query's own fold;
    running votes along the rank then give the prediction for all k in one pass.
    Returns ``weights, k, accuracy`` as the mean over the folds' accuracies.
    ``folds`` is read several times and is best a stored table.
    """
    nearest = knn_join(
        folds, folds, max_k, id_col=id_col, vector_col=vector_col, label_col=label_col, metric=metric, bar=fold_col
    )
    least = F.min("dist").over(W.partitionBy("query_id"))
    near = F.when(least == 0, (F.col("dist") == 0).cast("double")).otherwise(
        F.try_divide(F.lit(1.0), F.col("dist"))
    )
    weighted = nearest.withColumns({"uniform": F.lit(1.0), "distance": near})
    chosen = _choices(weighted, weights)
    truth = folds.select(F.col(id_col).alias("query_id"), F.col(fold_col).alias("fold"), F.col(label_col).alias("label"))
    hits = chosen.join(truth, "query_id").groupBy("k", "fold")
    by_fold = hits.agg(*[F.avg((F.col(w) == F.col("label")).cast("double")).alias(w) for w in weights])
    means = by_fold.groupBy("k").agg(*[F.avg(w).alias(w) for w in weights])
    return means.unpivot(["k"], list(weights), "weights", "accuracy").select("weights", "k", "accuracy")


def best_params(grid: DataFrame, digits: int = 9) -> DataFrame:
    """The best row: highest accuracy, then smallest k, then uniform votes."""
    uniform_first = F.col("weights") == "distance"
    return grid.orderBy(F.round("accuracy", digits).desc(), "k", uniform_first).limit(1)


def error_rate(scored: DataFrame, label_col: str, pred_col: str = "prediction") -> DataFrame:
    wrong = (F.col(label_col) != F.col(pred_col)).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(wrong).alias("error_rate"))


def accuracy_by(scored: DataFrame, by: str, label_col: str, pred_col: str = "prediction") -> DataFrame:
    """Accuracy in percent, two digits, per group."""
    hit = (F.col(label_col) == F.col(pred_col)).cast("double")
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(hit) * 100, 2).alias("accuracy_pct")
    )
