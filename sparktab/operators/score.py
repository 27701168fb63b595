"""Scoring new rows with a fitted model: tables, files and JSON records."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.values import quoted, sql_name
from sparktab.operators.knn import KnnModel, ModelError, load_model, save_model
from sparktab.operators.preprocess import (
    PreprocessError,
    Preprocessor,
    columns_to_array,
    definition,
    from_definition,
    load_params,
    read_text,
    rename_columns,
    require_columns,
    save_params,
    write_text,
)
from sparktab.sources.readers import read_table
from sparktab.sources.writers import write_predictions

# The fields of one request record.
RECORD_FIELDS = (
    "mean_radius",
    "mean_texture",
    "mean_perimeter",
    "mean_area",
    "mean_smoothness",
    "mean_compactness",
    "mean_concavity",
    "mean_concave_points",
    "mean_symmetry",
    "mean_fractal_dimension",
    "radius_error",
    "texture_error",
    "perimeter_error",
    "area_error",
    "smoothness_error",
    "compactness_error",
    "concavity_error",
    "concave_points_error",
    "symmetry_error",
    "fractal_dimension_error",
    "worst_radius",
    "worst_texture",
    "worst_perimeter",
    "worst_area",
    "worst_smoothness",
    "worst_compactness",
    "worst_concavity",
    "worst_concave_points",
    "worst_symmetry",
    "worst_fractal_dimension",
)


@dataclass
class Scorer:
    """A model with the preprocessing its input needs.

    ``features`` are the input columns that must be there, under the names they
    have before ``rename``. Without a preprocessor they are the vector itself,
    in order.
    """

    model: KnnModel
    features: Sequence[str]
    preprocessor: Preprocessor | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)

    def vectors(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns and the vector of every row, after the feature check."""
        before, there = {new: old for old, new in self.rename.items()}, set(rename_columns(df, self.rename).columns)
        lacking = [before.get(c, c) for c in self.renamed_features() if c not in there]
        if lacking:
            raise PreprocessError(f"missing columns: {', '.join(lacking)}")
        ready, names = rename_columns(df, {k: v for k, v in self.rename.items() if k not in keep}), self.renamed_features()
        if self.preprocessor is not None:
            ready, names = self.preprocessor.transform(ready, self.params, keep=keep), self.vector_names()
        return columns_to_array(ready, names, self.model.vector_col, keep=keep)

    def vector_names(self) -> list[str]:
        """What the places of the vector hold."""
        return self.renamed_features() if self.preprocessor is None else self.preprocessor.output_names(self.params)

    def renamed_features(self) -> list[str]:
        return [self.rename.get(c, c) for c in self.features]

    def predict(self, df: DataFrame, proba: bool = False) -> DataFrame:
        """``<id>, [class_0..class_n,] prediction`` for every row."""
        require_columns(df, [self.model.id_col])
        return self.model.predict(self.vectors(df, [self.model.id_col]), proba)


def save_scorer(scorer: Scorer, path: str) -> None:
    """Model, preprocessor, fitted parameters and input names, for another process to load."""
    spark = scorer.model.refs.sparkSession
    save_model(scorer.model, f"{path}/model")
    plan = scorer.preprocessor
    if plan is not None:
        save_params(spark, scorer.params, f"{path}/fitted")
    saved = {"features": list(scorer.features), "rename": dict(scorer.rename), "preprocessor": None if plan is None else definition(plan)}
    write_text(spark, json.dumps(saved), f"{path}/scorer")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    try:
        saved = json.loads(read_text(spark, f"{path}/scorer"))
    except AnalysisException as error:
        raise ModelError(f"no scorer at {path}") from error
    plan = saved["preprocessor"]
    return Scorer(
        model=load_model(spark, f"{path}/model"),
        features=saved["features"],
        preprocessor=None if plan is None else from_definition(plan),
        params={} if plan is None else load_params(spark, f"{path}/fitted"),
        rename=saved["rename"],
    )


def positive_share(model: KnnModel) -> Column:
    """The share of the second class, which is the positive one of two."""
    return F.col("class_1") if len(model.classes) > 1 else F.lit(0.0)


def _with_vectors(df: DataFrame, scorer: Scorer, made: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """The vectors beside all input columns but the ``made`` ones, under names no feature has; and these columns by old name."""
    prefix, there = "_in", df.columns
    while any(c.startswith(prefix) for c in there):
        prefix += "_"
    columns = [c for c in there if c not in made]
    carried = [f"{prefix}{i}" for i in range(len(columns))]
    both = df.select("*", *[quoted(c).alias(new) for c, new in zip(columns, carried, strict=True)])
    return scorer.vectors(both, carried), {c: F.col(new).alias(c) for c, new in zip(columns, carried, strict=True)}


def _vote(vectors: DataFrame, back: Mapping[str, Column], scorer: Scorer, proba: bool) -> DataFrame:
    found = scorer.model.append(vectors, proba)
    share = [positive_share(scorer.model).alias("prediction_proba")] if proba else []
    return found.select(*back.values(), "prediction", *share)


def _set_aside(vectors: DataFrame, back: Mapping[str, Column], scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """Vectors that are whole, and the input rows of the others with the names of what they lack."""
    lacking, names = "missing_features", F.array(*[F.lit(n) for n in scorer.vector_names()])
    bad = F.transform(scorer.model.vector_col, lambda x, i: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.get(names, i)))
    marked = vectors.withColumn(lacking, F.array_compact(bad))
    rejected = marked.where(F.size(lacking) > 0).select(*[c for n, c in back.items() if n != lacking], lacking)
    return marked.where(F.size(lacking) == 0).drop(lacking), rejected


def _made(proba: bool) -> list[str]:
    return ["prediction", *(["prediction_proba"] if proba else [])]


def score(df: DataFrame, scorer: Scorer, proba: bool = False) -> DataFrame:
    """Every input row with ``prediction`` and, if asked, ``prediction_proba``.

    Rows carry their columns past the vote, so they need no id: rows with a null id
    or one that repeats are scored like any other. Columns that bear the new names
    already are replaced. A feature that is still missing after imputation raises
    while the job runs; ``score_or_reject`` sets such rows aside.
    """
    return _vote(*_with_vectors(df, scorer, _made(proba)), scorer, proba)


def score_or_reject(df: DataFrame, scorer: Scorer, proba: bool = False) -> tuple[DataFrame, DataFrame]:
    """The scored rows, and the input rows no vote can be had for, with ``missing_features``.

    Rejected are rows with a null, NaN or infinite value among the features as the
    model takes them, thus after imputation; every such feature is named. One bad
    row costs its own score and nothing else.
    """
    vectors, back = _with_vectors(df, scorer, _made(proba))
    whole, rejected = _set_aside(vectors, back, scorer)
    return _vote(whole, back, scorer, proba), rejected


def prediction_summary(scored: DataFrame) -> DataFrame:
    """Number of predictions and mean, least and greatest probability."""
    p = F.col("prediction_proba")
    return scored.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg(p).alias("proba_mean"),
        F.min(p).alias("proba_min"),
        F.max(p).alias("proba_max"),
    )


def score_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    scorer: Scorer | str,
    proba: bool = False,
    schema: T.StructType | None = None,
    output_format: str = "parquet",
    rejects_path: str | None = None,
) -> DataFrame:
    """File in, predictions file out; the scorer is one at hand or the path of a saved one.

    With ``rejects_path`` rows that miss a feature are written there, as Parquet with
    their columns and ``missing_features``; without it the first of them fails the job.
    Returns the written predictions.
    """
    scorer = load_scorer(spark, scorer) if isinstance(scorer, str) else scorer
    df = read_table(spark, input_path, schema=schema)
    if rejects_path is None:
        found = scorer.predict(df, proba)
    else:
        require_columns(df, [scorer.model.id_col])
        vectors, back = _with_vectors(df, scorer, [])
        whole, rejected = _set_aside(vectors, back, scorer)
        rejected.write.mode("overwrite").parquet(rejects_path)
        found = scorer.model.predict(whole.select(back[scorer.model.id_col], scorer.model.vector_col), proba)
    write_predictions(found, output_path, scorer.model.id_col, output_format)
    options = {"schema": None} if output_format == "csv" else {}
    return read_table(spark, output_path, output_format, **options)


def record_schema(fields: Sequence[str] = RECORD_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(name, T.DoubleType(), False) for name in fields])


def parse_records(
    df: DataFrame, json_col: str, fields: Sequence[str] = RECORD_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Records with every field a number, as columns; and the rejects with their text.

    Rejected are texts that are no JSON, records without a field, and fields
    that are null, NaN or no number. Each text is parsed once: the record is
    unpacked by a generator, below which no filter is pushed.
    """
    rest, text = [sql_name(c) for c in df.columns if c != json_col], sql_name(json_col)
    names = [sql_name(n) for n in fields]
    schema = ", ".join(f"{n} double" for n in names)
    record = f"from_json({text}, '{schema}', map('mode', 'PERMISSIVE'))"
    parsed = df.selectExpr(*rest, text, f"inline_outer(array({record}))")
    texts = ["'" + f.replace("'", r"\'") + "'" for f in fields]
    absent = ", ".join(f"if({n} is null or isnan({n}), {t}, null)" for t, n in zip(texts, names, strict=True))
    marked = parsed.selectExpr("*", f"array_compact(array({absent})) as missing_fields")
    good = marked.where("size(missing_fields) = 0").drop(json_col, "missing_fields")
    bad = marked.where("size(missing_fields) > 0").selectExpr(*rest, text, "missing_fields")
    return good, bad


def score_json(
    df: DataFrame, json_col: str, scorer: Scorer
) -> tuple[DataFrame, DataFrame]:
    """``<id>, prediction, probability`` of good records, and the rejects."""
    good, bad = parse_records(df, json_col, scorer.features)
    found = scorer.predict(good, proba=True)
    share = positive_share(scorer.model).alias("probability")
    return found.select(scorer.model.id_col, "prediction", share), bad
