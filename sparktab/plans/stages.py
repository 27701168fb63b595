"""The data, train and infer stages, each a chain of lazy tables and small fits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.operators.evaluate import classification_report
from sparktab.operators.knn import KnnModel, checked_params, train_model
from sparktab.operators.preprocess import Preprocessor, build_preprocessor, columns_to_array, rename_columns, require_columns
from sparktab.operators.score import Scorer, score
from sparktab.operators.split import stratified_split
from sparktab.operators.validate import Watch, act_on, configured_rules, run_validation
from sparktab.session import materialize
from sparktab.sources.readers import SourceError, load_source, require_rows, schema_from_rules

VECTOR = "features"


@dataclass
class Trained:
    """What the train stage leaves behind."""

    scorer: Scorer
    processed: DataFrame
    predictions: DataFrame
    report: DataFrame


def data_stage(spark: SparkSession, config: Mapping[str, Any], schema: T.StructType | None = None) -> DataFrame:
    """Load the source table, refuse an empty one, and apply the column rules.

    With rules the source is read once: they are counted while the table is written
    to the shared folder, from where later steps read it.
    """
    if schema is None and config["data_source"].get("type", "csv") == "csv":
        rules = config.get("data_validation", {}).get("schema", {}).get("columns", [])
        schema = schema_from_rules(rules) if config.get("schema_from_rules") and rules else None
    df = load_source(spark, config["data_source"], schema, warn_if_empty=False)
    rules = configured_rules(config)
    if not rules or not df.columns:
        return require_rows(df)
    watch = Watch(df, rules)
    loaded = materialize(watch.df, "loaded")
    if not watch.n_rows:
        raise SourceError("the loaded table is empty")
    act_on(watch.report(), config)
    return loaded


def fit_on_train(
    df: DataFrame, config: Mapping[str, Any], split_col: str = "split"
) -> tuple[Preprocessor, dict[str, Any]]:
    """Learn from the training split only, so nothing of the others leaks in."""
    plan = build_preprocessor(config)
    return plan, plan.fit(df.where(F.col(split_col) == "train"))


def predictions_of(model: KnnModel, processed: DataFrame, target: str, positive: int = 1) -> DataFrame:
    """``<id>, split, y_true, y_pred, y_proba`` for every row, written once."""
    at = sorted(model.classes).index(positive) if positive in model.classes else None
    found = model.append(processed.select(model.id_col, "split", F.col(target).alias("y_true"), model.vector_col), proba=True)
    share = F.col(f"class_{at}") if at is not None else F.lit(None).cast("double")
    scored = found.select(model.id_col, "split", "y_true", F.col("prediction").alias("y_pred"), share.alias("y_proba"))
    return materialize(scored, "predictions")


def train_stage(
    df: DataFrame, config: Mapping[str, Any], id_col: str, metrics: Sequence[str] | None = None
) -> Trained:
    """Split, fit on train, transform all, train, evaluate every split.

    The rename comes first, so the configured names are those after it; the
    scorer asks for the names before it. Metrics are those asked for, else
    those of ``metrics.report``.
    """
    target = config.get("target", "target")
    metrics = metrics or config.get("metrics", {}).get("report")
    settings = config.get("model", {})
    model_settings = checked_params(settings.get("params"))  # a wrong name fails before any work
    renames = config.get("preprocessing", {}).get("rename_columns", {})
    df = rename_columns(df, renames)
    require_columns(df, [id_col, target])
    sizes = config.get("data_split", {})
    split = stratified_split(
        df,
        id_col,
        target,
        test=sizes.get("test_size", 0.2),
        valid=sizes.get("valid_size", 0.2),
        seed=sizes.get("random_state", 42),
    )
    split = materialize(split, "split")  # fitting and transforming read it several times
    plan, params = fit_on_train(split, config)
    processed = plan.transform(split, params, keep=[id_col, target, "split"])
    processed = columns_to_array(processed, plan.output_names(params), VECTOR)
    train = processed.where(F.col("split") == "train")
    model = train_model(train, id_col, VECTOR, target, settings.get("type", "knn"), model_settings)
    predictions = predictions_of(model, processed, target)
    before = {new: old for old, new in renames.items()}
    features = [before.get(c, c) for c in config.get("raw_features", [])]
    scorer = Scorer(model, features, plan, params, renames)
    return Trained(scorer, processed, predictions, classification_report(predictions, ["split"], metrics))


def infer_stage(df: DataFrame, scorer: Scorer, config: Mapping[str, Any], proba: bool = True) -> DataFrame:
    """Validate the input, then score it."""
    df = rename_columns(df, config.get("preprocessing", {}).get("rename_columns", {}))
    run_validation(df, config)
    return score(df, scorer, proba)
