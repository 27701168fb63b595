"""Tabular classification work on Spark, from the scan to the scored table."""

from sparktab.operators.evaluate import classification_report, pr_curve, roc_auc, roc_curve
from sparktab.operators.features import register_step
from sparktab.operators.knn import knn_grid, knn_predict, load_model, save_model, train_model
from sparktab.operators.preprocess import build_preprocessor, fit_transform
from sparktab.operators.profile import duplicate_count, fingerprint, head_sample, profile, schema_rows
from sparktab.operators.score import Scorer, score, score_files, score_json
from sparktab.operators.split import kfold, stratified_split
from sparktab.operators.validate import enforce, quarantine, run_validation, validate
from sparktab.plans.approx import knn_join_approx
from sparktab.plans.neighbors import knn_join
from sparktab.plans.stages import data_stage, infer_stage, train_stage
from sparktab.sources.readers import load_source, read_table
from sparktab.streaming.quality import quality_stream
from sparktab.streaming.score import score_stream

__all__ = [
    "Scorer",
    "build_preprocessor",
    "classification_report",
    "data_stage",
    "duplicate_count",
    "enforce",
    "fingerprint",
    "fit_transform",
    "head_sample",
    "infer_stage",
    "kfold",
    "knn_grid",
    "knn_join",
    "knn_join_approx",
    "knn_predict",
    "load_model",
    "load_source",
    "pr_curve",
    "profile",
    "quality_stream",
    "quarantine",
    "read_table",
    "register_step",
    "roc_auc",
    "roc_curve",
    "run_validation",
    "save_model",
    "schema_rows",
    "score",
    "score_files",
    "score_json",
    "score_stream",
    "stratified_split",
    "train_model",
    "train_stage",
    "validate",
]
