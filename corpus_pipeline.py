"""The corpus pipeline: documents to a clean, mixed training set, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import table
from sparktab.llm.decontaminate import decontaminate
from sparktab.llm.mixing import mix
from sparktab.llm.quality import fit_rules, quality
from sparktab.llm.secrets import mask_secrets
from sparktab.llm.shingles import shingle_dedup
from sparktab.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base test nor the learned list rejects."""
    judged, names = quality(docs, fit_rules(docs, table(spark, sf_dir, "labels")))
    return judged.where(F.col(names["kept"])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles of similarity 0.8 or more, verified."""
    return shingle_dedup(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark passage."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars counted again."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mixture, with topic (unless they have one), tokens, weight and probability."""
    mixed, names = mix(docs)
    made = [names[k] for k in ("topic", "n_tokens", "weight", "probability")]
    return mixed.where(F.col(names["kept"])).select(*docs.columns, *[c for c in made if c not in docs.columns])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("mixture", mixture),
]

#: The learned list, fingerprints by XXH64 and the guess-cost programme are not SQL; tests hold run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
