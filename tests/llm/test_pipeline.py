"""The pipeline against plain code, stage by stage."""

import hashlib

import pytest

import corpus_pipeline
from sparktab.llm import decontaminate, mixing, quality, secrets
from sparktab.llm.queries import QUERIES
from tests.llm.test_mixing import fitted
from tests.llm.test_quality import plain as plain_counts
from tests.llm.test_shingles import plain_kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    out = corpus_pipeline.quality_rules(spark, docs, small)
    assert out.columns == COLUMNS
    kept = {r.doc_id for r in out.collect()}
    verdicts = {r.doc_id: r.kept for r in QUERIES["op2_quality_rules"](spark, small).collect()}
    assert kept == {d for d, k in verdicts.items() if k}
    assert all(plain_counts(rows[d].text)[0] >= 20 for d in kept)

    docs = spark.createDataFrame([rows[d] for d in sorted(kept)], docs.schema)
    out = corpus_pipeline.near_duplicates(spark, docs, small)
    assert out.columns == COLUMNS
    texts = [(d, rows[d].text) for d in kept]
    kept = {r.doc_id for r in out.collect()}
    assert kept == plain_kept(texts)

    docs = spark.createDataFrame([rows[d] for d in sorted(kept)], docs.schema)
    out = corpus_pipeline.benchmark_leaks(spark, docs, small)
    assert out.columns == COLUMNS
    items = [" " + " ".join(decontaminate.words_of(r.text.encode())) + " " for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in out.collect()}
    clean = {r.doc_id for r in docs.collect() if not any(i in " " + " ".join(decontaminate.words_of(r.text.encode())) + " " for i in items)}
    assert kept == clean

    docs = spark.createDataFrame([rows[d] for d in sorted(kept)], docs.schema)
    out = corpus_pipeline.secrets(spark, docs, small)
    assert out.columns == COLUMNS
    words = secrets.load_words()
    masked = {r.doc_id: r for r in out.collect()}
    assert masked.keys() == kept
    for d, r in masked.items():
        found, _ = secrets.find_secrets(rows[d].text.encode(), words)
        assert (r.text == rows[d].text) == (not found) and r.n_chars == len(r.text)
        assert not secrets.find_secrets(r.text.encode(), words)[0]

    docs = spark.createDataFrame([masked[d] for d in sorted(kept)], docs.schema)
    out = corpus_pipeline.mixture(spark, docs, small).collect()
    for r in out:
        assert int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) / 2**52 < r.probability
    assert out and {r.doc_id for r in out} <= kept


def test_run_is_all_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        docs = spark.createDataFrame(out.collect(), out.schema)
    want = sorted(map(tuple, docs.collect()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert [x for r in got for x in r[7:]] == pytest.approx([x for r in want for x in r[7:]])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_leaks", "secrets", "mixture"]


def test_odd_rows_pass_every_stage(spark, odd, none, small):
    for given in (odd.withColumn("n_chars", odd.n_words.cast("long")), none.withColumn("n_chars", none.n_words.cast("long"))):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small)
            if name != "mixture":
                assert out.columns == given.columns
            out.count()
            docs = out if name != "quality_rules" else given


def test_mixture_of_documents_with_topics(spark, odd, small):
    given = odd.withColumn("topic", odd.lang)
    out = corpus_pipeline.mixture(spark, given, small)
    assert out.columns[: len(given.columns)] == given.columns and len(set(out.columns)) == len(out.columns)
    assert 0 < out.count() <= 8


def test_fit_of_the_helper():
    import numpy as np

    assert np.allclose(fitted(np.ones((2, 2)), [[0.3, 0.7], [0.5, 0.5]], 3).sum(1), [0.3, 0.7])
    assert mixing.ROUNDS >= 4 and quality.LABELLED > 0
