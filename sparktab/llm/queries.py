"""Queries of the text operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import pick, table
from sparktab.llm.decontaminate import overlaps
from sparktab.llm.exact import exact_dedup
from sparktab.llm.html import extract_text
from sparktab.llm.lexical import ranked_search, treap_index
from sparktab.llm.licenses import license_scan
from sparktab.llm.lm import lm_scores
from sparktab.llm.mixing import LEAST_SHARE, REST, ROUNDS, TEMPER, mix
from sparktab.llm.negatives import hard_negatives
from sparktab.llm.pii import pii_spans
from sparktab.llm.quality import fit_rules, quality
from sparktab.llm.secrets import secret_spans
from sparktab.llm.simhash import simhash_groups
from sparktab.llm.urls import LOWER, UPPER, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# The block list of op4. It names the pages of these hosts by language and number, whether they are in the
# table or not; pages beyond it (other languages, higher numbers, other hosts) are not listed.
LISTED_HOSTS = ("adult-x", "casino-win", "cheap-pills", "free-bets", "quick-loans", "spam-farm")
LISTED_ENDS, LISTED_LANGUAGES, LISTED_PAGES = ("com", "net", "org"), ("de", "en", "es"), 10_000


def listed_pages(spark: SparkSession) -> DataFrame:
    """The block list in canonical form: 540,000 URLs, whatever the table holds."""
    out = spark.range(LISTED_PAGES).select(F.col("id").alias("n"))
    for name, values in {"host": LISTED_HOSTS, "end": LISTED_ENDS, "lang": LISTED_LANGUAGES}.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out.select(F.concat("host", F.lit(".example."), "end", F.lit("/"), "lang", F.lit("/"), F.col("n").cast("string")).alias("canonical"))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged, _ = quality(pick(docs, doc_id="doc_id", text="text"), fit_rules(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "log10_guesses")


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    found = overlaps(docs, table(spark, sf_dir, "benchmark")).where("overlaps <> ''")
    items = F.transform(F.split("overlaps", ";"), lambda x: F.split(x, ":")[0].try_cast("long"))
    return found.select("doc_id", items.alias("item_ids"), F.size(items).cast("long").alias("n_items"), "overlaps")


@query
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")).drop("text")


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a rule are blocked if their canonical URL is on the list."""
    pages = pick(table(spark, sf_dir, "pages"), page_id="page_id", url="url")
    return url_filter(pages, listed_pages(spark))[0].select("page_id", "host", "path", "rule", "verdict")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")).drop("text")


@query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding", label="label")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND (a.label <> r.label OR a.vec_id <> r.vec_id)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "benchmark"), treap_index(table(spark, sf_dir, "documents")))


TERMS = f"unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"

ORACLES["op12_ranked_search"] = f"""
WITH tokens AS (SELECT doc_id, {TERMS} FROM documents),
postings AS MATERIALIZED (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
lengths AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM sizes, totals),
asked AS (SELECT DISTINCT item_id, {TERMS} FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op13_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op4_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw_host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (SELECT page_id, translate(raw_host, '{UPPER}', '{LOWER}') AS host, path FROM parts),
formed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':[0-9]*$', '')
                 || regexp_replace(regexp_replace(path, '/index\\.html?$', '/'), '/+$', '') END AS canonical
  FROM named),
listed AS (
  SELECT h || '.example.' || e || '/' || l || '/' || n AS canonical
  FROM unnest({list(LISTED_HOSTS)}) a(h), unnest({list(LISTED_ENDS)}) b(e), unnest({list(LISTED_LANGUAGES)}) c(l), range({LISTED_PAGES}) d(n)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM formed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def mixing_sql(rounds: int = ROUNDS) -> str:
    """The raking of op6 as one chain of common tables, three for each round."""
    size = "strlen(text)"

    def count(characters: str) -> str:
        return f"({size} - strlen(translate(text, {characters}, '')))"

    steps, margins = [], ("source", "lang", "topic")
    for i in range(rounds * len(margins)):
        c = margins[i % len(margins)]
        steps.append(
            f"w{i + 1} AS MATERIALIZED (SELECT x.p_source, x.p_lang, x.p_topic, x.n, x.w * (share / sum(x.w) OVER (PARTITION BY x.p_{c})) AS w "
            f"FROM w{i} x JOIN goal_{c} USING (p_{c}))"
        )
    pools = ",\n".join(
        f"pool_{c} AS (SELECT k_{c}, CASE WHEN sum(n) < {LEAST_SHARE} * (SELECT sum(n) FROM raw) THEN '{REST}' ELSE k_{c} END AS p_{c} FROM raw GROUP BY k_{c})" for c in margins
    )
    goals = ",\n".join(
        f"goal_{c} AS MATERIALIZED (SELECT p_{c}, pow(sum(n), {TEMPER}) / sum(pow(sum(n), {TEMPER})) OVER () AS share FROM cells GROUP BY p_{c})" for c in margins
    )
    return f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, source, lang, coalesce({count("' ' || chr(10) || chr(9)")} + 1, 1)::BIGINT AS n_tokens,
         CASE WHEN text IS NULL OR {size} = 0 THEN 'none' WHEN {count("'|'")} * 100 >= {size} THEN 'table'
              WHEN {count("'#*$%&<>'")} * 50 >= {size} THEN 'markup' WHEN {count("'0123456789'")} * 50 >= {size} THEN 'figures'
              ELSE 'prose' END AS topic
  FROM documents),
keyed AS (SELECT *, coalesce(source, '(null)') AS k_source, coalesce(lang, '(null)') AS k_lang, topic AS k_topic FROM docs),
raw AS MATERIALIZED (SELECT k_source, k_lang, k_topic, sum(n_tokens)::DOUBLE AS n FROM keyed GROUP BY ALL),
{pools},
cells AS MATERIALIZED (
  SELECT p_source, p_lang, p_topic, sum(n) AS n FROM raw JOIN pool_source USING (k_source) JOIN pool_lang USING (k_lang) JOIN pool_topic USING (k_topic) GROUP BY ALL),
{goals},
w0 AS MATERIALIZED (SELECT *, n / (SELECT sum(n) FROM cells) AS w FROM cells),
{",".join(steps)},
fitted AS MATERIALIZED (SELECT *, w / n * (SELECT sum(n) FROM cells) AS weight FROM w{len(steps)})
SELECT doc_id, source, lang, topic, n_tokens, weight, weight / (SELECT max(weight) FROM fitted) AS probability,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) < weight / (SELECT max(weight) FROM fitted) AS kept
FROM keyed JOIN pool_source USING (k_source) JOIN pool_lang USING (k_lang) JOIN pool_topic USING (k_topic) JOIN fitted USING (p_source, p_lang, p_topic)
"""


ORACLES["op6_mix"] = mixing_sql()
