"""Column rules on whole tables. The tables hold no missing values, so some are put in by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators import validate as v
from sparktab.queries.registry import query, table
from sparktab.session import scratch_path
from sparktab.sources.readers import read_table
from sparktab.sources.writers import write_json

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]

RULES = [
    {"name": "c_custkey", "dtype": "int", "required": True, "min": 1},
    {"name": "c_acctbal", "dtype": "float", "required": True, "min": 0, "max": 9000},
    {"name": "c_nationkey", "dtype": "int", "required": False, "min": 1, "max": 20},
    {"name": "c_mktsegment", "dtype": "str", "allowed_values": SEGMENTS},
    {"name": "c_name", "dtype": "int"},
    {"name": "c_phone", "dtype": "str", "required": True},
    {"name": "c_comment", "dtype": "str", "required": False},
]

CUSTOMER = """customer_gaps AS (
  SELECT c_custkey, c_name,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
    CASE WHEN c_custkey % 10 = 1 THEN NULL WHEN c_custkey % 10 = 2 THEN 'nan'::DOUBLE ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""

SEGMENT_LIST = ", ".join(f"'{s}'" for s in SEGMENTS)

COUNTS = f"""counts AS (
  SELECT
    count(*) FILTER (c_custkey IS NULL)::BIGINT AS key_missing,
    count(*) FILTER (c_custkey < 1)::BIGINT AS key_below,
    count(*) FILTER (c_acctbal IS NULL OR isnan(c_acctbal))::BIGINT AS bal_missing,
    count(*) FILTER (NOT isnan(c_acctbal) AND c_acctbal < 0)::BIGINT AS bal_below,
    count(*) FILTER (NOT isnan(c_acctbal) AND c_acctbal > 9000)::BIGINT AS bal_above,
    count(*) FILTER (c_nationkey IS NULL)::BIGINT AS nat_missing,
    count(*) FILTER (c_nationkey < 1)::BIGINT AS nat_below,
    count(*) FILTER (c_nationkey > 20)::BIGINT AS nat_above,
    count(*) FILTER (c_mktsegment IS NULL)::BIGINT AS seg_missing,
    count(*) FILTER (coalesce(c_mktsegment NOT IN ({SEGMENT_LIST}), TRUE))::BIGINT AS seg_invalid
  FROM customer_gaps)"""

FINDINGS = f"""WITH {CUSTOMER}, {COUNTS},
  findings AS (
    SELECT 'c_custkey' AS "column", 'presence' AS "check", 'ok' AS severity, 0::BIGINT AS n FROM counts
    UNION ALL SELECT 'c_custkey', 'dtype', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_custkey', 'missing', if(key_missing > 0, 'error', 'ok'), key_missing FROM counts
    UNION ALL SELECT 'c_custkey', 'below_min', if(key_below > 0, 'error', 'ok'), key_below FROM counts
    UNION ALL SELECT 'c_acctbal', 'presence', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_acctbal', 'dtype', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_acctbal', 'missing', if(bal_missing > 0, 'error', 'ok'), bal_missing FROM counts
    UNION ALL SELECT 'c_acctbal', 'below_min', if(bal_below > 0, 'error', 'ok'), bal_below FROM counts
    UNION ALL SELECT 'c_acctbal', 'above_max', if(bal_above > 0, 'error', 'ok'), bal_above FROM counts
    UNION ALL SELECT 'c_nationkey', 'presence', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_nationkey', 'dtype', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_nationkey', 'missing', if(nat_missing > 0, 'warning', 'ok'), nat_missing FROM counts
    UNION ALL SELECT 'c_nationkey', 'below_min', if(nat_below > 0, 'error', 'ok'), nat_below FROM counts
    UNION ALL SELECT 'c_nationkey', 'above_max', if(nat_above > 0, 'error', 'ok'), nat_above FROM counts
    UNION ALL SELECT 'c_mktsegment', 'presence', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_mktsegment', 'dtype', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_mktsegment', 'missing', if(seg_missing > 0, 'error', 'ok'), seg_missing FROM counts
    UNION ALL SELECT 'c_mktsegment', 'invalid', if(seg_invalid > 0, 'error', 'ok'), seg_invalid FROM counts
    UNION ALL SELECT 'c_name', 'presence', 'ok', 0 FROM counts
    UNION ALL SELECT 'c_name', 'dtype', 'error', 1 FROM counts
    UNION ALL SELECT 'c_phone', 'presence', 'error', 1 FROM counts
    UNION ALL SELECT 'c_comment', 'presence', 'info', 1 FROM counts)"""


def customer_gaps(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    digit = F.col("c_custkey") % 10
    balance = F.when(digit == 1, None).when(digit == 2, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return customer.select(
        "c_custkey",
        "c_name",
        F.when(digit != 0, F.col("c_nationkey")).alias("c_nationkey"),
        balance.alias("c_acctbal"),
        F.when(digit != 3, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


COLUMNS = ("column", "check", "severity", "n")


def _findings(spark: SparkSession, folder: str, *checks: str) -> DataFrame:
    report = v.validate(customer_gaps(spark, folder), RULES).select(*COLUMNS)
    return report.where(F.col("check").isin(*checks)) if checks else report


@query(FINDINGS + "SELECT * FROM findings WHERE \"check\" = 'presence'")
def validate_presence(spark: SparkSession, folder: str) -> DataFrame:
    return v.structure_report(customer_gaps(spark, folder), RULES).where(F.col("check") == "presence").select(*COLUMNS)


@query(FINDINGS + "SELECT * FROM findings WHERE \"check\" = 'dtype'")
def validate_dtype(spark: SparkSession, folder: str) -> DataFrame:
    return v.structure_report(customer_gaps(spark, folder), RULES).where(F.col("check") == "dtype").select(*COLUMNS)


@query(FINDINGS + "SELECT * FROM findings WHERE \"check\" = 'missing'")
def validate_missing(spark: SparkSession, folder: str) -> DataFrame:
    return _findings(spark, folder, "missing")


@query(FINDINGS + "SELECT * FROM findings WHERE \"check\" IN ('below_min', 'above_max')")
def validate_range(spark: SparkSession, folder: str) -> DataFrame:
    return _findings(spark, folder, "below_min", "above_max")


LABEL_RULES = [
    {"name": "quality", "dtype": "int", "allowed_values": [0, 1]},
    {"name": "toxic", "dtype": "int", "allowed_values": [0]},
]
EVENT_RULES = [{"name": "event_type", "dtype": "str", "allowed_values": ["click", "view"]}]


@query(FINDINGS + "SELECT * FROM findings")
def validate_watched(spark: SparkSession, folder: str) -> DataFrame:
    """The whole report from the counts taken while the table was written."""
    watch = v.Watch(customer_gaps(spark, folder), RULES)
    watch.df.write.parquet(scratch_path(spark, "watched"))
    return watch.report().select(*COLUMNS)


@query(
    f"""{FINDINGS}
    SELECT "column", n FROM findings WHERE "check" = 'invalid'
    UNION ALL SELECT 'quality', count(*) FILTER (quality NOT IN (0, 1)) FROM labels
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic <> 0) FROM labels
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type NOT IN ('click', 'view')) FROM events"""
)
def validate_allowed(spark: SparkSession, folder: str) -> DataFrame:
    reports = [
        v.validate(customer_gaps(spark, folder), RULES),
        v.validate(table(spark, folder, "labels"), LABEL_RULES),
        v.validate(table(spark, folder, "events"), EVENT_RULES),
    ]
    whole = reports[0].unionByName(reports[1]).unionByName(reports[2])
    return whole.where(F.col("check") == "invalid").select("column", "n")


@query(
    f"""WITH {CUSTOMER},
    seen AS (
      SELECT DISTINCT 'c_custkey' AS "column", c_custkey::VARCHAR AS value FROM customer_gaps
      UNION SELECT 'c_nationkey', c_nationkey::VARCHAR FROM customer_gaps
      UNION SELECT 'c_mktsegment', c_mktsegment FROM customer_gaps)
    SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value)::INTEGER AS place
    FROM seen WHERE value IS NOT NULL QUALIFY place <= 5"""
)
def validate_samples(spark: SparkSession, folder: str) -> DataFrame:
    rules = [r for r in RULES if r["name"] in ("c_custkey", "c_nationkey", "c_mktsegment")]
    return v.sample_values(customer_gaps(spark, folder), rules)


@query(
    f"""{FINDINGS}
    SELECT "column", "check", severity, n,
      if(count(*) FILTER (severity = 'error') OVER () > 0, 'fail', 'pass') AS status FROM findings"""
)
def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    report = v.validate(customer_gaps(spark, folder), RULES)
    # The status has one row, so every report row meets it once.
    status = v.report_status(report).first().status
    return report.select("column", "check", "severity", "n", F.lit(status).alias("status"))


@query(
    f"""{FINDINGS}
    SELECT "column",
      max(severity) FILTER ("check" = 'above_max') AS above_max,
      max(severity) FILTER ("check" = 'below_min') AS below_min,
      max(severity) FILTER ("check" = 'dtype') AS dtype,
      max(severity) FILTER ("check" = 'invalid') AS invalid,
      max(severity) FILTER ("check" = 'missing') AS missing,
      max(severity) FILTER ("check" = 'presence') AS presence
    FROM findings GROUP BY ALL"""
)
def validation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return v.report_matrix(v.validate(customer_gaps(spark, folder), RULES))


@query(
    f"""{FINDINGS}
    SELECT if(count(*) FILTER (severity = 'error') > 0, 'fail', 'pass') AS status,
      count(*) FILTER (severity = 'error')::BIGINT AS n_errors,
      count(*) FILTER (severity = 'warning')::BIGINT AS n_warnings,
      count(*)::BIGINT AS n_details, sum(n)::BIGINT AS n_rows FROM findings"""
)
def report_json(spark: SparkSession, folder: str) -> DataFrame:
    report = v.report_document(v.validate(customer_gaps(spark, folder), RULES))
    path = scratch_path(spark, "report")
    write_json(report, path)
    stored = read_table(spark, path, "json", schema=report.schema)
    return stored.select(
        "status",
        F.size("errors").cast("bigint").alias("n_errors"),
        F.size("warnings").cast("bigint").alias("n_warnings"),
        F.size("details").cast("bigint").alias("n_details"),
        F.aggregate("details.n", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_rows"),
    )


@query(
    f"""WITH {CUSTOMER}
    SELECT c_custkey, concat_ws(',',
      CASE WHEN c_custkey < 1 THEN 'c_custkey:below_min' END,
      CASE WHEN c_acctbal IS NULL OR isnan(c_acctbal) THEN 'c_acctbal:missing' END,
      CASE WHEN NOT isnan(c_acctbal) AND c_acctbal < 0 THEN 'c_acctbal:below_min' END,
      CASE WHEN NOT isnan(c_acctbal) AND c_acctbal > 9000 THEN 'c_acctbal:above_max' END,
      CASE WHEN c_nationkey < 1 THEN 'c_nationkey:below_min' END,
      CASE WHEN c_nationkey > 20 THEN 'c_nationkey:above_max' END,
      CASE WHEN c_mktsegment IS NULL THEN 'c_mktsegment:missing' END,
      CASE WHEN coalesce(c_mktsegment NOT IN ({SEGMENT_LIST}), TRUE) THEN 'c_mktsegment:invalid' END
    ) AS violations FROM customer_gaps"""
)
def quarantine_rows(spark: SparkSession, folder: str) -> DataFrame:
    valid, rejected = v.quarantine(customer_gaps(spark, folder), RULES)
    text = F.array_join("violations", ",").alias("violations")
    return valid.select("c_custkey", F.lit("").alias("violations")).unionByName(
        rejected.select("c_custkey", text)
    )
