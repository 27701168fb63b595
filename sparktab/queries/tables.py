"""Scans, sinks and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators.profile import duplicate_count as count_duplicates
from sparktab.operators.profile import fingerprint, profile, schema_rows
from sparktab.operators.profile import head_sample as first_rows
from sparktab.operators.split import split_sizes, stratified_split
from sparktab.queries.registry import query, table
from sparktab.queries.sql import split_ctes
from sparktab.session import scratch_path
from sparktab.sources.readers import load_source, read_rejects, read_table
from sparktab.sources.writers import write_splits as write_split_table

FORMATS = ("csv", "json", "orc", "parquet")


def _stored(df: DataFrame, fmt: str, name: str) -> str:
    path = f"{scratch_path(df.sparkSession, name)}.{fmt}"
    df.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
    return path


#: Orders as lines of a file; by key some have a text for a number, a field too few, or a field too many.
LINES = """CASE o_orderkey % 10 WHEN 0 THEN concat_ws(',', o_orderkey, 'none', o_orderpriority) WHEN 1 THEN concat_ws(',', o_orderkey, o_custkey)
      WHEN 2 THEN concat_ws(',', o_orderkey, o_custkey, o_orderpriority, 'more') ELSE concat_ws(',', o_orderkey, o_custkey, o_orderpriority) END"""


@query(
    f"""SELECT CASE WHEN o_orderkey % 10 > 2 THEN o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 10 > 2 THEN o_custkey END AS o_custkey,
      CASE WHEN o_orderkey % 10 > 2 THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 10 < 3 THEN {LINES} END AS record FROM orders"""
)
def scan_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_path(spark, 'lines')}.csv"
    table(spark, folder, "orders").selectExpr(f"{LINES} AS value").write.text(path)
    good, bad = read_rejects(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string", "record", header=False)
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    """SELECT o_orderpriority, count(*)::BIGINT AS n_rows, round(sum(o_totalprice), 2) AS total,
      min(o_orderdate) AS first_date FROM orders GROUP BY ALL"""
)
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    path = _stored(orders, "csv", "orders")
    df = read_table(spark, path, "csv", schema=orders.schema, encoding="UTF-8")
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_date"),
    )


FORMAT_ORACLE = """SELECT fmt, c_mktsegment, count(*)::BIGINT AS n_rows, round(sum(c_acctbal), 2) AS balance
  FROM customer, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) AS f(fmt) GROUP BY ALL"""


def _by_segment(df: DataFrame, fmt: str) -> DataFrame:
    return df.groupBy(F.lit(fmt).alias("fmt"), "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(FORMAT_ORACLE)
def scan_by_type(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    parts = []
    for fmt in FORMATS:
        source = {"raw_path": _stored(customer, fmt, "customer"), "type": fmt, "encoding": "utf-8"}
        parts.append(_by_segment(load_source(spark, source, customer.schema), fmt))
    return reduce(DataFrame.unionByName, parts)


@query(FORMAT_ORACLE)
def scan_by_suffix(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    paths = {fmt: _stored(customer, fmt, "customer") for fmt in FORMATS}
    parts = [_by_segment(read_table(spark, p, schema=customer.schema), fmt) for fmt, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    f"""WITH {split_ctes("orders", "o_orderkey", "o_orderstatus")}
    SELECT split, o_orderstatus, count(*)::BIGINT AS n_rows FROM split_rows GROUP BY ALL"""
)
def write_splits(spark: SparkSession, folder: str) -> DataFrame:
    split = stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "splits")
    write_split_table(split, path)
    return split_sizes(read_table(spark, path, "parquet"), "o_orderstatus")


def _profile_sql(name: str, n_columns: int, columns: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*)::BIGINT AS n_rows, {n_columns}::BIGINT AS n_columns,
      '{columns}' AS columns FROM {name}"""


@query(
    _profile_sql("customer", 5, "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment")
    + " UNION ALL "
    + _profile_sql(
        "orders", 6, "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"
    )
    + " UNION ALL "
    + _profile_sql("labels", 3, "doc_id,quality,toxic")
)
def load_profile(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "orders", "labels")
    return reduce(DataFrame.unionByName, [profile(table(spark, folder, n), n) for n in names])


def _duplicates_sql(name: str) -> str:
    return f"""SELECT '{name}' AS table_name, (SELECT count(*)::BIGINT FROM {name}) AS n_rows,
      (SELECT count(*) FROM {name})::BIGINT - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name}))::BIGINT AS n_duplicates"""


@query(_duplicates_sql("documents") + " UNION ALL " + _duplicates_sql("lineitem") + " UNION ALL " + _duplicates_sql("labels"))
def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rows, long text included."""
    parts = [count_duplicates(table(spark, folder, n)).select(F.lit(n).alias("table_name"), "*") for n in ("documents", "lineitem", "labels")]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def head_sample(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(table(spark, folder, "orders"), ["o_orderkey"], 100)


@query(
    """SELECT (row_number() OVER () - 1)::INTEGER AS ordinal, column_name AS "column",
      CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
        WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type
    FROM (DESCRIBE SELECT * FROM lineitem)"""
)
def schema_capture(spark: SparkSession, folder: str) -> DataFrame:
    return schema_rows(table(spark, folder, "lineitem"))


def _exact_sql(c: str) -> str:
    """A double as whole part and twice 52 binary places of the fraction, which is exact for these columns."""
    step = "4503599627370496::DOUBLE"
    upper = f"((abs({c}) - floor(abs({c}))) * {step})"
    lower = f"(({upper} - floor({upper})) * {step})"
    parts = " || '.' || ".join(f"floor({p})::BIGINT" for p in (f"abs({c})", upper, lower))
    return f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END) || {parts}"


WHOLE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
REAL = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TEXT = ("l_returnflag", "l_linestatus")
FORMS = [f"{c}::VARCHAR" for c in WHOLE] + [_exact_sql(c) for c in REAL] + [f"length({c}) || ':' || {c}" for c in TEXT] + ["epoch_us(l_shipdate)::VARCHAR"]
ROW_FORM = " || ".join(f"coalesce(({f}) || '|', '-|')" for f in FORMS)


@query(
    f"""WITH hashed AS (SELECT md5({ROW_FORM}) AS h FROM lineitem),
    words AS (SELECT ('0x' || h[1:10])::BIGINT AS a, ('0x' || h[11:20])::BIGINT AS b FROM hashed),
    total AS (SELECT count(*)::BIGINT AS n_rows, sum(a >> 20) AS s0, sum(a & 1048575) AS s1, sum(b >> 20) AS s2,
      sum(b & 1048575) AS s3 FROM words)
    SELECT n_rows, md5(concat_ws('|', n_rows, s0, s1, s2, s3)) AS fingerprint FROM total"""
)
def input_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """All columns; the first is the order of the table's schema."""
    return fingerprint(table(spark, folder, "lineitem"))
