"""Projections, feature steps, and fitted imputers, scalers, bins and encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.values import as_number, as_timestamp
from sparktab.operators import features as f
from sparktab.operators.moments import Scale, apply_state, fit_state, merge_states
from sparktab.operators.preprocess import Branch, Preprocessor, build_preprocessor, rename_columns as rename
from sparktab.operators.preprocess import select_features as select
from sparktab.operators.split import stratified_split
from sparktab.operators.sparse import fit_sparse, sparse_distance, to_sparse
from sparktab.plans.sketches import merge_sketches, quantile_sketches, rank_error, sketch_quantiles
from sparktab.queries.registry import query, table
from sparktab.session import materialize
from sparktab.queries.sql import split_ctes


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


@query("SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, c_name, c_nationkey FROM customer")
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    names = {"c_custkey": "id", "c_acctbal": "balance", "c_mktsegment": "segment", "not_there": "ignored"}
    return rename(table(spark, folder, "customer"), names)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    """The features in the asked order, the target apart as the last column."""
    orders = table(spark, folder, "orders")
    return select(orders, "o_orderkey", ["o_totalprice", "o_orderpriority"], "o_orderstatus")


FLAGS = """flags AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE (o_orderstatus = 'F')::INTEGER END AS flag_done,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'n/a'
      ELSE substr(o_orderpriority, 1, 1) END AS flag_text,
    CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 10 = 2 THEN 'nan'::DOUBLE
      ELSE (o_totalprice > 100000)::INTEGER::DOUBLE END AS flag_big
  FROM orders)"""


@query(
    f"""WITH {FLAGS}, summed AS (
      SELECT *, coalesce(flag_done, 0) + coalesce(TRY_CAST(flag_text AS DOUBLE), 0)
        + CASE WHEN flag_big IS NULL OR isnan(flag_big) THEN 0 ELSE flag_big END AS risk_score FROM flags)
    SELECT o_orderkey, 0 AS flag_absent, risk_score,
      CASE WHEN flag_done IS NULL AND flag_text IS NULL AND (flag_big IS NULL OR isnan(flag_big)) THEN NULL
        ELSE risk_score END AS score_of_three FROM summed"""
)
def feat_flag_sum(spark: SparkSession, folder: str) -> DataFrame:
    """With an absent flag, which counts 0 and is never missing; and of the three alone."""
    digit, twenty = F.col("o_orderkey") % 10, F.col("o_orderkey") % 20
    big = F.when(twenty == 0, None).when(digit == 2, F.lit(float("nan")))
    text = F.when(digit == 0, None).when(digit == 1, "n/a").otherwise(F.substring("o_orderpriority", 1, 1))
    flags = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(digit != 0, (F.col("o_orderstatus") == "F").cast("int")).alias("flag_done"),
        text.alias("flag_text"),
        big.otherwise((F.col("o_totalprice") > 100000).cast("double")).alias("flag_big"),
    )
    names = ["flag_done", "flag_text", "flag_big"]
    three = f.FlagSum(names).transform(flags).withColumnRenamed("risk_score", "score_of_three")
    out = f.FlagSum([*names, "flag_absent"]).transform(three)
    return out.select("o_orderkey", "flag_absent", "risk_score", "score_of_three")


@query(
    """SELECT p_partkey, round(p_retailprice / nullif((p_size / 100.0::DOUBLE) * (p_size / 100.0::DOUBLE), 0), 4) AS bmi
    FROM part"""
)
def feat_ratio_square(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    return rounded(f.BodyMassIndex("p_retailprice", "p_size").transform(part), ["bmi"], 4)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
      round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax,
      (l_linenumber + 2000000000) * (l_linenumber + 2000000000)::BIGINT AS big_x_large,
      round(l_discount * l_tax, 6) AS l_discount_x_l_tax FROM lineitem"""
)
def feat_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Two of the columns are 32-bit integers whose product needs 64."""
    columns = ["l_quantity", "l_discount", "l_tax"]
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    big = (F.col("l_linenumber") + 2_000_000_000).cast("int")
    rows = table(spark, folder, "lineitem").select(*keys, *columns, big.alias("big"), big.alias("large"))
    out = f.Products(["big", "large"]).transform(f.Products(columns).transform(rows)).drop(*columns, "big", "large")
    return rounded(out, [c for c in out.columns if c not in keys and c != "big_x_large"])


@query(
    """WITH gaps AS (
      SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'nan'::DOUBLE
        ELSE value END AS value FROM events),
    stats AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM gaps WHERE NOT isnan(value))
    SELECT event_id, CASE WHEN NOT isnan(value) AND abs((value - m) / s) > 2 THEN 1 ELSE 0 END AS value_outlier
    FROM gaps, stats"""
)
def feat_outlier_flags(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.col("event_id") % 10
    value = F.when(digit == 0, None).when(digit == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    events = table(spark, folder, "events").select("event_id", value.alias("value"))
    step = f.OutlierFlags(["value"], threshold=2.0)
    return step.transform(events, step.fit(events)).drop("value")


EVENT_TEXT = """moments AS (
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'not a date'
    WHEN event_id % 10 = 2 THEN strftime(ts, '%m/%d/%Y %H:%M') WHEN event_id % 10 = 3 THEN strftime(ts, '%d.%m.%Y %H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment FROM events),
  parsed AS (
    SELECT event_id, coalesce(TRY_CAST(moment AS TIMESTAMP), try_strptime(moment, '%m/%d/%Y %H:%M'),
      try_strptime(moment, '%d.%m.%Y %H:%M:%S')) AS t FROM moments)"""


def _event_text(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.col("event_id") % 10
    text = F.when(digit == 0, None).when(digit == 1, "not a date")
    text = text.when(digit == 2, F.date_format("ts", "MM/dd/yyyy HH:mm")).when(digit == 3, F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
    text = text.otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, folder, "events").select("event_id", text.alias("moment"))


@query(
    f"""WITH {EVENT_TEXT}
    SELECT event_id, (isodow(t) - 1)::INTEGER AS day_of_week, month(t)::INTEGER AS month,
      coalesce(hour(t), -1)::INTEGER AS hour FROM parsed"""
)
def feat_datetime(spark: SparkSession, folder: str) -> DataFrame:
    out = f.DateParts("moment").transform(_event_text(spark, folder))
    return out.select("event_id", "day_of_week", "month", "hour")


@query(
    f"""WITH {EVENT_TEXT}
    SELECT event_id, round(sin(2 * pi() * coalesce(hour(t), -1) / 24), 6) + 0.0 AS hour_sin,
      round(cos(2 * pi() * coalesce(hour(t), -1) / 24), 6) + 0.0 AS hour_cos FROM parsed"""
)
def feat_cyclic_hour(spark: SparkSession, folder: str) -> DataFrame:
    out = f.DateParts("moment").transform(_event_text(spark, folder)).select("event_id", "hour_sin", "hour_cos")
    return out.select("event_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("hour_sin", "hour_cos")])


@query(
    f"""WITH {EVENT_TEXT},
    priority AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
      ELSE substr(o_orderpriority, 1, 1) || '.5' END AS text FROM orders)
    SELECT 'order' AS kind, o_orderkey AS id, TRY_CAST(text AS DOUBLE) AS number, NULL::TIMESTAMP AS moment
    FROM priority
    UNION ALL SELECT 'event', event_id, NULL, t FROM parsed"""
)
def lenient_parse(spark: SparkSession, folder: str) -> DataFrame:
    first = F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".5"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(first)
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    numbers = orders.select(
        F.lit("order").alias("kind"),
        F.col("o_orderkey").alias("id"),
        as_number(orders, "text").alias("number"),
        F.lit(None).cast("timestamp_ntz").alias("moment"),
    )
    events = _event_text(spark, folder)
    moments = events.select(
        F.lit("event").alias("kind"),
        F.col("event_id").alias("id"),
        F.lit(None).cast("double").alias("number"),
        as_timestamp(events, "moment", f.DATE_FORMATS).alias("moment"),
    )
    return numbers.unionByName(moments)


PART_STEPS = {
    "features": {"engineered": ["interactions", "not_registered", "outlier_flags", "bmi"]},
    "preprocessing": {
        "weight_col": "p_retailprice",
        "height_col": "p_size",
        "interaction_columns": ["p_size", "p_retailprice"],
        "outlier_columns": ["p_retailprice"],
        "z_threshold": 1.5,
    },
}


@query(
    """WITH stats AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s FROM part)
    SELECT p_partkey, round(p_size * p_retailprice, 4) AS p_size_x_p_retailprice,
      (abs((p_retailprice - m) / s) > 1.5)::INTEGER AS p_retailprice_outlier,
      round(p_retailprice / nullif((p_size / 100.0::DOUBLE) * (p_size / 100.0::DOUBLE), 0), 4) AS bmi,
      'interactions,outlier_flags,bmi' AS applied FROM part, stats"""
)
def feat_sequence(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    out, applied = f.engineer(part, PART_STEPS)
    out = rounded(out, ["p_size_x_p_retailprice", "bmi"], 4)
    return out.withColumn("applied", F.lit(",".join(applied)))


# Part sizes, prices and types with gaps put in by key.
PART = """part_gaps AS (
  SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size END AS p_size,
    CASE WHEN p_partkey % 10 = 1 THEN NULL WHEN p_partkey % 10 = 2 THEN 'nan'::DOUBLE
      ELSE p_retailprice END AS p_retailprice,
    CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE p_type END AS p_type, p_brand FROM part),
  part_clean AS (SELECT * REPLACE (CASE WHEN isnan(p_retailprice) THEN NULL ELSE p_retailprice END AS p_retailprice)
    FROM part_gaps)"""


def part_gaps(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.col("p_partkey") % 10
    price = F.when(digit == 1, None).when(digit == 2, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    return table(spark, folder, "part").select(
        "p_partkey",
        F.when(digit != 0, F.col("p_size")).alias("p_size"),
        price.alias("p_retailprice"),
        F.when(digit != 3, F.col("p_type")).alias("p_type"),
        "p_brand",
    )


def _fit_apply(df: DataFrame, branches: Sequence[Branch], keep: Sequence[str] = ("p_partkey",)) -> DataFrame:
    plan = Preprocessor(branches)
    return plan.transform(df, plan.fit(df), keep)


@query(
    f"""WITH {PART}, s AS (SELECT avg(p_size) AS a, avg(p_retailprice) AS b FROM part_clean)
    SELECT p_partkey, round(coalesce(p_size, a), 6) AS p_size,
      round(coalesce(p_retailprice, b), 6) AS p_retailprice FROM part_clean, s"""
)
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    branches = [Branch(c, "numeric", impute="mean") for c in ("p_size", "p_retailprice")]
    return rounded(_fit_apply(part_gaps(spark, folder), branches), ["p_size", "p_retailprice"])


@query(
    f"""WITH {PART}, s AS (SELECT median(p_size) AS a, median(p_retailprice) AS b FROM part_clean)
    SELECT p_partkey, round(coalesce(p_size, a)::DOUBLE, 6) AS p_size,
      round(coalesce(p_retailprice, b), 6) AS p_retailprice FROM part_clean, s"""
)
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    branches = [Branch(c, "numeric", impute="median") for c in ("p_size", "p_retailprice")]
    return rounded(_fit_apply(part_gaps(spark, folder), branches), ["p_size", "p_retailprice"])


@query(
    f"""WITH {PART} SELECT p_partkey, coalesce(p_size, -1)::DOUBLE AS p_size, coalesce(p_type, 'none') AS p_type FROM part_clean"""
)
def impute_constant(spark: SparkSession, folder: str) -> DataFrame:
    branches = [
        Branch("p_size", "numeric", impute="constant", fill_value=-1),
        Branch("p_type", "category", impute="constant", fill_value="none"),
    ]
    return _fit_apply(part_gaps(spark, folder), branches)


@query(
    f"""WITH {PART},
    marked AS (
      SELECT p_partkey, p_partkey % 2 = 0 AS learn, coalesce(p_size, 0)::DOUBLE AS size,
        CASE WHEN p_partkey % 2 = 0 THEN 5.0 ELSE p_partkey END::DOUBLE AS same FROM part_clean),
    s AS (
      SELECT min(size) AS lo, max(size) AS hi, avg(size) AS m, stddev_pop(size) AS d FROM marked WHERE learn)
    SELECT p_partkey, round((size - lo) / (hi - lo), 6) AS size_minmax, same - 5 AS same_minmax,
      round((size - m) / d, 6) + 0.0 AS size_standard, same - 5 AS same_standard FROM marked, s"""
)
def scale_other_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on even keys, where one column is constant, and applied to all rows."""
    learn = F.col("p_partkey") % 2 == 0
    rows = part_gaps(spark, folder).select(
        "p_partkey",
        F.coalesce(F.col("p_size"), F.lit(0)).cast("double").alias("size"),
        F.when(learn, 5.0).otherwise(F.col("p_partkey").cast("double")).alias("same"),
    )
    out = rows.select("p_partkey")
    for scaler in ("minmax", "standard"):
        plan = Preprocessor([Branch(c, "numeric", scaler=scaler) for c in ("size", "same")])
        scaled = plan.transform(rows, plan.fit(rows.where(learn)), ["p_partkey"])
        out = out.join(scaled.withColumnsRenamed({c: f"{c}_{scaler}" for c in ("size", "same")}), "p_partkey")
    return rounded(out, ["size_minmax", "size_standard"]).withColumn("size_standard", F.round("size_standard", 6) + F.lit(0.0))


@query(
    f"""WITH {PART},
    t AS (SELECT p_type AS top FROM part_clean WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    z AS (SELECT p_size AS top FROM part_clean WHERE p_size IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT p_partkey, coalesce(p_type, t.top) AS p_type, coalesce(p_size, z.top)::DOUBLE AS p_size
    FROM part_clean, t, z"""
)
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    branches = [
        Branch("p_type", "category", impute="most_frequent"),
        Branch("p_size", "numeric", impute="most_frequent"),
    ]
    return _fit_apply(part_gaps(spark, folder), branches)


@query(
    f"""WITH {PART},
    m AS (SELECT avg(p_size) AS a FROM part_clean),
    x AS (SELECT p_partkey, coalesce(p_size, a) AS p_size, 7.0::DOUBLE AS constant FROM part_clean, m)
    SELECT p_partkey, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()), 6) AS p_size,
      0.0::DOUBLE AS constant FROM x"""
)
def scale_minmax(spark: SparkSession, folder: str) -> DataFrame:
    branches = [Branch(c, "numeric", impute="mean", scaler="minmax") for c in ("p_size", "constant")]
    df = part_gaps(spark, folder).withColumn("constant", F.lit(7.0))
    return rounded(_fit_apply(df, branches), ["p_size"])


@query(
    f"""WITH {PART},
    m AS (SELECT avg(p_size) AS a, avg(p_retailprice) AS b FROM part_clean),
    x AS (SELECT p_partkey, p_brand, coalesce(p_size, a) AS p_size, coalesce(p_retailprice, b) AS p_retailprice
      FROM part_clean, m)
    SELECT p_partkey, p_brand, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) + 0.0 AS p_size,
      round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) + 0.0 AS p_retailprice,
      0.0::DOUBLE AS constant FROM x"""
)
def scale_standard(spark: SparkSession, folder: str) -> DataFrame:
    """All numeric columns are scaled; the target (here the brand) is kept as it is."""
    names = ("p_size", "p_retailprice", "constant")
    branches = [Branch(c, "numeric", impute="mean", scaler="standard") for c in names]
    df = part_gaps(spark, folder).withColumn("constant", F.lit(7.0))
    out = rounded(_fit_apply(df, branches, ["p_partkey", "p_brand"]), ["p_size", "p_retailprice"])
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("p_size", "p_retailprice")})


PRICE_BINS = f"""{PART},
  m AS (SELECT avg(p_retailprice) AS b FROM part_clean),
  x AS (SELECT p_partkey, coalesce(p_retailprice, b) AS p FROM part_clean, m),
  q AS (SELECT quantile_cont(p, 0.25) AS e1, quantile_cont(p, 0.5) AS e2, quantile_cont(p, 0.75) AS e3 FROM x),
  binned AS (SELECT p_partkey, (p >= e1)::INTEGER + (p >= e2)::INTEGER + (p >= e3)::INTEGER AS bin FROM x, q)"""

PRICE_BRANCH = Branch("p_retailprice", "numeric", impute="mean", bins=4)


def _price_bins(spark: SparkSession, folder: str) -> DataFrame:
    plan = Preprocessor([PRICE_BRANCH])
    df = part_gaps(spark, folder)
    params = plan.fit(df)
    out = plan.transform(df, params, ["p_partkey"])
    return out.toDF("p_partkey", *[f"price_bin_{i}" for i in range(len(plan.output_names(params)))])


@query(f"WITH {PRICE_BINS} SELECT bin, count(*)::BIGINT AS n_rows FROM binned GROUP BY ALL")
def bin_quantile(spark: SparkSession, folder: str) -> DataFrame:
    out = _price_bins(spark, folder)
    bins = [c for c in out.columns if c.startswith("price_bin_")]
    place = F.array_position(F.array(*bins), F.lit(1.0)).cast("int") - 1
    return out.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))


@query()
def quantiles_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of the event values from one sketch per type, merged, and how far their ranks are off. The sketch draws lots, so no SQL."""
    events, shares = table(spark, folder, "events"), [0.25, 0.5, 0.75]
    merged = merge_sketches(quantile_sketches(events, {"value": F.col("value")}, ["event_type"]), ["value"])
    found = materialize(merged.select(F.posexplode(sketch_quantiles(F.col("value"), shares)).alias("at", "estimate")), "quantiles")
    ranks = events.join(F.broadcast(found)).groupBy("at").agg(
        F.count("value").alias("n_values"), F.first("estimate").alias("estimate"), F.avg((F.col("value") < F.col("estimate")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("estimate")).cast("double")).alias("up_to")
    )
    share = F.get(F.array(*map(F.lit, shares)), F.col("at"))
    return ranks.select(share.alias("share"), "n_values", "estimate", F.greatest(F.lit(0.0), F.col("below") - share, share - F.col("up_to")).alias("rank_off"), F.lit(rank_error()).alias("rank_error"))


@query(
    f"""WITH {PRICE_BINS}
    SELECT p_partkey, (bin = 0)::INTEGER::DOUBLE AS price_bin_0, (bin = 1)::INTEGER::DOUBLE AS price_bin_1,
      (bin = 2)::INTEGER::DOUBLE AS price_bin_2, (bin = 3)::INTEGER::DOUBLE AS price_bin_3 FROM binned"""
)
def bin_onehot(spark: SparkSession, folder: str) -> DataFrame:
    return _price_bins(spark, folder)


# The encoders learn from settled orders only, so that pending ones bring unseen values.
STATUS = """kinds AS (
  SELECT o_orderkey, o_orderstatus || substr(o_orderpriority, 1, 1) AS kind, o_orderstatus FROM orders),
  known AS (SELECT DISTINCT kind FROM kinds WHERE o_orderstatus <> 'P')"""


def _kinds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    kind = F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("kind")
    orders = table(spark, folder, "orders").select("o_orderkey", kind, "o_orderstatus")
    return orders, orders.where(F.col("o_orderstatus") != "P")


@query(
    f"""WITH {STATUS}
    SELECT o_orderkey, {", ".join(f"(kind = '{s}{p}')::INTEGER::DOUBLE AS kind_{s}{p}" for s in "FO" for p in "12345")}
    FROM kinds"""
)
def encode_onehot(spark: SparkSession, folder: str) -> DataFrame:
    orders, learn = _kinds(spark, folder)
    plan = Preprocessor([Branch("kind", "category", impute="most_frequent", encoding="onehot")])
    return plan.transform(orders, plan.fit(learn), ["o_orderkey"])


#: Orders by kind and by clerk-like customer, learnt on those that are not pending: places of the sparse vector.
SPARSE = f"""{STATUS},
    rows AS (SELECT o_orderkey, kind, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS buyer, o_orderkey % 8 AS size FROM kinds JOIN orders USING (o_orderkey)),
    learn AS (SELECT * FROM rows WHERE kind NOT LIKE 'P%'),
    kind_codes AS (SELECT kind, row_number() OVER (ORDER BY kind) AS at FROM (SELECT DISTINCT kind FROM learn)),
    buyer_codes AS (
      SELECT buyer, (SELECT count(*) FROM kind_codes) + row_number() OVER (ORDER BY buyer NULLS LAST) AS at FROM (SELECT DISTINCT buyer FROM learn)),
    placed AS (
      SELECT o_orderkey, size, k.at AS kind_at, b.at AS buyer_at
      FROM rows r LEFT JOIN kind_codes k USING (kind) LEFT JOIN buyer_codes b ON r.buyer IS NOT DISTINCT FROM b.buyer)"""


def _sparse(spark: SparkSession, folder: str) -> DataFrame:
    orders, _ = _kinds(spark, folder)
    buyer = table(spark, folder, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("buyer"))
    rows = orders.join(buyer, "o_orderkey").withColumn("size", F.col("o_orderkey") % 8)
    codes = fit_sparse(rows.where(F.col("o_orderstatus") != "P"), ["kind", "buyer"], ["size"])
    return to_sparse(rows, codes, "vector", ["o_orderkey"])


@query(
    f"""WITH {SPARSE}
    SELECT o_orderkey, concat_ws(',', 0, kind_at, buyer_at) AS indices,
      concat_ws(',', size, CASE WHEN kind_at IS NOT NULL THEN 1 END, CASE WHEN buyer_at IS NOT NULL THEN 1 END) AS vals FROM placed"""
)
def encode_onehot_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds and thousands of customers, some missing and some unseen, beside a number; as texts to be compared."""
    whole = F.transform("vector.values", lambda v: v.cast("bigint").cast("string"))
    return _sparse(spark, folder).select("o_orderkey", F.array_join("vector.indices", ",").alias("indices"), F.array_join(whole, ",").alias("vals"))


@query(
    f"""WITH {SPARSE},
    pairs AS (
      SELECT a.o_orderkey, b.o_orderkey AS other, a.size AS x, b.size AS y, a.size * b.size AS both_sizes,
        (a.kind_at IS NOT NULL)::INTEGER + (a.buyer_at IS NOT NULL)::INTEGER AS n, (b.kind_at IS NOT NULL)::INTEGER + (b.buyer_at IS NOT NULL)::INTEGER AS m,
        coalesce(a.kind_at = b.kind_at, false)::INTEGER + coalesce(a.buyer_at = b.buyer_at, false)::INTEGER AS same
      FROM placed a JOIN placed b ON b.o_orderkey = a.o_orderkey + 1)
    SELECT o_orderkey, other, round(sqrt((x - y) * (x - y) + n + m - 2 * same), 6) AS euclidean,
      round(1 - coalesce((both_sizes + same) / nullif(sqrt(x * x + n) * sqrt(y * y + m), 0), 0), 6) AS cosine FROM pairs"""
)
def sparse_distances(spark: SparkSession, folder: str) -> DataFrame:
    """Distances of sparse vectors of neighbouring orders; in SQL those of the dense form."""
    rows = materialize(_sparse(spark, folder), "sparse")
    other = rows.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_orderkey").alias("other"), F.col("vector").alias("next"))
    both = rows.join(other, "o_orderkey")
    made = [F.round(sparse_distance(F.col("vector"), F.col("next"), m), 6).alias(m) for m in ("euclidean", "cosine")]
    return both.select("o_orderkey", "other", *made)


@query(
    f"""WITH {STATUS}, codes AS (SELECT kind, (row_number() OVER (ORDER BY kind) - 1)::DOUBLE AS code FROM known)
    SELECT o_orderkey, coalesce(code, -1) AS kind FROM kinds LEFT JOIN codes USING (kind)"""
)
def encode_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    orders, learn = _kinds(spark, folder)
    plan = Preprocessor([Branch("kind", "category", impute="most_frequent", encoding="ordinal")])
    return plan.transform(orders, plan.fit(learn), ["o_orderkey"])


ORDER_SPLIT = split_ctes("orders", "o_orderkey", "o_orderstatus")


@query(
    f"""WITH {ORDER_SPLIT},
    s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM split_rows WHERE split = 'train')
    SELECT o_orderkey, split, round((o_totalprice - lo) / (hi - lo), 6) + 0.0 AS o_totalprice,
      {", ".join(f"(o_orderpriority = '{p}')::INTEGER::DOUBLE AS p{i}" for i, p in enumerate(
        ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]))}
    FROM split_rows, s"""
)
def fit_train_apply_all(spark: SparkSession, folder: str) -> DataFrame:
    split = stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus")
    plan = Preprocessor(
        [
            Branch("o_totalprice", "numeric", impute="mean", scaler="minmax"),
            Branch("o_orderpriority", "category", impute="most_frequent", encoding="onehot"),
        ]
    )
    params = plan.fit(split.where(F.col("split") == "train"))
    out = plan.transform(split, params, ["o_orderkey", "split"])
    n = len(params["categories"]["o_orderpriority"])
    out = out.toDF("o_orderkey", "split", "o_totalprice", *[f"p{i}" for i in range(n)])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 6) + F.lit(0.0))


@query(
    f"""WITH {ORDER_SPLIT},
    gaps AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice::DOUBLE END AS gappy FROM split_rows),
    s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(gappy) AS mean,
        sqrt(var_pop(gappy) * count(gappy) / count(*)) AS std FROM gaps WHERE split = 'train')
    SELECT o_orderkey, split, round((o_totalprice - lo) / (hi - lo), 6) + 0.0 AS o_totalprice,
      round((coalesce(gappy, mean) - mean) / std, 6) + 0.0 AS gappy FROM gaps, s"""
)
def fit_merge_apply(spark: SparkSession, folder: str) -> DataFrame:
    """States of the train rows by priority and day, merged by priority, then to one and applied to all rows in one plan."""
    split = stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus")
    rows = split.withColumn("gappy", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice").cast("double")))
    columns = ["o_totalprice", "gappy"]
    parts = fit_state(rows.where("split = 'train'"), columns, ["o_orderpriority", "o_orderdate"])
    by_priority = merge_states(parts, columns, ["o_orderpriority"])
    state = merge_states(by_priority, columns)
    out = apply_state(rows, state, {"o_totalprice": Scale("minmax"), "gappy": Scale("standard", impute=True)})
    return out.select("o_orderkey", "split", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in columns])


PART_CONFIG = {
    "features": {"continuous": ["size", "price"], "categorical": ["p_type"]},
    "raw_features": ["p_size", "p_retailprice", "p_type", "p_brand"],
    "preprocessing": {
        "rename_columns": {"p_size": "size", "p_retailprice": "price"},
        "size": {"imputer_strategy": "median", "scaler": "standard"},
        "price": {"imputer_strategy": "mean"},
        "p_type": {"encoding": "ordinal"},
    },
}

PART_FULL = f"""{PART},
  m AS (SELECT median(p_size) AS a, avg(p_retailprice) AS b FROM part_clean),
  t AS (SELECT p_type AS top FROM part_clean WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  x AS (SELECT p_partkey, p_brand, coalesce(p_size, a)::DOUBLE AS size, coalesce(p_retailprice, b) AS price,
    coalesce(p_type, top) AS p_type FROM part_clean, m, t),
  codes AS (SELECT p_type, (row_number() OVER (ORDER BY p_type) - 1)::DOUBLE AS code
    FROM (SELECT DISTINCT p_type FROM x))"""


@query(
    f"""WITH {PART_FULL}
    SELECT p_partkey, round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) + 0.0 AS size,
      round((price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()), 6) AS price,
      code AS p_type, p_brand FROM x JOIN codes USING (p_type)"""
)
def preprocess_full(spark: SparkSession, folder: str) -> DataFrame:
    df = part_gaps(spark, folder)
    plan = build_preprocessor(PART_CONFIG)
    out = rounded(plan.transform(df, plan.fit(df), ["p_partkey"]), ["size", "price"])
    return out.withColumn("size", F.col("size") + F.lit(0.0))


@query(
    f"""WITH {PART_FULL},
    e AS (SELECT quantile_cont(price, 0.5) AS half FROM x)
    SELECT p_partkey, size, (price < half)::INTEGER::DOUBLE AS price_low, (price >= half)::INTEGER::DOUBLE AS price_high,
      p_type, p_brand FROM x, e"""
)
def column_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Branches in order, then the passthrough; no scaler and no encoder where told so."""
    df = rename(part_gaps(spark, folder), {"p_size": "size", "p_retailprice": "price"})
    plan = Preprocessor(
        [
            Branch("size", "numeric", impute="median"),
            Branch("price", "numeric", impute="mean", bins=2),
            Branch("p_type", "category", impute="most_frequent"),
        ],
        passthrough=["p_brand"],
    )
    out = plan.transform(df, plan.fit(df), ["p_partkey"])
    return out.toDF("p_partkey", "size", "price_low", "price_high", "p_type", "p_brand")


@query(
    f"""WITH {PART},
    kinds AS (SELECT DISTINCT p_type FROM part_clean WHERE p_type IS NOT NULL),
    names AS (
      SELECT 0 AS place, 'size' AS name UNION ALL SELECT 1, 'price'
      UNION ALL SELECT 1 + row_number() OVER (ORDER BY p_type), 'p_type_' || p_type FROM kinds
      UNION ALL SELECT 1000000, 'p_brand')
    SELECT (row_number() OVER (ORDER BY place) - 1)::INTEGER AS ordinal, name FROM names"""
)
def output_names(spark: SparkSession, folder: str) -> DataFrame:
    config = {**PART_CONFIG, "preprocessing": {**PART_CONFIG["preprocessing"], "p_type": {}}}
    plan = build_preprocessor(config)
    names = plan.output_names(plan.fit(part_gaps(spark, folder)))
    return spark.createDataFrame(list(enumerate(names)), "ordinal int, name string")
