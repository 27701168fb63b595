"""Stratified splits, folds, samples and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators.split import complement, half_sample, kfold, stratified_split, stratified_split_by_table
from sparktab.operators.split import split_sizes as sizes
from sparktab.operators.split import union_splits as union
from sparktab.queries.registry import query, table
from sparktab.queries.sql import split_ctes

ORDER_SPLIT = split_ctes("orders", "o_orderkey", "o_orderstatus")


@query(
    f"""WITH {ORDER_SPLIT},
    hold AS (WITH {split_ctes("orders", "o_orderkey", "o_orderstatus", valid=0.0)}
      SELECT o_orderkey, split FROM split_rows)
    SELECT o_orderkey, o_orderstatus, s.split, hold.split AS hold_out
    FROM split_rows s JOIN hold USING (o_orderkey)"""
)
def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    """Train, valid and test, and beside them the single hold-out of the same draw."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    split = stratified_split(orders, "o_orderkey", "o_orderstatus")
    hold = stratified_split(split.withColumnRenamed("split", "s"), "o_orderkey", "o_orderstatus", valid=0.0)
    return hold.withColumnsRenamed({"split": "hold_out", "s": "split"})


@query(
    f"""WITH {split_ctes("orders", "o_orderkey", "o_custkey", test=0.25, valid=0.1)}
    SELECT o_orderkey, o_custkey, split FROM split_rows"""
)
def split_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A class for every customer: quotas by largest remainder as a table."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return stratified_split_by_table(orders, "o_orderkey", "o_custkey", test=0.25, valid=0.1)


@query(
    """WITH keyed AS (
      SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey)) AS place,
        count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN place <= n // 2 THEN 'sample' ELSE 'rest' END AS part FROM keyed"""
)
def split_half_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    sample = half_sample(orders, "o_orderkey")
    rest = complement(orders, sample, "o_orderkey")
    return sample.withColumn("part", F.lit("sample")).unionByName(rest.withColumn("part", F.lit("rest")))


@query(
    """SELECT o_orderkey, o_orderstatus, ((row_number() OVER (
      PARTITION BY o_orderstatus ORDER BY md5('42|' || o_orderkey)) - 1) % 5)::INTEGER AS fold FROM orders"""
)
def kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return kfold(orders, "o_orderkey", "o_orderstatus")


@query(
    f"""WITH {split_ctes("embeddings", "vec_id", "label")}
    SELECT split, label, count(*)::BIGINT AS n_rows FROM split_rows GROUP BY ALL"""
)
def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return sizes(stratified_split(table(spark, folder, "embeddings"), "vec_id", "label"), "label")


@query(
    f"""WITH {ORDER_SPLIT}
    SELECT split, count(*)::BIGINT AS n_rows, count(DISTINCT o_orderkey)::BIGINT AS n_ids,
      round(sum(o_totalprice), 2) AS total FROM split_rows GROUP BY ALL"""
)
def union_splits(spark: SparkSession, folder: str) -> DataFrame:
    split = stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus")
    whole = union([split.where(F.col("split") == name) for name in ("train", "valid", "test")])
    return whole.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_ids"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )
