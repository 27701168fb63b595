"""Exact dedup by a persistent index of text digests, bucketed and sorted by digest.

The index is a bucketed Parquet table. A delivery is reduced to one row per
digest, anti-joined with the index by a sort-merge join (the index is read in its
buckets and is not shuffled) and what is new is appended in the same buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.llm.common import fresh, pick
from sparktab.session import materialize, path_exists, scratch_path

#: A digest with more rows than this share of a table is sent to the rows; so there are at most so many of them, 1 MB.
HOT_SHARE = 1 / 16_384
LEAST_HOT = 64
ENTRY = "digest binary, delivery string, id {id}, row long, n long"


def text_digest(text: str) -> F.Column:
    """SHA-256 of the whole text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


@dataclass
class DigestIndex:
    """Digests of all texts delivered so far, in a folder any later session can open.

    An entry holds a digest, the row that stays (set by the delivery that brought
    the digest first) and how many rows a delivery had of it. A digest that comes
    again adds an entry without a row, so nothing written is ever changed.
    Deliveries have names. Entries count once their delivery is marked complete:
    one that died half-way leaves rows nobody reads and is simply added again;
    one that is complete is not added twice.
    """

    spark: SparkSession
    path: str
    buckets: int
    id_type: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint") -> DigestIndex:
        """The index in this folder, or a new one with so many buckets (the session's shuffle partitions)."""
        settings = f"{path}/settings"
        if path_exists(spark, f"{settings}/_SUCCESS"):
            found = spark.read.parquet(settings).first()
            buckets, id_type = found.buckets, found.id_type
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(buckets, id_type)], "buckets int, id_type string").coalesce(1).write.mode("overwrite").parquet(settings)
        index = cls(spark, path, buckets, id_type)
        if not spark.catalog.tableExists(index.name):
            spark.sql(
                f"CREATE TABLE {index.name} ({ENTRY.format(id=id_type)}) USING parquet LOCATION '{path}/entries' "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            )
        return index

    @property
    def name(self) -> str:
        return f"digests_{md5(self.path.encode(), usedforsecurity=False).hexdigest()}"

    def deliveries(self) -> list[str]:
        """Attempts that are complete, as ``name/attempt``; one short row for each delivery."""
        path = f"{self.path}/complete"
        return [r.value for r in self.spark.read.text(path).collect()] if path_exists(self.spark, path) else []

    def entries(self) -> DataFrame:
        """``digest, delivery, id, row, n`` of the complete deliveries, read in buckets."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col("delivery").isin(self.deliveries()))

    def digests(self) -> DataFrame:
        """``digest, keep_id, keep_delivery, keep_row, group_size``, one row per digest; the buckets need no shuffle."""
        first = F.max_by(F.struct("id", "delivery", "row"), F.col("row").isNotNull())
        return self.entries().groupBy("digest").agg(first.alias("first"), F.sum("n").alias("group_size")).select(
            "digest", F.col("first.id").alias("keep_id"), F.split("first.delivery", "/")[0].alias("keep_delivery"), F.col("first.row").alias("keep_row"), "group_size"
        )

    def add(self, prints: DataFrame, delivery: str) -> None:
        """Deduplicate a delivery (``digest, id, row``) within itself and against the index, and append what it brings.

        Of equal texts the row of the largest id stays, of its repeats the one with the
        largest row number (nulls are less than any id). Rows are combined per digest
        before the shuffle, so a digest with a third of all rows is one row per task.
        """
        if "/" in delivery:
            raise ValueError("names of deliveries have no slash")
        if any(d.split("/")[0] == delivery for d in self.deliveries()):
            return
        rank = F.struct(F.col("id").isNotNull(), "id", "row")
        once = prints.groupBy("digest").agg(F.max_by(F.struct("id", "row"), rank).alias("first"), F.count(F.lit(1)).alias("n"))
        once = materialize(once.repartition(self.buckets, "digest"), "delivery")
        known = self.entries().where("row is not null").select("digest")
        merge = once.repartition(self.buckets, "digest").hint("merge")
        attempt = F.lit(f"{delivery}/{uuid.uuid4().hex}")
        new = merge.join(known, "digest", "left_anti").select("digest", attempt.alias("delivery"), "first.id", "first.row", "n")
        seen = merge.join(known, "digest", "left_semi").select("digest", attempt.alias("delivery"), F.lit(None).cast(self.id_type).alias("id"), F.lit(None).cast("long").alias("row"), "n")
        out = new.unionByName(seen).repartition(self.buckets, "digest")
        out.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", f"{self.path}/entries").saveAsTable(self.name)
        self.spark.range(1).select(attempt.alias("value")).coalesce(1).write.mode("append").text(f"{self.path}/complete")


def hot_rows(rows: int) -> int:
    return max(LEAST_HOT, int(rows * HOT_SHARE))


def exact_groups(prints: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``prints`` (``digest, delivery, id, row``) with ``keep_id, group_size, kept``.

    Digests with many rows are few by count (at most 1 / HOT_SHARE) and are sent to
    the rows; the others meet the buckets of the index in a sort-merge join, in which
    no key has more than ``hot_rows`` rows.
    """
    found = index.digests()
    hot = materialize(found.where(F.col("group_size") > hot_rows(prints.count())), "hot")
    marked = prints.join(F.broadcast(hot), "digest", "left")
    rest = marked.where("group_size is null").select(*prints.columns).repartition(index.buckets, "digest")
    rest = rest.hint("merge").join(found, "digest")
    both = marked.where("group_size is not null").unionByName(rest)
    kept = (F.col("delivery") == F.col("keep_delivery")) & (F.col("row") == F.col("keep_row"))
    return both.select("digest", "id", "row", "keep_id", "group_size", kept.alias("kept"))


def exact_dedup(df: DataFrame, index: DigestIndex | None = None, deliveries: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, digest`` for every row of a table.

    Texts are equal when identical; null counts as empty. Of equal texts the row of
    the largest id stays; null ids are less than any id, and of rows that repeat id
    and text exactly one stays. The table comes in deliveries of falling id (cut at
    quantiles, null ids last; ids that are no numbers in one), each checked against
    the index of those before; an index that already holds texts of other tables
    keeps their rows. An empty table gives an empty result; other columns, whatever
    their names, are not read.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_col, text=text_col).select("id", text_digest("text").alias("digest"))
    shares = [i / deliveries for i in range(1, deliveries)] if isinstance(df.schema[id_col].dataType, T.NumericType) else []
    cuts = sorted(set(rows.approxQuantile("id", shares, 0.01)), reverse=True) if shares else []
    index = index or DigestIndex.open(spark, scratch_path(spark, "digests"), id_type=df.schema[id_col].dataType.simpleString())
    run = uuid.uuid4().hex
    at = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):
        at = F.when(F.col("id") >= cut, F.lit(i)).otherwise(at)
    marked = rows.withColumns({"delivery": F.concat(F.lit(f"{run}-"), at.cast("string")), "row": F.monotonically_increasing_id()})
    prints = materialize(marked, "prints")
    for i in range(len(cuts) + 1):
        index.add(prints.where(F.col("delivery") == f"{run}-{i}"), f"{run}-{i}")
    return exact_groups(prints, index).select("id", "keep_id", "group_size", "kept", "digest")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with one row for each text: that of the largest id, by the rule of ``exact_dedup``."""
    spark, row = df.sparkSession, fresh(df, "exact_row")
    stored = materialize(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    prints = stored.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"), F.col(row).alias("row"), F.lit("all").alias("delivery"))
    index = DigestIndex.open(spark, scratch_path(spark, "digests"), id_type=df.schema[id_col].dataType.simpleString())
    index.add(prints, "all")
    kept = index.entries().where("row is not null").select(F.col("row").alias(row))
    return stored.join(kept, row, "left_semi").select(*df.columns)
