"""One-hot encoding in sparse form: index and value vectors from code tables, and distances on them.

Categories never come to the driver and are no columns of the result, so a column
may have millions of them. The dense encoder stays for those that fit a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.distance import METRICS
from sparktab.functions.values import present, quoted
from sparktab.operators.preprocess import PreprocessError, code_table, require_columns


@dataclass(frozen=True)
class SparseColumn:
    """Where the categories of a column lie in the vector: ``first`` + code, a missing value last if fitting saw one."""

    column: str
    first: int
    known: int
    missing: bool
    table: str


@dataclass(frozen=True)
class SparseCodes:
    """The layout of the vector: numeric columns, then one block for each category column."""

    numeric: tuple[str, ...]
    columns: tuple[SparseColumn, ...] = field(default_factory=tuple)

    @property
    def size(self) -> int:
        last = self.columns[-1] if self.columns else None
        return last.first + last.known + last.missing if last else len(self.numeric)


def fit_sparse(df: DataFrame, categories: Sequence[str], numeric: Sequence[str] = ()) -> SparseCodes:
    """Code the sorted distinct values of every category column; one number a column reaches the driver.

    The values are ranked in slices and written as a table in the shared folder.
    """
    require_columns(df, [*categories, *numeric])
    at, columns = len(numeric), []
    for c in categories:
        codes = code_table(df, present(df, c))
        known = df.sparkSession.read.parquet(codes["table"]).count()
        columns.append(SparseColumn(c, at, known, codes["missing"], codes["table"]))
        at += known + codes["missing"]
    return SparseCodes(tuple(numeric), tuple(columns))


def to_sparse(df: DataFrame, codes: SparseCodes, vector_col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns and the vector: ``struct<indices: array<bigint>, values: array<double>>``.

    Indices rise. A category has the value 1 at its index; unseen ones, and missing
    ones if fitting saw none, have no index, as the dense form has only zeros. Numeric
    values stand at their place, a missing one (null or NaN) as null. Each category
    column is one join with its codes, sent to the rows where Spark finds them small.
    """
    require_columns(df, [*[c.column for c in codes.columns], *codes.numeric, *keep])
    spark, out, places = df.sparkSession, df, []
    for i, c in enumerate(codes.columns):
        category, code = f"_category{i}", f"_code{i}"
        table = spark.read.parquet(c.table).select(F.col("_category").alias(category), (F.col("_code").cast("long") + c.first).alias(code))
        value = present(df, c.column)
        out = out.join(table, value == F.col(category), "left")
        missing = F.lit(c.first + c.known).cast("long") if c.missing else F.lit(None).cast("long")
        places.append(F.when(value.isNull(), missing).otherwise(F.col(code)))
    n = len(codes.numeric)
    numbers = F.array(*[present(df, c).cast("double") for c in codes.numeric]) if n else F.array().cast("array<double>")
    found = F.array_compact(F.array(*places)) if places else F.array().cast("array<bigint>")
    front = F.array(*[F.lit(i).cast("long") for i in range(n)]) if n else F.array().cast("array<bigint>")
    vector = F.struct(F.concat(front, found).alias("indices"), F.concat(numbers, F.transform(found, lambda _: F.lit(1.0))).alias("values"))
    return out.select(*map(quoted, keep), vector.alias(vector_col))


def _entries(vector: Column) -> Column:
    return F.arrays_zip(vector["indices"].alias("i"), vector["values"].alias("v"))


def _lookup(vector: Column) -> Column:
    return F.map_from_arrays(vector["indices"], vector["values"])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def sparse_dot(left: Column, right: Column) -> Column:
    other = _lookup(right)
    return _total(F.transform(_entries(left), lambda e: e["v"] * F.coalesce(other[e["i"]], F.lit(0.0))))


def sparse_distance(left: Column, right: Column, metric: str = "euclidean") -> Column:
    """The distance of two sparse vectors, that of their dense forms, over the entries they have.

    A vector without entries or of zeros is at cosine distance 1 from everything.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {', '.join(METRICS)}")
    if metric == "cosine":
        sizes = F.sqrt(sparse_dot(left, left)) * F.sqrt(sparse_dot(right, right))
        return 1.0 - F.coalesce(F.try_divide(sparse_dot(left, right), sizes), F.lit(0.0))
    ours, theirs = _lookup(left), _lookup(right)
    here = F.transform(_entries(left), lambda e: F.pow(e["v"] - F.coalesce(theirs[e["i"]], F.lit(0.0)), F.lit(2.0)))
    there = F.transform(F.filter(_entries(right), lambda e: ~F.map_contains_key(ours, e["i"])), lambda e: F.pow(e["v"], F.lit(2.0)))
    return F.sqrt(_total(here) + _total(there))


def to_dense(vector: Column, codes: SparseCodes, most: int = 1_000) -> Column:
    """The vector as an array; refused above ``most`` places."""
    if codes.size > most:
        raise PreprocessError(f"{codes.size} places are too many for a dense vector")
    held = _lookup(vector)
    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(codes.size - 1).cast("long")), lambda i: F.coalesce(held[i], F.lit(0.0)))
