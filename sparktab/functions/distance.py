"""Distances between two array columns, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The distance names a model may ask for.
METRICS = ("cosine", "euclidean", "minkowski")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine_distance(left: Column, right: Column) -> Column:
    """1 - cosine similarity; a zero vector is at distance 1 from everything."""
    similarity = F.try_divide(dot(left, right), norm(left) * norm(right))
    return 1.0 - F.coalesce(similarity, F.lit(0.0))


def minkowski_distance(left: Column, right: Column, p: float = 2.0) -> Column:
    powers = F.zip_with(
        left, right, lambda a, b: F.pow(F.abs(a.cast("double") - b.cast("double")), F.lit(p))
    )
    return F.pow(F.aggregate(powers, F.lit(0.0), lambda total, item: total + item), F.lit(1.0 / p))


def euclidean_distance(left: Column, right: Column) -> Column:
    squares = F.zip_with(
        left,
        right,
        lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")),
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, item: total + item))


def distance(left: Column, right: Column, metric: str) -> Column:
    if metric == "cosine":
        return cosine_distance(left, right)
    if metric == "euclidean":
        return euclidean_distance(left, right)
    if metric == "minkowski":
        return minkowski_distance(left, right)
    raise ValueError(f"unknown metric {metric!r}; known: {', '.join(METRICS)}")
