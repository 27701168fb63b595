"""Queries over the given tables, one per operator."""

from sparktab.queries import columns, metrics, neighbours, rules, scoring, splits, tables  # noqa: F401
from sparktab.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
