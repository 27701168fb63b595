"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=repr)


def difference(spark_df, db, sql) -> str | None:
    """None when columns, types and rows agree; else what differs."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    relation = db.sql(sql)
    want = rows_of(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    off = {n: (t, kinds[n]) for n, t in spark_df.dtypes if names.get(t, t) != kinds[n]}
    return f"types {off}" if off else None
