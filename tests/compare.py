"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences between both results; an empty list means equal."""
    df = query(spark, sf_dir)
    ours = _sorted_rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _sorted_rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    return [f"{a!r:.300} != {b!r:.300}" for a, b in zip(ours, theirs) if a != b]
