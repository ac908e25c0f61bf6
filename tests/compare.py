"""Side-by-side comparison of the registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(value) -> str:
    """Types that may not be confused with each other."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, str, bytes, datetime.datetime, decimal.Decimal)):
        return type(value).__name__
    return "other"


def difference(spark_df, relation) -> str | None:
    """What differs between a Spark result and a DuckDB result, None if nothing does."""
    names = sorted(spark_df.columns)
    other = sorted(relation.columns)
    if names != other:
        return f"columns {names} / {other}"
    rows = sorted((tuple(r[n] for n in names) for r in spark_df.collect()), key=repr)
    position = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(r[p] for p in position) for r in relation.fetchall()), key=repr)
    if len(rows) != len(expected):
        return f"{len(rows)} rows / {len(expected)} rows"
    for a, b in zip(rows, expected):
        if a != b or [kind(x) for x in a] != [kind(x) for x in b]:
            return f"{a} / {b}"
    return None
