"""Run a query in Spark and its oracle in DuckDB and compare them as the driver does."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value, digits: int | None):
    if isinstance(value, float):
        if math.isnan(value):
            return "NULL"
        return repr(value if digits is None else round(value, digits) + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return "NULL" if value is None else str(value)


def rows_of(names: list[str], rows: list[tuple], digits: int | None) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i], digits) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, query, sql: str | None, digits: int | None = 5):
    """(problem or None, number of rows)."""
    frame = query(spark, sf_dir)
    mine = [tuple(r) for r in frame.collect()]
    if sql is None:
        return (None if mine else "no rows"), len(mine)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(mine)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, oracle has {len(theirs)}", len(mine)
    a, b = rows_of(frame.columns, mine, digits), rows_of(names, theirs, digits)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first: {bad[0]}", len(mine)
    return None, len(mine)
