"""Name -> (query, oracle SQL)."""

from __future__ import annotations

import functools
import re
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_folder(fn: Query) -> Query:
    """A local session without ``spark.checkpoint.dir`` gets one; a cluster has to name its own."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not spark.conf.get("spark.checkpoint.dir", None) and re.match(r"local(\[|$)", spark.sparkContext.master):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-checks-"))
        return fn(spark, sf_dir)

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = with_folder(fn)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: Column | str) -> Column:
    """Six decimals, as in the oracles."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def joined(c: Column | str) -> Column:
    """An array as text, so both engines compare the same value."""
    return F.array_join(c, "|")
