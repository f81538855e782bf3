"""Connected components of link tables in Spark: alternating large and small stars, no list of neighbours anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links``."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        # large star: each node hands its larger neighbours to its smallest one
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node hands its smaller neighbours and itself to its smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
