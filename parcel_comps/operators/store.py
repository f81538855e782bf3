"""Last-wins de-duplication, upserts, snapshots and the response cache."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_comps import schemas
from parcel_comps.functions.scalars import is_blank, request_key, request_params_json
from parcel_comps.operators.skew import skew_join


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are neither NULL nor blank."""
    types = dict(df.dtypes)
    for key in keys:
        usable = ~is_blank(key) if types[key] == "string" else F.col(key).isNotNull()
        df = df.where(usable)
    return df


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order``. ``max_by`` combines map-side, so a hot key is cheap."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    order: list[str],
    stamp: str | None = None,
    now: Column | None = None,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """The target with ``updates`` inserted or replacing rows of the same key.

    Updates without a key are skipped and the last one per key wins. ``stamp`` is
    set on every row written. ``keep`` names columns an update must not touch, with
    their value for new rows. The result is a new frame; write it as a new snapshot.
    """
    return merged(target, last_wins(with_keys(updates, keys), keys, order), keys, stamp, now, keep)


def merged(
    target: DataFrame,
    fresh: DataFrame,
    keys: list[str],
    stamp: str | None = None,
    now: Column | None = None,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """``upsert`` of rows that have each key once."""
    if stamp:
        fresh = fresh.withColumn(stamp, now if now is not None else F.current_timestamp())
    if keep:
        kept = target.select(
            *keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_keep_{c}") for c in keep]
        )
        fresh = fresh.drop(*keep).join(kept, keys, "left")
        for name, default in keep.items():
            old = F.when(F.col("_old"), F.col(f"_keep_{name}")).otherwise(default)
            fresh = fresh.withColumn(name, old)
    untouched = target.join(fresh.select(*keys), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(fresh.select(*target.columns))


def write_snapshot(df: DataFrame, root: str, version: int, partition_by: list[str] | None = None):
    """Write a table version next to the older ones; never over a path being read."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/snapshot={version}")


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={version}")


# --- response cache ------------------------------------------------------------------


def cache_requests(requests: DataFrame, source: str) -> DataFrame:
    """Add ``source`` and ``request_key`` to rows of (``endpoint``, ``params`` map)."""
    return requests.withColumn("source", F.lit(source)).withColumn(
        "request_key", request_key("params")
    )


def cache_entries(
    responses: DataFrame, source: str, now: Column, ttl: dt.timedelta | None
) -> DataFrame:
    """Cache rows of fetched responses (``endpoint``, ``params``, ``body``, ``status_code``).

    No, zero or negative ``ttl`` means the entry never expires.
    """
    expires = F.lit(None).cast("timestamp")
    if ttl is not None and ttl > dt.timedelta(0):
        expires = now + F.make_dt_interval(secs=F.lit(ttl.total_seconds()))
    columns = {
        "source": F.lit(source),
        "endpoint": F.col("endpoint"),
        "request_key": request_key("params"),
        "request_params": request_params_json("params"),
        "response_body": F.coalesce("body", F.lit("null")),
        "status_code": F.col("status_code"),
        "fetched_at": now,
        "expires_at": expires,
        "hit_count": F.lit(0),
    }
    return responses.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.SOURCE_CACHE.fields
        ],
        *[F.col(c) for c in ("_file", "_pos") if c in responses.columns],
    )


def cache_counters() -> dict[str, Column]:
    """What an upsert of the cache leaves alone, with the values of new entries."""
    return {"hit_count": F.lit(0), "last_hit_at": F.lit(None).cast("timestamp")}


def save_cache(cache: DataFrame, entries: DataFrame, order: list[str]) -> DataFrame:
    """Upsert that leaves the hit counters of existing entries alone."""
    return upsert(cache, entries, schemas.CACHE_KEY, order, keep=cache_counters())


def cache_lookup(requests: DataFrame, cache: DataFrame, now: Column, spread: list[str]) -> DataFrame:
    """Requests with ``hit`` and, for hits, the cached response.

    An entry without expiry never expires; one that expires exactly now still holds.
    Requests that miss are the list of calls to make.
    """
    entries = cache.select(
        *schemas.CACHE_KEY, "status_code", "response_body", "expires_at"
    ).withColumn("_found", F.lit(True))
    joined = skew_join(requests, entries, schemas.CACHE_KEY, spread)
    live = F.col("_found") & (F.col("expires_at").isNull() | (F.col("expires_at") >= now))
    hit = F.coalesce(live, F.lit(False))
    return joined.select(
        *requests.columns,
        hit.alias("hit"),
        F.when(hit, F.col("status_code")).alias("status_code"),
        F.when(hit, F.col("response_body")).alias("response_body"),
    )


def record_hits(cache: DataFrame, hits: DataFrame, at: str) -> DataFrame:
    """Add one to ``hit_count`` per hit row and move ``last_hit_at`` to the latest ``at``."""
    counted = hits.groupBy(*schemas.CACHE_KEY).agg(
        F.count(F.lit(1)).cast("int").alias("_hits"), F.max(at).alias("_last")
    )
    joined = cache.join(counted, schemas.CACHE_KEY, "left")
    return joined.withColumn(
        "hit_count", F.col("hit_count") + F.coalesce("_hits", F.lit(0))
    ).withColumn("last_hit_at", F.coalesce("_last", "last_hit_at")).select(*cache.columns)
