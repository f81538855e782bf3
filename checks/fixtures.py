"""Parcel, listing, assessment and cache frames derived from the driver tables.

Every frame exists twice: as a DataFrame and as a SQL common table expression with
the same arithmetic, so the oracle sees identical data. Fractions carry an exponent
in SQL; without one they would be DECIMAL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.geometry import rectangle
from parcel_comps.operators.spatial import index_parcels
from parcel_comps.operators.store import cache_requests
from parcel_comps.operators.tiles import ParcelTiles, write_tiles
from parcel_comps.plans.checkpoints import shared_folder

STREETS = ["OAK", "Elm", "Mountain View", "St. Mary's"]
SUFFIXES = ["ROAD", "Rd", "RD.", "Road"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Give the one small input file of the tests as many partitions as there are cores.

    A stored parcel table has many files; without this every narrow step of a test
    would run in a single task.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


# --- lots: one rectangle per customer --------------------------------------------------

LOTS_SQL = """
lot_base AS (
  SELECT c_custkey AS k, c_acctbal, c_mktsegment, n_name,
         CASE WHEN c_custkey % 50 = 11 THEN c_custkey - 1 ELSE c_custkey END AS ak,
         -71.5e0 + (c_custkey % 40) * 0.0012e0 AS x0,
         43.0e0 + (c_custkey // 40) * 0.0008e0 AS y0
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
lots AS (
  SELECT *,
         x0 + 0.0012e0 - (k % 3) * 0.0003e0 AS x1,
         y0 + 0.0008e0 - (k % 4) * 0.0001e0 AS y1,
         CASE WHEN k % 50 = 7 THEN '   ' WHEN k % 50 = 9 THEN NULL
              ELSE (100 + ak % 40 + 100 * (ak // 160)) || ' '
                   || ['OAK', 'Elm', 'Mountain View', 'St. Mary''s'][(ak // 40) % 4 + 1] || ' '
                   || ['ROAD', 'Rd', 'RD.', 'Road'][k % 4 + 1] END AS address,
         CASE WHEN k % 11 = 0 THEN NULL ELSE 100000e0 + 50e0 * c_acctbal END AS assessed_value,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'one fam'
              WHEN 'AUTOMOBILE' THEN 'Single Family Residential'
              WHEN 'MACHINERY' THEN 'vacant land' WHEN 'HOUSEHOLD' THEN 'Commercial' END AS raw_type,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Single Family'
              WHEN 'AUTOMOBILE' THEN 'Single Family'
              WHEN 'MACHINERY' THEN 'Vacant Land' WHEN 'HOUSEHOLD' THEN 'Commercial' END AS property_type
  FROM lot_base
)"""


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spread_out(table(spark, sf_dir, "customer"), "c_custkey").join(
        F.broadcast(table(spark, sf_dir, "nation")),  # 25 rows
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    k = F.col("k")
    base = base.select(
        F.col("c_custkey").alias("k"), "c_acctbal", "c_mktsegment", "n_name",
        F.expr("CASE WHEN c_custkey % 50 = 11 THEN c_custkey - 1 ELSE c_custkey END").alias("ak"),
        F.expr("-71.5e0 + (c_custkey % 40) * 0.0012e0").alias("x0"),
        F.expr("43.0e0 + (c_custkey div 40) * 0.0008e0").alias("y0"),
    )
    segment = F.col("c_mktsegment")

    def by_segment(*names: str | None) -> Column:
        value = F.lit(None).cast("string")
        for seg, name in zip(("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"), names):
            value = F.when(segment == seg, name).otherwise(value)
        return value

    number = F.expr("100 + ak % 40 + 100 * (ak div 160)").cast("string")
    address = F.concat_ws(
        " ", number, _pick(STREETS, F.expr("(ak div 40) % 4")), _pick(SUFFIXES, k % 4)
    )
    return base.select(
        "*",
        F.expr("x0 + 0.0012e0 - (k % 3) * 0.0003e0").alias("x1"),
        F.expr("y0 + 0.0008e0 - (k % 4) * 0.0001e0").alias("y1"),
        F.when(k % 50 == 7, "   ").when(k % 50 != 9, address).alias("address"),
        F.expr("CASE WHEN k % 11 <> 0 THEN 100000e0 + 50e0 * c_acctbal END").alias("assessed_value"),
        by_segment("one fam", "Single Family Residential", "vacant land", "Commercial").alias("raw_type"),
        by_segment("Single Family", "Single Family", "Vacant Land", "Commercial").alias("property_type"),
    )


# --- parcels: the lots, and one large tract per nation ----------------------------------

_AREA = "(x1 - x0) * (y1 - y0) * cos(radians({lat})) * 111320e0 * 111320e0 / 4046.8564224e0"
LOT_ACRES = _AREA.format(lat="(y0 + y1) / 2e0")
# The closing vertex counts in the mean latitude of the ring.
RING_ACRES = _AREA.format(lat="(3e0 * y0 + 2e0 * y1) / 5e0")

PARCELS_SQL = f"""
tracts AS (
  SELECT n_nationkey AS n, n_name,
         CASE WHEN n_nationkey = 24 THEN -73e0 ELSE -71.5001e0 END AS x0,
         CASE WHEN n_nationkey = 24 THEN 42e0 ELSE 43.0e0 + n_nationkey * 0.016e0 END AS y0
  FROM nation
),
parcel_boxes AS (
  SELECT 'NH:' || k AS property_id, n_name, CAST(k AS VARCHAR) AS parcel_id, address, x0, y0, x1, y1,
         CASE WHEN k % 19 <> 0 THEN {LOT_ACRES} END AS acreage, assessed_value, property_type
  FROM lots
  UNION ALL
  SELECT 'NH:T' || n, n_name, 'T' || n, CASE WHEN n % 3 <> 0 THEN 'TRACT ' || n END, x0, y0,
         CASE WHEN n = 24 THEN -70e0 ELSE x0 + 0.0485e0 END,
         CASE WHEN n = 24 THEN 44e0 ELSE y0 + 0.0155e0 END,
         NULL, NULL, CASE WHEN n % 2 = 0 THEN 'Common Land' END
  FROM tracts
),
parcels AS (
  SELECT property_id, 'NH' AS state, n_name AS municipality, parcel_id, address, n_name AS city,
         '03' || lpad(CAST(length(parcel_id) AS VARCHAR), 3, '0') AS zip,
         (y0 + y1) / 2e0 AS latitude, (x0 + x1) / 2e0 AS longitude, acreage, assessed_value,
         property_type, x0, y0, x1, y1, {RING_ACRES} AS ring_acres, (y0 + y1) / 2e0 AS cy,
         (x0 + x1) / 2e0 AS cx
  FROM parcel_boxes
)"""


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lot_rows = lots(spark, sf_dir).select(
        F.expr("'NH:' || k").alias("property_id"), "n_name",
        F.col("k").cast("string").alias("parcel_id"), "address", "x0", "y0", "x1", "y1",
        F.expr(f"CASE WHEN k % 19 <> 0 THEN {LOT_ACRES} END").alias("acreage"),
        "assessed_value", "property_type",
    )
    tracts = (
        table(spark, sf_dir, "nation")
        .select(
            F.col("n_nationkey").alias("n"), "n_name",
            F.expr("CASE WHEN n_nationkey = 24 THEN -73e0 ELSE -71.5001e0 END").alias("x0"),
            F.expr("CASE WHEN n_nationkey = 24 THEN 42e0 ELSE 43.0e0 + n_nationkey * 0.016e0 END").alias("y0"),
        )
        .selectExpr(
            "'NH:T' || n AS property_id", "n_name", "'T' || n AS parcel_id",
            "CASE WHEN n % 3 <> 0 THEN 'TRACT ' || n END AS address", "x0", "y0",
            "CASE WHEN n = 24 THEN -70e0 ELSE x0 + 0.0485e0 END AS x1",
            "CASE WHEN n = 24 THEN 44e0 ELSE y0 + 0.0155e0 END AS y1",
            "CAST(NULL AS DOUBLE) AS acreage", "CAST(NULL AS DOUBLE) AS assessed_value",
            "CASE WHEN n % 2 = 0 THEN 'Common Land' END AS property_type",
        )
    )
    return lot_rows.unionByName(tracts).select(
        "property_id", F.lit("NH").alias("state"), F.col("n_name").alias("municipality"),
        "parcel_id", "address", F.col("n_name").alias("city"),
        F.expr("'03' || lpad(length(parcel_id), 3, '0')").alias("zip"),
        F.expr("(y0 + y1) / 2e0").alias("latitude"), F.expr("(x0 + x1) / 2e0").alias("longitude"),
        "acreage", "assessed_value", "property_type",
        rectangle("x0", "y0", "x1", "y1").alias("geometry"),
    )


# --- listings: one per order, a point on or beside the customer's lot --------------------

LISTINGS_SQL = """
listings AS (
  SELECT 'L' || o_orderkey AS listing_id,
         upper(address) || ', ' || n_name || ', NH' AS formatted_address,
         upper(address) AS address_line_1, n_name AS city,
         CASE WHEN o_orderkey % 13 = 0 THEN 'VT' WHEN o_orderkey % 11 = 0 THEN 'nh' ELSE 'NH' END AS state,
         '03' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS zip_code,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE y0 + 0.6e0 * (y1 - y0) END AS latitude,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN x0 + 0.0011e0
              ELSE x0 + 0.4e0 * (x1 - x0) END AS longitude,
         CASE WHEN o_orderkey % 7 = 0 THEN 'Condo' WHEN o_orderkey % 5 = 0 THEN 'Land'
              ELSE 'Single Family' END AS property_type,
         CASE WHEN o_orderkey % 3 <> 0 THEN 43560e0 END AS lot_size,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(1950 + o_orderkey % 80 AS INTEGER) END AS year_built,
         CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Sold' ELSE 'Pending' END AS status,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0e0
              ELSE o_totalprice END AS price,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS listed_date,
         o_orderkey AS o, k
  FROM orders JOIN lots ON o_custkey = k
)"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    joined = orders.join(lots(spark, sf_dir), F.col("o_custkey") == F.col("k"))
    return joined.selectExpr(
        "'L' || o_orderkey AS listing_id",
        "upper(address) || ', ' || n_name || ', NH' AS formatted_address",
        "upper(address) AS address_line_1",
        "n_name AS city",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'VT' WHEN o_orderkey % 11 = 0 THEN 'nh' ELSE 'NH' END AS state",
        "'03' || lpad(k % 1000, 3, '0') AS zip_code",
        "CASE WHEN o_orderkey % 29 <> 0 THEN y0 + 0.6e0 * (y1 - y0) END AS latitude",
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN x0 + 0.0011e0 "
        "ELSE x0 + 0.4e0 * (x1 - x0) END AS longitude",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'Condo' WHEN o_orderkey % 5 = 0 THEN 'Land' "
        "ELSE 'Single Family' END AS property_type",
        "CASE WHEN o_orderkey % 3 <> 0 THEN 43560e0 END AS lot_size",
        "CASE WHEN o_orderkey % 19 <> 0 THEN CAST(1950 + o_orderkey % 80 AS INT) END AS year_built",
        "CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Sold' ELSE 'Pending' END AS status",
        "CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0e0 "
        "ELSE o_totalprice END AS price",
        "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS listed_date",
        "CAST(1000 + o_orderkey % 3000 AS DOUBLE) AS square_footage",
        "o_orderkey AS o",
    )


# --- assessments and the parcel features they belong to -----------------------------------

ASSESSMENTS_SQL = """
nh_parcels AS (
  SELECT k, CAST(k AS VARCHAR) || '-' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '000-'
            || CASE WHEN k % 10 = 3 THEN '3B' ELSE '00' END AS pid_text,
         address AS street_address, n_name AS town
  FROM lots
),
assessments AS (
  SELECT CAST(k AS VARCHAR) AS pid, upper(address) AS location,
         CAST(CAST(floor(assessed_value) AS BIGINT) AS VARCHAR) AS total_market_value,
         CASE WHEN k % 19 = 0 THEN 'x/y'
              ELSE k || '/ ' || k % 1000 || '/ 000/'
                   || CASE WHEN k % 10 = 3 THEN '0003B/' ELSE '00 00000/' END END AS mblu,
         CAST(k % 7 AS VARCHAR) AS acres, raw_type AS land_use_desc, copy
  FROM lots, (SELECT 0 AS copy UNION ALL SELECT 1) copies
  WHERE k % 17 <> 0 AND (copy = 0 OR k % 13 = 0)
)"""


def nh_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lots(spark, sf_dir).selectExpr(
        "k",
        "k || '-' || lpad(k % 1000, 3, '0') || '000-' || CASE WHEN k % 10 = 3 THEN '3B' ELSE '00' END AS PID",
        "address AS StreetAddress",
        "n_name AS Town",
    )


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lots(spark, sf_dir).where("k % 17 <> 0").selectExpr(
        "*", "explode(CASE WHEN k % 13 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    )
    return rows.selectExpr(
        "CAST(k AS STRING) AS pid",
        "upper(address) AS location",
        "CAST(CAST(floor(assessed_value) AS BIGINT) AS STRING) AS total_market_value",
        "CASE WHEN k % 19 = 0 THEN 'x/y' ELSE k || '/ ' || k % 1000 || '/ 000/' "
        "|| CASE WHEN k % 10 = 3 THEN '0003B/' ELSE '00 00000/' END END AS mblu",
        "CAST(k % 7 AS STRING) AS acres",
        "raw_type AS land_use_desc",
        "copy",
    )


# --- the response cache ---------------------------------------------------------------------

# A request repeats per (event type, user); the first of each is cached for six hours.
CACHE_SQL = """
requests AS (
  SELECT event_id, ts, event_type AS endpoint,
         sha256('kind=' || event_type || '&user=' || user_id || '&') AS request_key, user_id
  FROM events
),
cache AS (
  SELECT 'feed' AS source, endpoint, request_key, min(event_id) AS response_id,
         min(ts) AS fetched_at,
         CASE WHEN user_id % 5 <> 0 THEN min(ts) + INTERVAL 6 HOUR END AS expires_at,
         CAST(user_id % 3 AS INTEGER) AS hit_count
  FROM requests WHERE user_id % 4 <> 0
  GROUP BY endpoint, request_key, user_id
)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.create_map(
            F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type")
        ).alias("params"),
        "user_id",
    )


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cache_requests(requests(spark, sf_dir), "feed").where("user_id % 4 <> 0")
    grouped = rows.groupBy("source", "endpoint", "request_key", "user_id").agg(
        F.min("ts").alias("fetched_at"), F.min("event_id").alias("response_id")
    )
    return grouped.select(
        "source", "endpoint", "request_key",
        F.lit("{}").alias("request_params"),
        F.expr("'{\"id\":' || response_id || '}'").alias("response_body"),
        F.lit(200).alias("status_code"), "fetched_at",
        F.expr("CASE WHEN user_id % 5 <> 0 THEN fetched_at + INTERVAL 6 HOURS END").alias("expires_at"),
        F.expr("CAST(user_id % 3 AS INT)").alias("hit_count"),
        F.lit(None).cast("timestamp").alias("last_hit_at"),
    )


# --- SQL pieces shared by oracles -------------------------------------------------------------

PRELUDE = ",".join([LOTS_SQL, PARCELS_SQL, LISTINGS_SQL, ASSESSMENTS_SQL, CACHE_SQL])


def with_frames(body: str, *extra: str) -> str:
    """A full oracle query: the frames above, extra CTEs, then ``body``."""
    return f"WITH {','.join([PRELUDE, *extra])}\n{body}"


def words_sql(expr: str) -> str:
    text = rf"trim(regexp_replace(regexp_replace(upper({expr}), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    return f"string_split({text}, ' ')"


def swap_sql(words: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items())
    return f"[CASE w {cases} ELSE w END FOR w IN {words}]" if mapping else words


def address_sql(expr: str) -> str:
    """``normalize_address`` for the ASCII addresses of the frames."""
    return f"coalesce(array_to_string({swap_sql(words_sql(expr), fixed.STREET_WORDS)}, ' '), '')"


def street_sql(expr: str) -> str:
    return f"regexp_replace({address_sql(expr)}, '^[0-9]+( |$)', '')"


# --- stored tables ------------------------------------------------------------------------------

_STORED: dict[tuple[str, str], str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder."""
    return f"{shared_folder(spark)}/checks/{uuid.uuid4().hex}"


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived frame as an ingest leaves it: written to Parquet, once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}")
    if key not in _STORED:
        path = scratch(spark)
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def stored_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "parcels", lambda: index_parcels(parcels(spark, sf_dir)))


def stored_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "listings", lambda: listings(spark, sf_dir))


def parcel_tiles(spark: SparkSession, sf_dir: str) -> ParcelTiles:
    """The parcels as an ingest stores them by place, once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/parcel_tiles")
    if key not in _STORED:
        path = scratch(spark)
        write_tiles(index_parcels(parcels(spark, sf_dir)), path)
        _STORED[key] = path
    return ParcelTiles.read(spark, _STORED[key])
