"""Sources, normalisers, linkage, checks, upserts, cache and lookups over the derived frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.column_queries import variants_sql
from checks.registry import joined, query, r6
from parcel_comps import fixed_values as fixed
from parcel_comps import schemas
from parcel_comps.functions.geometry import point_geojson, to_multipolygon
from parcel_comps.operators import linkage as K
from parcel_comps.operators import lookup as L
from parcel_comps.operators import normalize as N
from parcel_comps.operators import quality as Q
from parcel_comps.operators import store as P
from parcel_comps.operators.spatial import eligible_listings
from parcel_comps.plans.ingest import ingest_listings, ingest_parcels, link_features, normalize_parcels
from parcel_comps.plans.versions import VersionedTable
from parcel_comps.sources import collections as Rl
from parcel_comps.sources import readers as R
from parcel_comps.sources import writers as Wr

def today() -> Column:
    return F.lit(dt.date(2025, 1, 2))


def now() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


# --- raw features ------------------------------------------------------------------------------

_CT_SQL = """
ct AS (
  SELECT k, CASE k % 10 WHEN 0 THEN 'MISMATCH' WHEN 1 THEN '' ELSE 'P' || k END AS parcel_id, 9000 + k AS objectid,
         CASE WHEN k % 12 <> 0 THEN n_name END AS town_name, CASE WHEN k % 4 = 0 THEN '' ELSE 'City ' || k % 5 END AS city,
         address, c_acctbal, raw_type, x0, y0, x1, y1
  FROM lots
)"""


def _doc(geometry: Column, properties: Column, name: str = "properties") -> Column:
    return F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias(name))


def ct_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).withColumn("g", fx.rectangle("x0", "y0", "x1", "y1"))
    properties = F.to_json(F.struct(
        F.expr("CASE k % 10 WHEN 0 THEN 'MISMATCH' WHEN 1 THEN '' ELSE 'P' || k END").alias("Parcel_ID"),
        F.expr("9000 + k").alias("OBJECTID"),
        F.expr("CASE WHEN k % 12 <> 0 THEN n_name END").alias("Town_Name"),
        F.col("address").alias("Location_1"),
        F.expr("CASE WHEN k % 4 = 0 THEN '' ELSE 'City ' || k % 5 END").alias("Property_City"),
        F.expr("k % 9").alias("Land_Acres"),
        F.col("c_acctbal").alias("Assessed_Total"),
        F.expr("2000 + k % 20").alias("Valuation_Year"),
        F.expr("CASE WHEN k % 5 = 0 THEN -2209161600000 ELSE k * 86400000L END").alias("Sale_Date"),
        F.expr("CASE WHEN k % 3 <> 0 THEN k % 4 END").alias("Number_of_Baths"),
        F.expr("CASE WHEN k % 6 <> 0 THEN k % 2 END").alias("Number_of_Half_Baths"),
        F.expr("1950 + k % 70").alias("ayb"),
        F.col("raw_type").alias("State_Use_Description"),
    ))
    return rows.select(
        properties.alias("properties"), F.to_json(to_multipolygon("g")).alias("geometry"),
        F.lit("lots").alias("_file"), F.col("k").alias("_pos"),
    )


_CT_TYPE = """CASE raw_type WHEN 'one fam' THEN 'Single Family' WHEN 'Single Family Residential' THEN 'Single Family'
  WHEN 'vacant land' THEN 'Vacant Land' ELSE raw_type END"""


@query("normalize_ct", fx.with_frames(f"""
SELECT k AS pos, 'CT:' || nullif(parcel_id, '') AS property_id, coalesce(town_name, 'Bristol') AS municipality,
       coalesce(nullif(city, ''), town_name, 'Bristol') AS city, CAST(k % 9 AS DOUBLE) AS acreage,
       c_acctbal AS assessed_value, CAST(2000 + k % 20 AS INTEGER) AS assessment_year,
       CASE WHEN k % 5 <> 0 THEN DATE '1970-01-01' + CAST(k AS INTEGER) END AS last_sale_date,
       CASE WHEN k % 3 <> 0 OR k % 6 <> 0
            THEN coalesce(CASE WHEN k % 3 <> 0 THEN k % 4 END, 0) + 0.5e0 * coalesce(CASE WHEN k % 6 <> 0 THEN k % 2 END, 0) END AS bathrooms,
       {_CT_TYPE} AS property_type, round((3 * y0 + 2 * y1) / 5e0, 9) AS latitude
FROM ct""", _CT_SQL))
def normalize_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.normalize_ct(ct_features(spark, sf_dir), R.type_mapping(spark), "Bristol", source_date=today())
    return rows.select(
        F.col("_pos").alias("pos"), "property_id", "municipality", "city", "acreage", "assessed_value",
        "assessment_year", "last_sale_date", "bathrooms", "property_type", F.round("latitude", 9).alias("latitude"),
    )


@query("disambiguate_ids", fx.with_frames("""
SELECT k AS pos, CASE WHEN count(*) OVER (PARTITION BY coalesce(town_name, 'Bristol'), pid) > 1 AND pid IS NOT NULL
                      THEN pid || '#OBJECTID' || objectid ELSE pid END AS property_id
FROM (SELECT *, 'CT:' || nullif(parcel_id, '') AS pid FROM ct)""", _CT_SQL))
def disambiguate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_parcels(ct_features(spark, sf_dir), "CT", R.type_mapping(spark), "Bristol", today())
    return rows.select(F.col("_pos").alias("pos"), "property_id")


@query("validate_records", fx.with_frames("""
SELECT count(*) AS records, count(*) FILTER (parcel_id = '') AS no_parcel_id,
       0 AS no_geometry FROM ct""", _CT_SQL))
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.normalize_ct(ct_features(spark, sf_dir), R.type_mapping(spark), "Bristol", source_date=today())
    return Q.validate_records(rows)


@query("town_counts", fx.with_frames("""
SELECT t.town, count(c.k) AS records, count(c.k) = 0 AS empty_town
FROM (SELECT n_name AS town FROM nation UNION ALL SELECT 'Nowhere') t
LEFT JOIN lots c ON c.n_name = t.town GROUP BY t.town"""))
def town_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    towns = fx.table(spark, sf_dir, "nation").select(F.col("n_name").alias("town"))
    towns = towns.unionByName(spark.range(1).select(F.lit("Nowhere").alias("town")))
    rows = fx.lots(spark, sf_dir).select(F.col("n_name").alias("town"))
    return Q.town_counts(rows, towns, ["town"])


@query("fill_schema", fx.with_frames("""
SELECT property_id, address, CAST(NULL AS VARCHAR) AS source_url, CAST(NULL AS DOUBLE) AS bedrooms FROM parcels"""))
def fill_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.fill_schema(fx.parcels(spark, sf_dir).select("address", "property_id"))
    return rows.select("property_id", "address", "source_url", "bedrooms")


@query("normalize_ma", fx.with_frames("""
SELECT 'MA:' || k AS property_id, k || ' ' || n_name || ' Unit' AS address, n_name AS city, '0' || (1000 + k % 100) AS zip,
       round(CASE k % 4 WHEN 0 THEN CAST(k % 9 AS DOUBLE) WHEN 1 THEN k % 9 / 43560e0 END, 8) AS acreage,
       CASE k % 3 WHEN 0 THEN 0e0 WHEN 1 THEN CAST(k AS DOUBLE) ELSE 7e0 END AS building_sqft,
       CASE WHEN k % 5 <> 0 THEN DATE '2006-08-02' END AS last_sale_date,
       CAST(NULL AS DOUBLE) AS bedrooms, round((3 * x0 + 2 * x1) / 5e0, 9) AS longitude
FROM lots"""))
def normalize_ma(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).withColumn("g", fx.rectangle("x0", "y0", "x1", "y1"))
    attributes = F.to_json(F.struct(
        F.col("k").cast("string").alias("LOC_ID"), F.col("n_name").alias("CITY"),
        F.expr("'0' || (1000 + k % 100)").alias("ZIP"), F.col("k").alias("ADDR_NUM"),
        F.col("n_name").alias("FULL_STR"), F.lit(" Unit ").alias("LOCATION"), F.lit("x").alias("SITE_ADDR"),
        F.expr("k % 9").alias("LOT_SIZE"),
        F.expr("CASE k % 4 WHEN 0 THEN 'Acres' WHEN 1 THEN 'SQ FT' WHEN 2 THEN 'rods' END").alias("LOT_UNITS"),
        F.expr("CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN k END").alias("RES_AREA"), F.lit(7).alias("BLD_AREA"),
        F.expr("CASE WHEN k % 5 = 0 THEN '00000000' ELSE '20060802' END").alias("LS_DATE"),
        F.col("raw_type").alias("USE_DESC"),
    ))
    outer = F.get_json_object(F.to_json(to_multipolygon("g")), "$.coordinates[0]")
    features = rows.select(
        attributes.alias("properties"), F.concat(F.lit('{"rings":'), outer, F.lit("}")).alias("geometry")
    )
    out = N.normalize_ma(features, R.type_mapping(spark), source_date=today())
    return out.select(
        "property_id", "address", "city", "zip", F.round("acreage", 8).alias("acreage"), "building_sqft",
        "last_sale_date", "bedrooms", F.round("longitude", 9).alias("longitude"),
    )


def nh_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.nh_parcels(spark, sf_dir).join(
        fx.lots(spark, sf_dir).select("k", fx.rectangle("x0", "y0", "x1", "y1").alias("g")), "k"
    )
    return rows.select(
        F.to_json(F.struct("PID", "Town", "StreetAddress")).alias("properties"),
        F.to_json(to_multipolygon("g")).alias("geometry"),
    )


# Assessments by key and by address; anything held twice matches nothing.
LINK_SQL = f"""
a_keys AS (
  SELECT *, CASE WHEN mblu <> 'x/y' THEN CAST(pid AS BIGINT) END AS key, {fx.address_sql('location')} AS addr FROM assessments
),
one_key AS (SELECT key FROM a_keys WHERE key IS NOT NULL GROUP BY key HAVING count(*) = 1),
one_addr AS (SELECT addr FROM a_keys WHERE addr <> '' GROUP BY addr HAVING count(*) = 1),
linked AS (
  SELECT p.k, p.pid_text, p.street_address, p.town, coalesce(m.total_market_value, a.total_market_value) AS total_market_value,
         coalesce(m.location, a.location) AS vgsi_location, coalesce(m.mblu, a.mblu) AS mblu, m.pid AS by_key, a.pid AS by_addr,
         CASE WHEN m.pid IS NOT NULL THEN m.land_use_desc ELSE a.land_use_desc END AS land_use_desc,
         CASE WHEN m.pid IS NOT NULL THEN 'mblu' WHEN a.pid IS NOT NULL THEN 'address' END AS match_method
  FROM nh_parcels p
  LEFT JOIN (SELECT * FROM a_keys SEMI JOIN one_key USING (key)) m ON m.key = p.k
  LEFT JOIN (SELECT * FROM a_keys SEMI JOIN one_addr USING (addr)) a
         ON m.pid IS NULL AND a.addr = {fx.address_sql('p.street_address')}
)"""


@query("link_assessments", fx.with_frames("""
SELECT k, CASE WHEN by_key IS NOT NULL THEN by_key ELSE by_addr END IS NOT NULL AS found, total_market_value,
       vgsi_location, match_method FROM linked""", LINK_SQL))
def link_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = K.link_assessments(fx.nh_parcels(spark, sf_dir), fx.assessments(spark, sf_dir))
    return linked.select(
        "k", F.col("match_method").isNotNull().alias("found"), "total_market_value", "vgsi_location", "match_method"
    )


@query("link_assessments_inner", fx.with_frames(
    "SELECT k, mblu, match_method FROM linked WHERE match_method IS NOT NULL", LINK_SQL))
def link_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = K.link_assessments(fx.nh_parcels(spark, sf_dir), fx.assessments(spark, sf_dir), how="inner")
    return linked.select("k", "mblu", "match_method")


@query("match_report", fx.with_frames("""
SELECT count(*) AS total_parcels, count(*) FILTER (match_method = 'mblu') AS matched_mblu,
       count(*) FILTER (match_method = 'address') AS matched_address,
       count(*) FILTER (match_method IS NULL) AS unmatched, round(count(match_method) / count(*), 6) AS match_rate,
       count(match_method) / count(*) < 0.8e0 AS low_match_rate,
       (SELECT string_agg(pid_text, '|' ORDER BY pid_text) FROM
          (SELECT pid_text FROM linked WHERE match_method IS NULL ORDER BY pid_text LIMIT 10)) AS sample
FROM linked""", LINK_SQL))
def match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = K.link_assessments(fx.nh_parcels(spark, sf_dir), fx.assessments(spark, sf_dir))
    report = K.match_report(linked)
    return report.withColumn("match_rate", r6("match_rate")).withColumn(
        "sample", joined("sample_unmatched")
    ).drop("sample_unmatched")


@query("normalize_nh", fx.with_frames("""
SELECT 'NH:' || pid_text AS property_id, coalesce(vgsi_location, street_address) AS address, town AS city,
       TRY_CAST(total_market_value AS DOUBLE) AS assessed_value, land_use_desc AS property_type,
       CAST(NULL AS INTEGER) AS year_built FROM linked""", LINK_SQL))
def normalize_nh(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = link_features(nh_features(spark, sf_dir), fx.assessments(spark, sf_dir))
    return N.normalize_nh(features, source_date=today()).select(
        "property_id", "address", "city", "assessed_value", "property_type", "year_built"
    )


@query("unique_index", fx.with_frames("""
SELECT key, min(copy) AS copy FROM (SELECT *, CASE WHEN mblu <> 'x/y' THEN mblu END AS key FROM assessments)
WHERE key IS NOT NULL GROUP BY key HAVING count(*) = 1"""))
def unique_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("mblu") != "x/y", F.col("mblu"))
    return K.unique_index(fx.assessments(spark, sf_dir), key).select("key", "copy")


@query("collision_report", fx.with_frames("""
SELECT count(*) AS colliding_keys, CAST(sum(n) AS BIGINT) AS affected_rows,
       (SELECT string_agg(mblu, '|' ORDER BY mblu) FROM (SELECT mblu FROM c ORDER BY mblu LIMIT 5)) AS sample FROM c""",
    "c AS (SELECT mblu, count(*) AS n FROM assessments GROUP BY mblu HAVING count(*) > 1)"))
def collision_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = K.collision_report(fx.assessments(spark, sf_dir), F.col("mblu"))
    return report.select("colliding_keys", "affected_rows", joined("sample_keys").alias("sample"))


@query("missing_addresses", fx.with_frames(f"""
SELECT address_key, arg_min(trim(street_address), k) AS address
FROM (SELECT *, {fx.address_sql('street_address')} AS address_key FROM nh_parcels)
WHERE address_key <> '' AND address_key NOT IN (SELECT {fx.address_sql('location')} FROM assessments)
GROUP BY address_key"""))
def missing_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.missing_addresses(fx.nh_parcels(spark, sf_dir), fx.assessments(spark, sf_dir), ["k"])


_LONG = {v: k for k, v in fixed.STREET_WORDS.items()}
_SEARCH_SQL = f"""
spelled AS (
  SELECT k, address, array_to_string({fx.swap_sql(fx.words_sql('address'), _LONG)}, ' ') AS spelled_out
  FROM lots
),
asked AS (SELECT * FROM spelled WHERE trim(address) <> ''),
results AS (
  SELECT address AS query, 0 AS position, address || ' EXT' AS value, k * 10 AS id FROM asked WHERE k % 3 > 0
  UNION ALL SELECT address, 1, address || ' NORTH', k * 10 + 1 FROM asked WHERE k % 3 = 2
  UNION ALL SELECT address, 2, upper(address), k * 10 + 2 FROM asked WHERE k % 3 = 2 AND k % 2 = 0
  UNION ALL SELECT spelled_out, 0, spelled_out, k * 10 + 5 FROM asked WHERE k % 3 = 2 AND k % 5 = 0 AND spelled_out <> address
),
variants AS (
  SELECT address, unnest(vs) AS variant, generate_subscripts(vs, 1) AS no FROM (
    SELECT address, [address] || list_filter([v FOR v, i IN sp IF list_position(sp, v) = i], lambda v: v <> sp[1]) AS vs
    FROM (SELECT address, {variants_sql('address')} AS sp FROM spelled))
),
answered AS (
  SELECT v.address, v.variant, v.no, count(*) AS n,
         arg_min(r.id, r.position) FILTER ({fx.address_sql('r.value')} = {fx.address_sql('r.query')}) AS exact_id,
         arg_min(r.id, r.position) AS first_id, string_agg(r.value, '|' ORDER BY r.position) AS texts
  FROM variants v JOIN results r ON r.query = v.variant GROUP BY v.address, v.variant, v.no
),
picked AS (
  SELECT s.address, arg_min(coalesce(exact_id, first_id), no) FILTER (exact_id IS NOT NULL OR n = 1) AS clear_id,
         arg_min(variant, no) FILTER (exact_id IS NOT NULL OR n = 1) AS clear_variant,
         arg_min(first_id, no) AS any_id, arg_min(variant, no) AS any_variant, arg_min(texts, no) AS texts
  FROM spelled s LEFT JOIN answered a ON a.address = s.address GROUP BY s.address
),
lookups AS (
  SELECT address, CASE WHEN clear_id IS NOT NULL THEN 'ok' WHEN any_id IS NOT NULL THEN 'ambiguous' ELSE 'no_match' END AS status,
         coalesce(clear_id, any_id) AS id, nullif(coalesce(clear_variant, any_variant), address) AS via,
         CASE WHEN clear_id IS NULL THEN texts END AS candidates FROM picked
)"""


def _lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).select("k", "address")
    words = F.split(F.regexp_replace(F.upper("address"), r"[^\w\s]", " "), r"\s+")
    long = F.create_map(*[F.lit(x) for pair in _LONG.items() for x in pair])
    spelled = F.array_join(F.filter(F.transform(words, lambda w: F.coalesce(F.try_element_at(long, w), w)),
                                    lambda w: w != ""), " ")
    rows = rows.withColumn("spelled_out", spelled)
    answers = F.array_compact(F.array(
        F.when(F.expr("k % 3 > 0"), F.expr("struct(address AS query, 0 AS position, address || ' EXT' AS value, k * 10 AS id)")),
        F.when(F.expr("k % 3 = 2"), F.expr("struct(address AS query, 1 AS position, address || ' NORTH' AS value, k * 10 + 1 AS id)")),
        F.when(F.expr("k % 3 = 2 AND k % 2 = 0"), F.expr("struct(address AS query, 2 AS position, upper(address) AS value, k * 10 + 2 AS id)")),
        F.when(F.expr("k % 3 = 2 AND k % 5 = 0 AND spelled_out <> address"),
               F.expr("struct(spelled_out AS query, 0 AS position, spelled_out AS value, k * 10 + 5 AS id)")),
    ))
    # Nobody asks the search service for a blank address.
    return K.choose_lookup(rows, rows.where("trim(address) <> ''").select(F.inline(answers)))


@query("choose_lookup", fx.with_frames("SELECT address, status, id, via, candidates FROM lookups", _SEARCH_SQL))
def choose_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookups(spark, sf_dir).select("address", "status", "id", "via", joined("candidates").alias("candidates"))


@query("lookup_report", fx.with_frames("""
SELECT s.status, count(l.status) AS lookups FROM (VALUES ('ok'), ('ambiguous'), ('no_match')) s(status)
LEFT JOIN lookups l ON l.status = s.status GROUP BY s.status""", _SEARCH_SQL))
def lookup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.lookup_report(_lookups(spark, sf_dir))


@query("attach_by_id", fx.with_frames("""
SELECT p.k, a.land_use_desc, a.copy FROM nh_parcels p
LEFT JOIN (SELECT CAST(pid AS BIGINT) AS k, arg_max(land_use_desc, copy) FILTER (true) AS land_use_desc, max(copy) AS copy
           FROM (SELECT pid, copy, coalesce(land_use_desc, '-') AS land_use_desc FROM assessments) GROUP BY pid) a ON a.k = p.k"""))
def attach_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.nh_parcels(spark, sf_dir).select("k", F.concat(F.lit(" "), F.col("k").cast("string")).alias("pid"))
    values = fx.assessments(spark, sf_dir).withColumn("land_use_desc", F.coalesce("land_use_desc", F.lit("-")))
    return K.attach_by_id(rows, values, "pid", ["land_use_desc", "copy"], ["copy"]).drop("pid")


@query("combine_sources", fx.with_frames("""
SELECT pid, copy, CASE WHEN copy = 0 THEN 'sequential' ELSE 'targeted' END AS match_source FROM assessments"""))
def combine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.assessments(spark, sf_dir)
    return K.combine_sources(rows.where("copy = 0"), rows.where("copy = 1")).select("pid", "copy", "match_source")


# --- pages ------------------------------------------------------------------------------------------


def _strip_sql(html: str) -> str:
    text = f"regexp_replace({html}, '(?s)<!--.*?-->', chr(10), 'g')"
    text = f"regexp_replace({text}, '(?is)<(script|style)[^>]*>.*?</(script|style)\\s*>', chr(10), 'g')"
    text = f"regexp_replace({text}, '(?s)<[^>]*>', chr(10), 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


@query("page_text", f"""
SELECT page_id, md5(t) AS digest, length(t) AS n FROM (SELECT page_id, {_strip_sql('html')} AS t FROM pages)""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fx.table(spark, sf_dir, "pages").select("page_id", N.page_text(F.col("html")).alias("t"))
    return text.select("page_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n"))


@query("extract_assessment", fx.with_frames("""
SELECT CASE WHEN k % 6 = 0 THEN CAST(k AS VARCHAR) ELSE CAST(50000 + k AS VARCHAR) END AS pid,
       -- an empty field gives the label that follows it
       CASE WHEN trim(address) = '' THEN 'Mblu' ELSE trim(address) END AS location,
       CAST(1000000 + k AS VARCHAR) AS total_market_value, CAST(k % 9 AS VARCHAR) || '.25' AS acres,
       CASE coalesce(raw_type, 'Odd Use') WHEN 'one fam' THEN 'Single Family' WHEN 'Single Family Residential' THEN 'Single Family'
            WHEN 'vacant land' THEN 'Vacant Land' ELSE coalesce(raw_type, 'Odd Use') END AS land_use_desc,
       k || '/ 12/ 000/00 ' AS mblu
FROM lots WHERE k % 8 <> 0
UNION ALL SELECT CAST(page_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL FROM pages WHERE contains(""" + _strip_sql("html") + ", 'Total Market Value')"))
def extract_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir)
    value = "substr(CAST(1000000 + k AS STRING), 1, 1) || ',' || substr(CAST(1000000 + k AS STRING), 2, 3) || ',' || substr(CAST(1000000 + k AS STRING), 5, 3)"
    html = f"""'<html><head><style>p {{}}</style><script>Location = 1;</script></head><body><!-- x --><h1>Description</h1>
      <p>wrong</p>' || coalesce('<span>Location</span><b> ' || address || ' </b>', '') || '<table><tr><td>Mblu</td><td>' || k || '/ 12/ 000/00 A</td></tr>'
      || CASE WHEN k % 8 <> 0 THEN '<td>Total Market Value</td><td>$' || {value} || '</td>' ELSE '' END
      || CASE WHEN k % 6 <> 0 THEN '<td>PID</td><td>' || (50000 + k) || '</td>' ELSE '' END
      || '<h2>Land Use</h2><td>Size (Acres)</td><td>' || k % 9 || '.25</td><td>Description</td><td>' || coalesce(raw_type, 'Odd Use')
      || '</td></body></html>'"""
    # The given pages are read as well; they are no parcel records.
    pages = rows.selectExpr("k AS page_id", f"{html} AS html").unionAll(fx.table(spark, sf_dir, "pages").select("page_id", "html"))
    out = N.extract_assessment(pages, R.type_mapping(spark))
    return out.select("pid", "location", "total_market_value", "acres", "land_use_desc", "mblu")


# --- files ------------------------------------------------------------------------------------------


def _feature_pages(spark: SparkSession, sf_dir: str) -> list[str]:
    """Files of FeatureCollections."""
    rows = fx.lots(spark, sf_dir).select(
        "k", F.expr("k div 500").alias("page"),
        _doc(to_multipolygon(fx.rectangle("x0", "y0", "x1", "y1")), F.struct("k", "n_name")).alias("feature"),
    )
    # Pages of 500 features, as a paged feed lands them.
    docs = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("k", "feature"))).alias("fs"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                              F.transform("fs", lambda e: e["feature"]).alias("features")))
    folder = fx.scratch(spark)
    docs.select("page", text.alias("value")).write.partitionBy("page").text(folder)
    files = [f"{folder}/page={r.page}" for r in spark.read.text(folder).select("page").distinct().collect()]
    return [f for d in files for f in R.expand_paths(spark, d, [".txt"])]


def _feature_rows(features: DataFrame) -> DataFrame:
    props = F.from_json("properties", "k bigint, n_name string")
    return features.select(
        props["k"].alias("k"), F.col("_pos").alias("pos"), props["n_name"].alias("town"),
        F.get_json_object("geometry", "$.type").alias("kind"),
    )


_FEATURE_SQL = fx.with_frames("""
SELECT k, k % 500 AS pos, n_name AS town, 'MultiPolygon' AS kind FROM lots""")


@query("read_features", _FEATURE_SQL)
def read_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_rows(R.read_features(spark, _feature_pages(spark, sf_dir)))


@query("read_large_features", _FEATURE_SQL)
def read_large_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_rows(Rl.read_large_features(spark, _feature_pages(spark, sf_dir)))


@query("write_features", fx.with_frames("""
SELECT property_id, municipality, assessed_value, lower(municipality) AS town, round(x0, 6) AS x FROM parcels"""))
def write_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.scratch(spark)
    Wr.write_features(N.fill_schema(fx.parcels(spark, sf_dir)), folder)
    back = R.read_features(spark, folder, one_per_line=True)
    props = F.from_json("properties", schemas.PARCEL_RECORD)
    return back.select(
        props["property_id"].alias("property_id"), props["municipality"].alias("municipality"),
        props["assessed_value"].alias("assessed_value"),
        F.regexp_extract("_file", "town=([^/]*)", 1).alias("town"),
        r6(F.get_json_object("geometry", "$.coordinates[0][0][0][0]").cast("double")).alias("x"),
    )


@query("write_feature_layers", fx.with_frames("""
SELECT id, layer, kind FROM (
  SELECT 'p' || k AS id, 'points' AS layer, 'Point' AS kind FROM lots
  UNION ALL SELECT 'g' || k, 'polygons', 'MultiPolygon' FROM lots
  UNION ALL SELECT 'l' || k, 'lines', 'LineString' FROM lots
  UNION ALL SELECT 'm' || k, 'other', CASE WHEN k % 2 = 0 THEN 'MultiPoint' END FROM lots)"""))
def write_feature_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).withColumn("g", to_multipolygon(fx.rectangle("x0", "y0", "x1", "y1")))
    polygon = F.when(
        F.col("k") % 2 == 0,
        F.concat(F.lit('{"type":"Polygon","coordinates":'), F.get_json_object(F.to_json("g"), "$.coordinates[0]"), F.lit("}")),
    ).otherwise(F.to_json("g"))
    line = F.expr("""'{"type":"LineString","coordinates":[[' || x0 || ',' || y0 || '],[' || x1 || ',' || y1 || ']]}'""")
    k = F.col("k").cast("string")
    features = rows.select(F.inline(F.array(
        F.struct(F.concat(F.lit("p"), k).alias("id"), F.to_json(point_geojson("x0", "y0")).alias("geometry")),
        F.struct(F.concat(F.lit("g"), k).alias("id"), polygon.alias("geometry")),
        F.struct(F.concat(F.lit("l"), k).alias("id"), line.alias("geometry")),
        F.struct(F.concat(F.lit("m"), k).alias("id"), F.when(F.col("k") % 2 == 0, '{"type":"MultiPoint","coordinates":[[1,2]]}').alias("geometry")),
    )))
    folder = fx.scratch(spark)
    Wr.write_feature_layers(features, folder)
    back = spark.read.schema("id string, geometry string, layer string").json(folder)
    return back.select("id", "layer", F.get_json_object("geometry", "$.type").alias("kind"))


@query("read_listings", fx.with_frames("""
SELECT listing_id AS id, price, round(CASE WHEN o % 3 = 0 THEN coalesce(longitude, -70e0) ELSE longitude END, 9) AS longitude,
       'Ann' AS agent FROM listings"""))
def read_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.listings(spark, sf_dir)
    raw = F.struct(
        F.col("listing_id").alias("id"), "price", F.col("longitude"), F.col("latitude"),
        F.struct(F.lit("Ann").alias("name")).alias("listingAgent"),
    )
    # Thirds: FeatureCollections, arrays (pages of 500) and single objects.
    third = F.col("o") % 3
    feature = _doc(F.struct(F.lit("Point").alias("type"), F.array(F.coalesce("longitude", F.lit(-70.0)), F.coalesce("latitude", F.lit(42.0))).alias("coordinates")), raw)
    pages = rows.where(third < 2).groupBy((F.col("o") % 3).alias("kind"), F.expr("o div 1500").alias("page")).agg(
        F.collect_list(raw).alias("raws"), F.collect_list(feature).alias("features")
    )
    doc = F.when(
        F.col("kind") == 0, F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))
    ).otherwise(F.to_json("raws"))
    folder = fx.scratch(spark)
    pages.select(F.concat_ws("_", "kind", "page").alias("doc"), doc.alias("value")).write.partitionBy("doc").text(folder)
    found = list(spark.read.text(folder).inputFiles())
    # Single objects: one per line is the same record without an enclosing array.
    lines = f"{folder}-lines"
    rows.where(third == 2).select(F.to_json(raw).alias("value")).write.text(lines)
    singles = spark.read.schema(schemas.RAW_LISTING).json(lines)
    listings = R.read_listings(spark, found).drop("_file", "_pos").unionByName(singles)
    return listings.select(
        "id", "price", F.round("longitude", 9).alias("longitude"),
        F.get_json_object("listingAgent", "$.name").alias("agent"),
    )


@query("read_assessments", fx.with_frames("""
SELECT pid, nullif(location, '') AS location, mblu, total_market_value FROM assessments"""))
def read_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.scratch(spark)
    rows = fx.assessments(spark, sf_dir).withColumn("match_source", F.lit("sequential"))
    rows.select(*schemas.ASSESSMENTS.fieldNames()).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return R.read_assessments(spark, folder).select("pid", "location", "mblu", "total_market_value")


@query("read_type_mapping", """
SELECT lower(n_name) AS alias, r_name AS standardized FROM nation JOIN region ON n_regionkey = r_regionkey
UNION SELECT lower(r_name), r_name FROM region""")
def read_type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = fx.table(spark, sf_dir, "nation").join(
        fx.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    folder = fx.scratch(spark)
    # 25 nations in 5 regions.
    nations.groupBy(F.col("r_name").alias("standardized")).agg(
        F.array_join(F.collect_list(F.concat(F.lit(" "), "n_name")), "|").alias("raw_aliases")
    ).write.option("header", True).csv(folder)
    return R.read_type_mapping(spark, folder)


# --- listings and upserts ----------------------------------------------------------------------------


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.listings(spark, sf_dir)
    columns = {
        "id": F.col("listing_id"), "formattedAddress": F.col("formatted_address"),
        "addressLine1": F.col("address_line_1"), "city": F.col("city"), "state": F.col("state"),
        "zipCode": F.col("zip_code"), "latitude": F.col("latitude"), "longitude": F.col("longitude"),
        "propertyType": F.col("property_type"), "lotSize": F.col("lot_size"), "yearBuilt": F.col("year_built"),
        "status": F.col("status"), "price": F.col("price"),
        "listedDate": F.concat(F.col("listed_date").cast("string"), F.lit("T00:00:00.000Z")),
        "listingAgent": F.lit('{"name":"Ann"}'),
    }
    return rows.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RAW_LISTING.fields],
        F.lit("listings").alias("_file"), F.col("o").alias("_pos"),
    )


@query("normalize_listing", fx.with_frames("""
SELECT listing_id, address_line_1, zip_code, property_type, listed_date, year_built, price, 'feed' AS source,
       '{"name":"Ann"}' AS agent FROM listings"""))
def normalize_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_listing(raw_listings(spark, sf_dir), "feed").select(
        "listing_id", "address_line_1", "zip_code", "property_type", "listed_date", "year_built", "price", "source", "agent"
    )


@query("active_listings", fx.with_frames("""
SELECT listing_id AS id FROM listings WHERE status = 'Active' AND state = 'NH' AND city = 'NATION_3'
  AND property_type IN ('Single Family', 'Land')"""))
def active_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.active_listings(raw_listings(spark, sf_dir), "NH", "NATION_3", fixed.LISTING_TYPES).select("id")


@query("eligible_listings", fx.with_frames(
    "SELECT listing_id, property_type FROM listings WHERE property_type IN ('Single Family', 'Land')"))
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible_listings(fx.listings(spark, sf_dir)).select("listing_id", "property_type")


@query("last_wins", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey""")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"))
    return P.last_wins(rows, ["o_custkey"], ["o_orderkey"])


def _listing_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored table (even orders) and a batch: odd and every sixth order, some twice or without id."""
    rows = fx.listings(spark, sf_dir).select("listing_id", "price", "city", "o")
    stored = rows.where("o % 2 = 0").withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    batch = rows.where("o % 2 = 1 OR o % 6 = 0").selectExpr(
        "CASE WHEN o % 45 = 0 THEN '  ' WHEN o % 35 = 0 THEN NULL ELSE listing_id END AS listing_id",
        "price", "city", "o", "explode(CASE WHEN o % 10 = 1 THEN array(0, 1) ELSE array(0) END) AS copy",
    ).withColumn("price", F.col("price") + F.col("copy") + 1.0)
    return stored, batch


_UPSERT_SQL = fx.with_frames("""
SELECT listing_id, CASE WHEN fresh THEN price + 1e0 + CASE WHEN o % 10 = 1 THEN 1e0 ELSE 0e0 END ELSE price END AS price,
       CASE WHEN fresh THEN '2024-02-01' ELSE '2024-01-01' END AS stamped
FROM (SELECT *, (o % 2 = 1 OR o % 6 = 0) AND o % 45 <> 0 AND o % 35 <> 0 AS fresh FROM listings)
WHERE o % 2 = 0 OR fresh""")


@query("upsert", _UPSERT_SQL)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _listing_batches(spark, sf_dir)
    out = P.upsert(stored, batch, ["listing_id"], ["copy"], stamp="fetched_at", now=now())
    return out.select("listing_id", "price", F.date_format("fetched_at", "yyyy-MM-dd").alias("stamped"))


# The same update as a new version of a stored table, of which only the parts in use are rewritten.
@query("upsert_version", _UPSERT_SQL)
def upsert_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _listing_batches(spark, sf_dir)
    table = VersionedTable.create(stored, fx.scratch(spark), ["listing_id"], buckets=16)
    out = table.merge(batch, ["copy"], stamp="fetched_at", now=now()).read()
    return out.select("listing_id", "price", F.date_format("fetched_at", "yyyy-MM-dd").alias("stamped"))


@query("ingest_listings", fx.with_frames("""
SELECT listing_id, CASE WHEN fresh THEN price ELSE -1e0 END AS price FROM (
  SELECT *, status = 'Active' AND state = 'NH' AND property_type IN ('Single Family', 'Land') AS fresh FROM listings)
WHERE fresh OR o % 4 = 0"""))
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_listings(spark, sf_dir)
    stored = N.fill_schema(N.normalize_listing(raw.where("_pos % 4 = 0"), "feed"), schemas.LISTINGS)
    stored = stored.withColumn("price", F.lit(-1.0))
    out = ingest_listings(raw, stored, "feed", ["_file", "_pos"], "NH", types=fixed.LISTING_TYPES, now=now())
    return out.select("listing_id", "price")


@query("ingest_parcels", fx.with_frames("""
SELECT property_id, bool_or(loaded) AS loaded FROM (
  SELECT CASE WHEN count(*) OVER (PARTITION BY coalesce(town_name, 'Bristol'), pid) > 1 THEN pid || '#OBJECTID' || objectid ELSE pid END AS property_id,
         true AS loaded FROM (SELECT *, 'CT:' || nullif(parcel_id, '') AS pid FROM ct) WHERE pid IS NOT NULL
  UNION ALL SELECT property_id, false FROM parcels)
GROUP BY property_id""", _CT_SQL))
def ingest_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = N.fill_schema(fx.parcels(spark, sf_dir))
    out = ingest_parcels(
        ct_features(spark, sf_dir), "CT", R.type_mapping(spark), stored, ["_file", "_pos"], "Bristol", now(), today()
    )
    return out.select("property_id", F.col("loaded_at").isNotNull().alias("loaded"))


# --- cache ----------------------------------------------------------------------------------------------


@query("cache_entries", """
SELECT event_type AS endpoint, sha256('kind=' || event_type || '&user=' || user_id || '&') AS request_key,
       CASE WHEN event_id % 3 = 0 THEN 'null' ELSE props END AS response_body,
       strftime(ts + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M') AS expires, 0 AS hit_count FROM events""")
def cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = fx.requests(spark, sf_dir).join(fx.table(spark, sf_dir, "events").select("event_id", "props"), "event_id")
    responses = responses.withColumn("body", F.expr("CASE WHEN event_id % 3 <> 0 THEN props END")).withColumn("status_code", F.lit(200))
    out = P.cache_entries(responses, "feed", F.col("ts"), dt.timedelta(hours=6))
    return out.select("endpoint", "request_key", "response_body", F.date_format("expires_at", "yyyy-MM-dd HH:mm").alias("expires"), "hit_count")


@query("cache_lookup", fx.with_frames("""
SELECT r.event_id, coalesce(c.fetched_at IS NOT NULL AND (c.expires_at IS NULL OR c.expires_at >= TIMESTAMP '2024-01-10 00:00:00'), false) AS hit,
       CASE WHEN c.expires_at IS NULL OR c.expires_at >= TIMESTAMP '2024-01-10 00:00:00' THEN '{"id":' || c.response_id || '}' END AS response_body
FROM requests r LEFT JOIN cache c USING (endpoint, request_key)"""))
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = P.cache_requests(fx.requests(spark, sf_dir), "feed")
    at = F.lit("2024-01-10 00:00:00").cast("timestamp")
    out = P.cache_lookup(wanted, fx.cache(spark, sf_dir), at, ["event_id"])
    return out.select("event_id", "hit", "response_body")


@query("record_hits", fx.with_frames("""
SELECT c.endpoint, c.request_key, CAST(c.hit_count + count(r.event_id) AS INTEGER) AS hit_count, max(r.event_id) IS NOT NULL AS was_hit
FROM cache c LEFT JOIN requests r ON r.endpoint = c.endpoint AND r.request_key = c.request_key
GROUP BY c.endpoint, c.request_key, c.hit_count"""))
def record_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = P.cache_requests(fx.requests(spark, sf_dir), "feed")
    out = P.record_hits(fx.cache(spark, sf_dir), hits, "ts")
    return out.select("endpoint", "request_key", "hit_count", F.col("last_hit_at").isNotNull().alias("was_hit"))


@query("save_cache", fx.with_frames("""
SELECT endpoint, request_key, coalesce(max(old_hits), 0) AS hit_count, max(body) AS response_body FROM (
  SELECT endpoint, request_key, hit_count AS old_hits, NULL AS body FROM cache
  UNION ALL SELECT endpoint, request_key, NULL, arg_max('{"n":' || event_id || '}', event_id) FROM requests GROUP BY endpoint, request_key)
GROUP BY endpoint, request_key"""))
def save_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = fx.requests(spark, sf_dir).select(
        "endpoint", "params", F.expr("""'{"n":' || event_id || '}'""").alias("body"), F.lit(200).alias("status_code"),
        F.lit("events").alias("_file"), F.col("event_id").alias("_pos"),
    )
    entries = P.cache_entries(responses, "feed", now(), None)
    out = P.save_cache(fx.cache(spark, sf_dir), entries, ["_file", "_pos"])
    return out.select("endpoint", "request_key", "hit_count", "response_body")


# --- lookups --------------------------------------------------------------------------------------------


_FIND_SQL = fx.with_frames("""
SELECT listing_id, listed_date FROM listings WHERE upper(state) = 'NH' AND upper(city) = 'NATION_4' AND upper(property_type) = 'LAND'""")


# The same over a table stored with folded keys.
@query("find_stored_listings", _FIND_SQL)
def find_stored_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.scratch(spark)
    L.write_for_lookups(fx.listings(spark, sf_dir), folder, ["state", "city", "property_type"])
    return L.find_listings(spark.read.parquet(folder), "nh", "nation_4", " ", "land").select("listing_id", "listed_date")


@query("find_listings", _FIND_SQL)
def find_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.find_listings(fx.listings(spark, sf_dir), "nh", "nation_4", " ", "land").select("listing_id", "listed_date")


@query("find_listing", fx.with_frames("SELECT listing_id, price FROM listings WHERE listing_id = 'L77'"))
def find_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.find_listing(fx.listings(spark, sf_dir), "L77").select("listing_id", "price")


@query("find_property_values", fx.with_frames("""
SELECT property_id, assessed_value FROM parcels WHERE upper(municipality) = 'NATION_7' AND zip = '03003' AND upper(property_type) = 'SINGLE FAMILY'"""))
def find_property_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.find_property_values(fx.parcels(spark, sf_dir), "nh", "nation_7", None, "03003", "single family")
    return found.select("property_id", "assessed_value")


@query("distinct_state_city", fx.with_frames("SELECT DISTINCT state, city FROM listings"))
def distinct_state_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.distinct_state_city(fx.listings(spark, sf_dir))


@query("distinct_towns", fx.with_frames("SELECT DISTINCT town_name AS town FROM ct WHERE town_name <> ''", _CT_SQL))
def distinct_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.distinct_towns(ct_features(spark, sf_dir), "Town_Name")
