"""Scalar, address-key and geometry column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import joined, query, r6
from parcel_comps import fixed_values as fixed
from parcel_comps.functions import addresses as A
from parcel_comps.functions import distance as D
from parcel_comps.functions import geometry as G
from parcel_comps.functions import scalars as S
from parcel_comps.operators.normalize import standardize_type
from parcel_comps.sources.readers import older_type_mapping, type_mapping


def select(spark: SparkSession, sf_dir: str, name: str, *exprs: str) -> DataFrame:
    return fx.table(spark, sf_dir, name).selectExpr(*exprs)


# --- scalars -----------------------------------------------------------------------------

_NUM_TEXT = """CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '1e3'
  WHEN 3 THEN NULL WHEN 4 THEN ' 12.5 ' WHEN 5 THEN '7d' ELSE CAST(c_custkey AS {text}) END"""


@query("safe_num", f"""
SELECT c_custkey AS k, CASE WHEN t <> '7d' THEN TRY_CAST(trim(t) AS DOUBLE) END AS num
FROM (SELECT c_custkey, {_NUM_TEXT.format(text='VARCHAR')} AS t FROM customer)""")
def safe_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "customer", "c_custkey AS k", f"{_NUM_TEXT.format(text='STRING')} AS t")
    return rows.select("k", S.safe_num("t").alias("num"))


@query("epoch_ms_date", """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 IN (0, 1, 2) THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS sale_date
FROM orders""")
def epoch_ms_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.lit(3_600_000)
    k = F.col("o_orderkey")
    text = (
        F.when(k % 9 == 0, "-2209161600000").when(k % 9 == 1, "").when(k % 9 == 2, "n/a")
        .otherwise(ms.cast("string"))
    )
    return fx.table(spark, sf_dir, "orders").select(
        k.alias("k"), S.epoch_ms_date(text).alias("sale_date")
    )


@query("yyyymmdd_date", """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 IN (0, 1, 2) THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS sale_date
FROM orders""")
def yyyymmdd_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = (
        F.when(k % 9 == 0, "00000000").when(k % 9 == 1, "20061399").when(k % 9 == 2, "2006-1-1")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return fx.table(spark, sf_dir, "orders").select(
        k.alias("k"), S.yyyymmdd_date(text).alias("sale_date")
    )


@query("iso_date_only", """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS listed
FROM orders""")
def iso_date_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 5 != 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00.000Z")))
    return fx.table(spark, sf_dir, "orders").select(k.alias("k"), S.iso_date_only(text).alias("listed"))


_BATHS = "CASE WHEN p_partkey % 3 <> 0 THEN p_size % 4 END AS f, CASE WHEN p_partkey % 4 <> 0 THEN p_size % 3 END AS h"


@query("combined_bathrooms", f"""
SELECT k, CASE WHEN f IS NOT NULL OR h IS NOT NULL
               THEN coalesce(f, 0) + 0.5e0 * coalesce(h, 0) END AS baths
FROM (SELECT p_partkey AS k, {_BATHS} FROM part)""")
def combined_bathrooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k",
        "CASE WHEN p_partkey % 3 <> 0 THEN p_size % 4 END AS f",
        "CASE WHEN p_partkey % 4 <> 0 THEN p_size % 3 END AS h",
    )
    return rows.select("k", S.combined_bathrooms("f", "h").alias("baths"))


_UNITS = """CASE p_partkey % 8 WHEN 0 THEN 'Acres' WHEN 1 THEN 'SQ FT' WHEN 2 THEN ' sf ' WHEN 3 THEN NULL
  WHEN 4 THEN 'rods' WHEN 5 THEN '' WHEN 6 THEN 'acre' ELSE 'Square Feet' END"""


@query("lot_acres", f"""
SELECT k, round(CASE WHEN u LIKE 'acre%' THEN s WHEN u LIKE '%sf%' OR u LIKE '%sq%' OR u LIKE '%feet%'
                     THEN s / 43560e0 END, 6) AS acres
FROM (SELECT p_partkey AS k, p_retailprice AS s, lower(trim({_UNITS})) AS u FROM part)""")
def lot_acres(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "part", "p_partkey AS k", "p_retailprice AS s", f"{_UNITS} AS u")
    return rows.select("k", r6(S.lot_acres("s", "u")).alias("acres"))


_PARTS = [
    "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE CAST(k AS {t}) END AS num",
    "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN ' Main St ' ELSE NULL END AS street",
    "CASE k % 5 WHEN 0 THEN ' Unit 2 ' WHEN 1 THEN '  ' ELSE NULL END AS loc",
    "CASE WHEN k % 7 <> 0 THEN 'SITE ' || k END AS site",
]


@query("build_address", """
WITH b AS (SELECT k, %s FROM (SELECT c_custkey AS k FROM customer)),
j AS (SELECT k, nullif(trim(loc), '') AS loc, site,
        nullif(concat_ws(' ', nullif(trim(num), ''), nullif(trim(street), '')), '') AS base FROM b)
SELECT k, coalesce(CASE WHEN base IS NOT NULL AND loc IS NOT NULL THEN base || ' ' || loc END, loc, base, site) AS address
FROM j""" % ", ".join(p.format(t="VARCHAR") for p in _PARTS))
def build_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "customer", "c_custkey AS k")
    rows = rows.selectExpr("k", *[p.format(t="STRING") for p in _PARTS])
    return rows.select("k", S.build_address("num", "street", "loc", "site").alias("address"))


def _mapping_sql(pairs: list[tuple[str, str]]) -> str:
    return ", ".join("('%s', '%s')" % (a.replace("'", "''"), s) for a, s in pairs)


_ALIASES = [(a, n) for n, aliases in fixed.TYPE_ALIASES.items() for a in aliases]
_ALIASES += [(n.lower(), n) for n in fixed.TYPE_ALIASES if n.lower() not in dict(_ALIASES)]
_RAW_TYPE = """CASE k % 9 WHEN 0 THEN ' ONE FAM ' WHEN 1 THEN 'ocean frt  vacant'
  WHEN 2 THEN 'ocean frt vacant' WHEN 3 THEN ' Farm House ' WHEN 4 THEN '  ' WHEN 5 THEN NULL
  WHEN 6 THEN 'three family' WHEN 7 THEN 'Res  PUD' ELSE coalesce(raw_type, 'undev') END"""


@query("standardize_type", fx.with_frames(f"""
SELECT k, coalesce(m.s, nullif(trim(t), '')) AS type
FROM (SELECT k, {_RAW_TYPE} AS t FROM lots) LEFT JOIN (VALUES {_mapping_sql(_ALIASES)}) m(a, s)
  ON lower(trim(t)) = m.a"""))
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).selectExpr("k", f"{_RAW_TYPE} AS type")
    return standardize_type(rows, "type", type_mapping(spark))


@query("standardize_type_older", fx.with_frames(f"""
SELECT k, coalesce(m.s, t) AS type
FROM (SELECT k, {_RAW_TYPE} AS t FROM lots)
LEFT JOIN (VALUES {_mapping_sql(list(fixed.OLDER_TYPE_ALIASES.items()))}) m(a, s) ON lower(trim(t)) = m.a"""))
def standardize_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).selectExpr("k", f"{_RAW_TYPE} AS type")
    return standardize_type(rows, "type", older_type_mapping(spark), keep_unknown_raw=True)


_KNOWN = """CASE p_partkey % 6 WHEN 0 THEN ' single FAMILY' WHEN 1 THEN 'Vacant Land' WHEN 2 THEN 'two family '
  WHEN 3 THEN p_type WHEN 4 THEN NULL ELSE 'MULTI FAMILY' END"""


@query("parse_known_type", f"""
SELECT k, CASE lower(trim(t)) WHEN 'single family' THEN 'Single Family' WHEN 'multi family' THEN 'Multi Family'
  WHEN 'two family' THEN 'Two Family' WHEN 'vacant land' THEN 'Vacant Land' END AS type
FROM (SELECT p_partkey AS k, {_KNOWN} AS t FROM part)""")
def parse_known_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "part", "p_partkey AS k", f"{_KNOWN} AS t")
    return rows.select("k", S.parse_known_type("t").alias("type"))


_SIZES = "CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS a, CASE WHEN p_partkey % 7 <> 0 THEN (p_size - 2) * 100e0 END AS b"


@query("lot_size_similar", f"""
SELECT k, coalesce(CASE WHEN a > 0 AND b > 0 THEN greatest(a, b) / least(a, b) <= 2.5e0 END, false) AS similar
FROM (SELECT p_partkey AS k, {_SIZES} FROM part)""")
def lot_size_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _SIZES.split(" AS a, ")
    rows = select(spark, sf_dir, "part", "p_partkey AS k", f"{a} AS a", b)
    return rows.select("k", S.lot_size_similar("a", "b").alias("similar"))


_LOT = "CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0e0 ELSE p_retailprice * 40e0 END"


@query("plausible_size", f"""
SELECT k, acres <= CASE WHEN lot IS NULL THEN 200e0 ELSE greatest(lot / 43560e0 * 20e0, 5e0) END AS service,
       acres <= CASE WHEN lot IS NULL OR lot = 0 THEN 200e0 ELSE greatest(lot / 43560e0 * 20e0, 5e0) END AS batch
FROM (SELECT p_partkey AS k, p_size * 6e0 AS acres, {_LOT} AS lot FROM part)""")
def plausible_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "part", "p_partkey AS k", "p_size * 6e0 AS acres", f"{_LOT} AS lot")
    return rows.select(
        "k", S.plausible_size("acres", "lot").alias("service"),
        S.plausible_size("acres", "lot", zero_is_missing=True).alias("batch"),
    )


@query("slugify", r"""
SELECT k, trim(regexp_replace(lower(coalesce(nullif(t, ''), 'unknown')), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
       replace(lower(t), ' ', '_') AS town
FROM (SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '#' || s_name || '!'
             ELSE 'St. Mary''s Rd ' || s_suppkey END AS t FROM supplier)""")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    text = (
        F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "")
        .when(k % 4 == 2, F.concat(F.lit("#"), "s_name", F.lit("!")))
        .otherwise(F.concat(F.lit("St. Mary's Rd "), k.cast("string")))
    )
    rows = fx.table(spark, sf_dir, "supplier").select(k.alias("k"), text.alias("t"))
    return rows.select("k", S.slugify("t").alias("slug"), S.town_slug("t").alias("town"))


@query("request_key", """
SELECT event_id, sha256('kind=' || event_type || '&user=' || user_id || '&') AS key,
       '{"kind":"' || event_type || '","user":"' || user_id || '"}' AS params
FROM events""")
def request_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.requests(spark, sf_dir).select(
        "event_id", S.request_key("params").alias("key"), S.request_params_json("params").alias("params")
    )


@query("newer_construction_flag", fx.with_frames(
    "SELECT listing_id, coalesce(year_built >= 2020, false) AS newer FROM listings"))
def newer_construction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.listings(spark, sf_dir).select(
        "listing_id", S.newer_construction_flag("year_built").alias("newer")
    )


@query("unit_style_address", fx.with_frames(
    "SELECT k, coalesce(contains(CASE WHEN k % 3 = 0 THEN address || ' #' || k ELSE address END, '#'), false) AS unit FROM lots"))
def unit_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("CASE WHEN k % 3 = 0 THEN address || ' #' || k ELSE address END")
    return fx.lots(spark, sf_dir).select("k", S.unit_style_address(text).alias("unit"))


# --- addresses and keys ----------------------------------------------------------------------

_TEXT = "CASE WHEN k % 6 = 0 THEN k || ' N. West Street, Apt_' || k % 9 ELSE address END"


@query("normalize_address", fx.with_frames(
    f"SELECT k, {fx.address_sql(_TEXT)} AS normal FROM lots"))
def normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.lots(spark, sf_dir).select("k", A.normalize_address(F.expr(_TEXT)).alias("normal"))


@query("street_name_only", fx.with_frames(
    f"SELECT k, {fx.street_sql(_TEXT)} AS street FROM lots"))
def street_name_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.lots(spark, sf_dir).select("k", A.street_name_only(F.expr(_TEXT)).alias("street"))


_UNIT = """CASE k % 6 WHEN 0 THEN '00' WHEN 1 THEN '01 0000' || k WHEN 2 THEN NULL WHEN 3 THEN '0' || k || 'b'
  WHEN 4 THEN '  ' ELSE '00 00000' END"""


def _unit_sql(expr: str) -> str:
    words = rf"list_filter(string_split(regexp_replace(trim(upper({expr})), '\s+', ' ', 'g'), ' '), lambda w: w <> '')"
    bare = f"[coalesce(nullif(ltrim(w, '0'), ''), '0') FOR w IN {words}]"
    return (
        f"CASE WHEN {expr} IS NULL OR len(list_filter({bare}, lambda w: w <> '0')) = 0 THEN '00' "
        f"ELSE array_to_string({bare}, ' ') END"
    )


@query("unit_token", f"SELECT k, {_unit_sql('u')} AS unit FROM (SELECT k, {_UNIT} AS u FROM (SELECT c_custkey AS k FROM customer))")
def unit_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "customer", "c_custkey AS k").selectExpr("k", f"{_UNIT} AS u")
    return rows.select("k", A.unit_token("u").alias("unit"))


def key_sql(parts: list[str], usable: str) -> str:
    bare = [f"coalesce(nullif(ltrim({p}, '0'), ''), '0')" for p in parts[:3]]
    joined_key = " || '|' || ".join([*bare, f"({_unit_sql(parts[3])})"])
    return f"CASE WHEN {usable} THEN {joined_key} END"


def _key_text(key: Column) -> Column:
    return F.when(key.isNotNull(), F.concat_ws("|", key["map"], key["block"], key["lot"], key["unit"]))


_PID = """CASE k % 6 WHEN 0 THEN '0' || k || ' 0032 00' || k % 10 WHEN 1 THEN '118-039000-3B'
  WHEN 2 THEN k || '-' || lpad(CAST(k % 1000 AS {t}), 3, '0') || '000-00' WHEN 3 THEN '' || k WHEN 4 THEN NULL
  ELSE '12 7 3 0' || k || 'a' END"""


@query("parcel_key", f"""
WITH w AS (SELECT k, list_filter(string_split(regexp_replace(p, '[-\\s]+', ' ', 'g'), ' '), lambda w: w <> '') AS t
           FROM (SELECT k, {_PID.format(t='VARCHAR')} AS p FROM (SELECT c_custkey AS k FROM customer))),
s AS (SELECT k, t, regexp_full_match(t[2], '[0-9]{{6}}') AS packed FROM w),
q AS (SELECT k, t, t[1] AS m, CASE WHEN packed THEN substr(t[2], 1, 3) ELSE t[2] END AS b,
        CASE WHEN packed THEN substr(t[2], 4, 3) ELSE coalesce(t[3], '0') END AS l,
        CASE WHEN packed THEN t[3] ELSE t[4] END AS u FROM s)
SELECT k, {key_sql(['m', 'b', 'l', 'u'], 'len(t) >= 2')} AS key FROM q""")
def parcel_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select(spark, sf_dir, "customer", "c_custkey AS k").selectExpr("k", f"{_PID.format(t='STRING')} AS p")
    return rows.select("k", _key_text(A.parcel_key("p")).alias("key"))


@query("mblu_key", fx.with_frames(f"""
SELECT k, copy, {key_sql(['t[1]', 't[2]', 't[3]', 't[4]'], 'len(t) >= 3')} AS key
FROM (SELECT CAST(pid AS BIGINT) AS k, copy,
             list_filter([trim(p) FOR p IN string_split(mblu, '/')], lambda w: w <> '') AS t FROM assessments)"""))
def mblu_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.assessments(spark, sf_dir).select(
        F.col("pid").cast("bigint").alias("k"), "copy", _key_text(A.mblu_key("mblu")).alias("key")
    )


def variants_sql(expr: str) -> str:
    """The spellings after the original, in order of first occurrence."""
    long_d = {v: k for k, v in fixed.DIRECTIONS.items()}
    long_s = {v: k for k, v in fixed.STREET_WORDS.items()}
    words = fx.words_sql(expr)
    spellings = [
        f"array_to_string({fx.swap_sql(fx.swap_sql(words, d), s)}, ' ')"
        for d in ({}, long_d, fixed.DIRECTIONS) for s in ({}, long_s, fixed.STREET_WORDS)
    ]
    return f"[{', '.join(spellings)}]"


VARIANTS_SQL = """
SELECT k, CASE WHEN original IS NOT NULL THEN array_to_string([original] || list_filter(
         [v FOR v, i IN spellings IF list_position(spellings, v) = i], lambda v: v <> spellings[1]), '|') END AS variants
FROM (SELECT k, t AS original, {spellings} AS spellings FROM (SELECT k, {text} AS t FROM lots))"""


@query("address_variants", fx.with_frames(VARIANTS_SQL.format(spellings=variants_sql("t"), text=_TEXT)))
def address_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.lots(spark, sf_dir).select("k", F.expr(_TEXT).alias("t"))
    return rows.select("k", joined(A.address_variants("t")).alias("variants"))


# --- geometry ----------------------------------------------------------------------------------

# Four shapes per lot, by k % 4: rectangle, rectangle with a hole over its middle half,
# two parts 0.002 degrees apart, and an L without the upper right quarter.
SHAPES_SQL = """
shapes AS (
  SELECT k, k % 4 AS kind, x0, y0, x1, y1, x1 - x0 AS w, y1 - y0 AS h, (x0 + x1) / 2e0 AS xm, (y0 + y1) / 2e0 AS ym,
         cos(radians(y0)) * 111320e0 AS e, 111320e0 AS n
  FROM lots
)"""


def _ring(points: list[tuple[Column, Column]]) -> Column:
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])


def _rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return _ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    w, h = x1 - x0, y1 - y0
    xm, ym = (x0 + x1) / 2.0, (y0 + y1) / 2.0
    outer = _rect(x0, y0, x1, y1)
    hole = _rect(x0 + w * 0.25, y0 + h * 0.25, x0 + w * 0.75, y0 + h * 0.75)
    second = _rect(x0 + 0.002, y0, x1 + 0.002, y1)
    ell = _ring([(x0, y0), (x1, y0), (x1, ym), (xm, ym), (xm, y1), (x0, y1), (x0, y0)])
    kind = F.col("k") % 4
    geometry = (
        F.when(kind == 0, F.array(F.array(outer)))
        .when(kind == 1, F.array(F.array(outer, hole)))
        .when(kind == 2, F.array(F.array(outer), F.array(second)))
        .otherwise(F.array(F.array(ell)))
    )
    return fx.lots(spark, sf_dir).select(
        "k", kind.alias("kind"), "x0", "y0", "x1", "y1", geometry.alias("g"),
        w.alias("w"), h.alias("h"), xm.alias("xm"), ym.alias("ym"),
    )


@query("parse_geometry", fx.with_frames("""
SELECT k, CASE WHEN kind = 2 THEN 2 ELSE 1 END AS parts, CASE WHEN kind = 1 THEN 10 WHEN kind = 2 THEN 10
       WHEN kind = 3 THEN 7 ELSE 5 END AS points, round(x0, 6) AS first_x, round(y0, 6) AS first_y
FROM shapes""", SHAPES_SQL))
def parse_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes(spark, sf_dir)
    multi = F.to_json(G.to_multipolygon("g"))
    inner = F.get_json_object(multi, "$.coordinates[0]")
    text = (
        F.when((F.col("kind") == 2) | (F.col("k") % 3 == 0), multi)
        .when(F.col("k") % 3 == 1, F.concat(F.lit('{"type":"Polygon","coordinates":'), inner, F.lit("}")))
        .otherwise(F.concat(F.lit('{"rings":'), inner, F.lit("}")))
    )
    rows = rows.select("k", G.parse_geometry(text).alias("g"))
    first = F.col("g")[0][0][0]
    return rows.select(
        "k", G.part_count("g").alias("parts"), F.size(G.vertices("g")).alias("points"),
        r6(first["x"]).alias("first_x"), r6(first["y"]).alias("first_y"),
    )


@query("to_multipolygon", fx.with_frames("""
SELECT k, 'MultiPolygon' AS kind, CASE WHEN kind = 2 THEN 2 ELSE 1 END AS parts FROM shapes""", SHAPES_SQL))
def to_multipolygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = shapes(spark, sf_dir).select("k", F.to_json(G.to_multipolygon("g")).alias("t"))
    return written.select("k", G.geometry_kind("t").alias("kind"), G.part_count(G.parse_geometry("t")).alias("parts"))


@query("vertex_mean", fx.with_frames("""
SELECT k, round(CASE kind WHEN 1 THEN ((3 * y0 + 2 * y1) / 5e0 + (3 * (y0 + h * 0.25e0) + 2 * (y0 + h * 0.75e0)) / 5e0) / 2e0
                WHEN 3 THEN (3 * y0 + 2 * ym + 2 * y1) / 7e0 ELSE (3 * y0 + 2 * y1) / 5e0 END, 9) AS lat,
       round(CASE kind WHEN 1 THEN ((3 * x0 + 2 * x1) / 5e0 + (3 * (x0 + w * 0.25e0) + 2 * (x0 + w * 0.75e0)) / 5e0) / 2e0
                WHEN 2 THEN (3 * x0 + 2 * x1) / 5e0 + 0.001e0
                WHEN 3 THEN (3 * x0 + 2 * x1 + 2 * xm) / 7e0 ELSE (3 * x0 + 2 * x1) / 5e0 END, 9) AS lon
FROM shapes""", SHAPES_SQL))
def vertex_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes(spark, sf_dir).select("k", G.vertex_mean("g").alias("m"))
    return rows.select("k", F.round("m.lat", 9).alias("lat"), F.round("m.lon", 9).alias("lon"))


@query("first_ring_mean", fx.with_frames("""
SELECT k, round(CASE WHEN kind = 3 THEN (3 * y0 + 2 * ym + 2 * y1) / 7e0 ELSE (3 * y0 + 2 * y1) / 5e0 END, 6) AS lat,
       round(CASE WHEN kind = 3 THEN (3 * x0 + 2 * x1 + 2 * xm) / 7e0 ELSE (3 * x0 + 2 * x1) / 5e0 END, 6) AS lon
FROM shapes""", SHAPES_SQL))
def first_ring_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes(spark, sf_dir).select("k", G.first_ring_mean("g").alias("m"))
    return rows.select("k", r6("m.lat").alias("lat"), r6("m.lon").alias("lon"))


_DEG_ACRES = "111320e0 * 111320e0 / 4046.8564224e0"
_RING_LAT = "CASE WHEN kind = 3 THEN (3 * y0 + 2 * ym + 2 * y1) / 7e0 ELSE (3 * y0 + 2 * y1) / 5e0 END"


@query("area_acres", fx.with_frames(f"""
SELECT k, round(w * h * CASE kind WHEN 2 THEN 2e0 WHEN 3 THEN 0.75e0 ELSE 1e0 END
                * cos(radians({_RING_LAT})) * {_DEG_ACRES}, 4) AS acres FROM shapes""", SHAPES_SQL))
def area_acres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(spark, sf_dir).select("k", F.round(G.area_acres("g"), 4).alias("acres"))


@query("net_area_acres", fx.with_frames(f"""
SELECT k, round(w * h * CASE kind WHEN 1 THEN 0.75e0 WHEN 2 THEN 2e0 WHEN 3 THEN 0.75e0 ELSE 1e0 END
                * cos(radians({_RING_LAT})) * {_DEG_ACRES}, 4) AS acres FROM shapes""", SHAPES_SQL))
def net_area_acres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(spark, sf_dir).select("k", F.round(G.area_acres("g", subtract_holes=True), 4).alias("acres"))


@query("centroid", fx.with_frames("""
SELECT k, round(CASE WHEN kind = 3 THEN y0 + h * 5e0 / 12e0 ELSE ym END, 6) AS lat,
       round(CASE kind WHEN 2 THEN xm + 0.001e0 WHEN 3 THEN x0 + w * 5e0 / 12e0 ELSE xm END, 6) AS lon
FROM shapes""", SHAPES_SQL))
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes(spark, sf_dir).select("k", G.centroid("g").alias("c"))
    return rows.select("k", r6("c.lat").alias("lat"), r6("c.lon").alias("lon"))


@query("part_and_hole_count", fx.with_frames("""
SELECT k, CASE WHEN kind = 2 THEN 2 ELSE 1 END AS parts, CASE WHEN kind = 1 THEN 1 ELSE 0 END AS holes
FROM shapes""", SHAPES_SQL))
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(spark, sf_dir).select("k", G.part_count("g").alias("parts"), G.hole_count("g").alias("holes"))


@query("vertex_distance", fx.with_frames("""
SELECT k, round(CASE kind WHEN 2 THEN sqrt((w + 0.002e0) * e * (w + 0.002e0) * e + h * n * h * n)
    WHEN 3 THEN greatest(sqrt(w * e * w * e + h / 2 * n * h / 2 * n), sqrt(w / 2 * e * w / 2 * e + h * n * h * n))
    ELSE sqrt(w * e * w * e + h * n * h * n) END, 4) AS farthest, 0e0 AS nearest
FROM shapes""", SHAPES_SQL))
def vertex_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(spark, sf_dir).select(
        "k", F.round(G.farthest_vertex_m("g", "y0", "x0"), 4).alias("farthest"),
        F.round(G.nearest_vertex_m("g", "y0", "x0"), 4).alias("nearest"),
    )


@query("contains_point", fx.with_frames("""
SELECT k, kind IN (0, 2) AS inside, false AS on_side, kind <> 3 AS near_side FROM shapes""", SHAPES_SQL))
def contains_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    px, py = F.col("xm") + F.col("w") / 8, F.col("ym") + F.col("h") / 8
    # The right side above the middle; the L has no land there.
    beside = F.col("x1") + 0.00004
    return shapes(spark, sf_dir).select(
        "k", G.contains_point("g", px, py).alias("inside"),
        G.contains_point("g", F.col("x1"), py).alias("on_side"),
        G.contains_point("g", beside, F.col("ym") + F.col("h") / 4, 0.00005).alias("near_side"),
    )


_PROBE_X = "x0 + w * CASE WHEN kind = 3 THEN 0.75e0 ELSE 0.5e0 END"
_PROBE_Y = "y0 + h * CASE WHEN kind = 3 THEN 0.75e0 ELSE 0.5e0 END"


def _probe(rows: DataFrame) -> DataFrame:
    """A small square in the middle of the shape, its hole or its missing quarter."""
    half = F.lit(0.00001)
    return rows.select("*", F.expr(_PROBE_X).alias("px"), F.expr(_PROBE_Y).alias("py")).withColumn(
        "probe", G.rectangle(F.col("px") - half, F.col("py") - half, F.col("px") + half, F.col("py") + half)
    )


@query("boundary_distance_m", fx.with_frames("""
SELECT k, round(CASE WHEN kind IN (1, 3)
    THEN least((w * 0.25e0 - 0.00001e0) * e, (h * 0.25e0 - 0.00001e0) * n) ELSE 0e0 END, 4) AS metres
FROM shapes""", SHAPES_SQL))
def boundary_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _probe(shapes(spark, sf_dir))
    return rows.select("k", F.round(D.boundary_distance_m("g", "probe", "y0"), 4).alias("metres"))


@query("point_distance_m", fx.with_frames(f"""
SELECT k, round(CASE WHEN kind IN (1, 3) THEN least(w * 0.25e0 * cos(radians({_PROBE_Y})) * 111320e0, h * 0.25e0 * n)
                ELSE 0e0 END, 4) AS metres
FROM shapes""", SHAPES_SQL))
def point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _probe(shapes(spark, sf_dir))
    return rows.select("k", F.round(D.point_distance_m("g", "py", "px"), 4).alias("metres"))


@query("touches", fx.with_frames("""
SELECT k, kind IN (0, 2) AS in_metres, CASE WHEN kind IN (1, 3)
    THEN least(w * 0.25e0 - 0.00001e0, h * 0.25e0 - 0.00001e0) <= 0.00012e0 ELSE true END AS in_degrees
FROM shapes""", SHAPES_SQL))
def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _probe(shapes(spark, sf_dir))
    return rows.select(
        "k", D.touches("g", "probe", "y0").alias("in_metres"),
        D.touches("g", "probe", "y0", 0.00012, "degrees").alias("in_degrees"),
    )


@query("hookline", fx.with_frames("""
SELECT k, 'LineString' AS kind, round(x0, 6) AS from_lon, round(y0, 6) AS from_lat,
       round(CASE kind WHEN 2 THEN xm + 0.001e0 WHEN 3 THEN x0 + w * 5e0 / 12e0 ELSE xm END, 6) AS to_lon
FROM shapes""", SHAPES_SQL))
def hookline(spark: SparkSession, sf_dir: str) -> DataFrame:
    center = G.centroid("g")
    rows = shapes(spark, sf_dir).select(
        "k", F.to_json(G.hookline("x0", "y0", center["lon"], center["lat"])).alias("line")
    )

    def at(path: str) -> Column:
        return r6(F.get_json_object("line", path).cast("double"))

    return rows.select(
        "k", F.get_json_object("line", "$.type").alias("kind"), at("$.coordinates[0][0]").alias("from_lon"),
        at("$.coordinates[0][1]").alias("from_lat"), at("$.coordinates[1][0]").alias("to_lon"),
    )
