"""Parcel resolution, comps, gaps, ranks and reports for both rule sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.frame_queries import now
from checks.registry import joined, query, r6
from parcel_comps import schemas
from parcel_comps.functions.distance import boundary_distance_m
from parcel_comps.operators import gaps as Gp
from parcel_comps.operators import grid
from parcel_comps.operators import lookup as L
from parcel_comps.operators import spatial as Sp
from parcel_comps.operators.linkage import merge_reasons
from parcel_comps.operators.normalize import fill_schema
from parcel_comps.operators.skew import row_numbers
from parcel_comps.plans import incremental as Ic
from parcel_comps.plans import recompute as Rc
from parcel_comps.plans import reports as Rp
from parcel_comps.sources import writers as Wr

# Rectangles have closed-form distances, so the oracles need no geometry engine.
_GAPS = """greatest(0e0, {a}.x0 - {b}.x1, {b}.x0 - {a}.x1) AS dx, greatest(0e0, {a}.y0 - {b}.y1, {b}.y0 - {a}.y1) AS dy"""
_SIMILAR = "coalesce(CASE WHEN {a} > 0 AND {b} > 0 THEN greatest({a}, {b}) / least({a}, {b}) <= 2.5e0 END, false)"
_FITS = "acres <= CASE WHEN {lot} IS NULL THEN 200e0 ELSE greatest({lot} / 43560e0 * 20e0, 5e0) END"


def _resolve_sql(profile: str) -> str:
    service = profile == "service"
    inside = (
        "l.longitude > p.x0 AND l.longitude < p.x1 AND l.latitude > p.y0 AND l.latitude < p.y1"
        if service
        else """l.longitude IS NOT NULL AND sqrt(power(greatest(0e0, p.x0 - l.longitude, l.longitude - p.x1), 2)
                     + power(greatest(0e0, p.y0 - l.latitude, l.latitude - p.y1), 2)) < 0.00005e0"""
    )
    eligible = "" if service else " WHERE property_type IN ('Single Family', 'Land')"
    lot = "lot_size" if service else "nullif(lot_size, 0)"
    address = fx.address_sql("address")
    fallback = "NULL" if service else "a.property_id"
    return f"""
wanted AS (SELECT * FROM listings{eligible}),
contained AS (SELECT l.listing_id, p.property_id, p.ring_acres AS acres FROM wanted l JOIN parcels p ON {inside}),
best AS (SELECT * FROM contained QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY acres, property_id) = 1),
by_address AS (SELECT addr, min(property_id) AS property_id FROM (SELECT property_id, {address} AS addr FROM parcels)
               WHERE addr <> '' GROUP BY addr HAVING count(*) = 1),
first_try AS (
  SELECT w.*, CASE WHEN {_FITS.format(lot=lot)} THEN b.property_id END AS pip, b.property_id IS NOT NULL AS had_one,
         {fx.address_sql('w.address_line_1')} AS addr
  FROM wanted w LEFT JOIN best b USING (listing_id)
),
resolved AS (
  SELECT f.*, coalesce(pip, {fallback}) AS target_id,
         CASE WHEN pip IS NOT NULL THEN 'point_in_polygon' WHEN {fallback} IS NOT NULL THEN 'address'
              WHEN had_one THEN 'unresolved_suspect_parcel' ELSE 'unresolved' END AS resolve_method
  FROM first_try f LEFT JOIN by_address a ON f.pip IS NULL AND f.addr = a.addr
)"""


def _comps_sql(profile: str) -> str:
    service = profile == "service"
    land = "false" if service else "coalesce(property_type = 'Land', false)"
    t_acres = "coalesce(t.acreage, t.ring_acres)" if service else "t.ring_acres"
    acres = "p.acreage" if service else "p.ring_acres"
    touch = "d <= 5" if service else "sqrt(dx * dx + dy * dy) <= 0.00005e0"
    reach = "d <= 250" if service else "(d <= 250 OR sqrt(dx * dx + dy * dy) <= 0.00005e0)"
    kind = "CASE lower(trim(raw_type)) WHEN 'single family' THEN 'Single Family' WHEN 'multi family' THEN 'Multi Family' WHEN 'two family' THEN 'Two Family' WHEN 'vacant land' THEN 'Vacant Land' END" if service else "raw_type"
    screen = "far <= 500" if service else "true"
    street = "d <= 250 AND street <> '' AND street = t_street"
    if not service:
        street += " AND NOT (d <= 100 AND alike)"
    size_ok = "alike" if service else "(alike OR is_land)"
    return f"""
targets AS (
  SELECT t.property_id AS target_id, r.is_land, t.x0, t.y0, t.x1, t.y1, t.cx, t.cy, {t_acres} AS t_acres, t.assessed_value AS t_value,
         {fx.street_sql('t.address')} AS t_street, cos(radians(t.cy)) * 111320e0 AS east
  FROM (SELECT DISTINCT target_id, {land} AS is_land FROM resolved WHERE target_id IS NOT NULL) r
  JOIN parcels t ON t.property_id = r.target_id
),
streets AS (SELECT *, {fx.street_sql('address')} AS street FROM parcels),
gaps AS (
  SELECT t.target_id, t.is_land, t.t_acres, t.t_street, t.east, p.property_id, p.address, p.property_type AS raw_type, p.assessed_value,
         {acres} AS acres, p.street, {_GAPS.format(a='t', b='p')},
         sqrt(power(greatest(abs(p.x0 - t.cx), abs(p.x1 - t.cx)) * t.east, 2)
              + power(greatest(abs(p.y0 - t.cy), abs(p.y1 - t.cy)) * 111320e0, 2)) AS far
  FROM targets t JOIN streets p ON p.property_id <> t.target_id
),
measured AS (
  SELECT *, sqrt(power(dx * east, 2) + power(dy * 111320e0, 2)) AS d, {_SIMILAR.format(a='t_acres', b='acres')} AS alike,
         {kind} AS kind FROM gaps
),
reasons AS (
  SELECT *, concat_ws('|', CASE WHEN {touch} THEN 'geometric' END, CASE WHEN d <= 100 AND alike THEN 'near_similar_size' END,
                   CASE WHEN {street} THEN 'near_same_street' END) AS found_via
  FROM measured WHERE {reach}
),
judged AS (
  SELECT *, CASE WHEN NOT ({screen}) THEN 'shape' WHEN found_via = '' THEN 'no_reason'
                 WHEN address IS NULL OR trim(address) = '' THEN 'blank_address' WHEN NOT {size_ok} THEN 'size'
                 WHEN raw_type IS NOT NULL AND NOT coalesce(kind IN ('Single Family', 'Vacant Land'), false) THEN 'type' END AS reject_reason
  FROM reasons
),
comps AS (SELECT * FROM judged WHERE reject_reason IS NULL)"""


def _results_sql(profile: str) -> str:
    service = profile == "service"
    land = "false" if service else "coalesce(r.property_type = 'Land', false)"
    recheck = "true" if service else "(c.is_land OR " + _SIMILAR.format(
        a="round_even(c.t_acres * 100, 0) / 100", b="round_even(c.acres * 100, 0) / 100") + ")"
    price = "price" if service else "nullif(price, 0)"
    return f"""
used AS (SELECT * FROM comps c WHERE kind = 'Single Family' AND assessed_value IS NOT NULL AND {recheck}),
stats AS (
  SELECT target_id, is_land, median(assessed_value) AS comp_median, min(assessed_value) AS comp_min, max(assessed_value) AS comp_max,
         CAST(count(*) AS INTEGER) AS comp_count, string_agg(property_id, '|' ORDER BY property_id) AS comp_ids
  FROM used GROUP BY target_id, is_land
),
gap_base AS (
  SELECT r.*, s.comp_median, s.comp_min, s.comp_max, coalesce(s.comp_count, 0) AS comp_count, s.comp_ids, s.comp_count IS NOT NULL AS has_comps,
         t.t_value AS target_assessed_value, s.comp_median - {price} AS gap
  FROM resolved r JOIN targets t ON t.target_id = r.target_id AND t.is_land = {land}
  LEFT JOIN stats s ON s.target_id = r.target_id AND s.is_land = t.is_land
),
pcts AS (SELECT *, gap / nullif(price, 0) * 100e0 AS gap_pct FROM gap_base),
medians AS (SELECT property_type, median(gap_pct) AS mid FROM pcts WHERE has_comps GROUP BY property_type),
results AS (
  SELECT p.*, CASE WHEN has_comps THEN gap_pct - mid END AS relative_gap_pct
  FROM pcts p LEFT JOIN medians m ON p.property_type IS NOT DISTINCT FROM m.property_type
)"""


SERVICE = [_resolve_sql("service"), _comps_sql("service"), _results_sql("service")]
BATCH = [_resolve_sql("batch"), _comps_sql("batch"), _results_sql("batch")]


def sql(body: str, profile: str = "service") -> str:
    return fx.with_frames(body, *(SERVICE if profile == "service" else BATCH))


def run(
    spark: SparkSession, sf_dir: str, profile: str = "service", keep_rejected: bool = False, comp_columns: list[str] | None = None
) -> Rc.GapRun:
    return Rc.run_gaps(
        fx.stored_listings(spark, sf_dir), fx.stored_parcels(spark, sf_dir), profile, keep_rejected=keep_rejected, comp_columns=comp_columns
    )


# --- spatial joins ----------------------------------------------------------------------------


@query("index_parcels", fx.with_frames("""
SELECT property_id, round(ring_acres, 6) AS acres, round(cy, 9) AS lat, 1 AS parts, 0 AS holes, round(x1, 9) AS xmax,
       %s AS street FROM parcels""" % fx.street_sql("address")))
def index_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = Sp.index_parcels(fx.parcels(spark, sf_dir))
    return indexed.select(
        "property_id", r6("net_acres").alias("acres"), F.round("center.lat", 9).alias("lat"), "parts", "holes",
        F.round("box.xmax", 9).alias("xmax"), F.col("street_ascii").alias("street"),
    )


@query("box_join", fx.with_frames(f"""
SELECT target_id, property_id, round(sqrt(power(dx * east, 2) + power(dy * 111320e0, 2)), 3) AS metres FROM (
  SELECT a.property_id AS target_id, b.property_id, cos(radians(a.cy)) * 111320e0 AS east, {_GAPS.format(a='a', b='b')}
  FROM parcels a JOIN parcels b ON a.property_id <> b.property_id)
WHERE sqrt(power(dx * east, 2) + power(dy * 111320e0, 2)) <= 250"""))
def box_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.stored_parcels(spark, sf_dir).select("property_id", "geometry", "box", "center")
    left = rows.select(
        F.col("property_id").alias("target_id"), F.col("geometry").alias("t_geometry"), F.col("center.lat").alias("t_lat"),
        grid.widen(F.col("box"), 250.0, F.col("center.lat")).alias("search"),
    )
    pairs = grid.box_join(
        left, rows.drop("center"), "search", "box", "target_id", "property_id", F.col("target_id") != F.col("property_id")
    )
    metres = boundary_distance_m("t_geometry", "geometry", "t_lat")
    return pairs.select("target_id", "property_id", metres.alias("m")).where("m <= 250").select(
        "target_id", "property_id", F.round("m", 3).alias("metres")
    )


# On the ellipsoid a rectangle's area is its width times the difference of authalic latitudes.
_E2 = "0.006694379990141316e0"
_E = "0.08181919084262149e0"
_AUTHALIC = "(sin(radians({y})) / (1 - _E2 * power(sin(radians({y})), 2)) - ln((1 - _E * sin(radians({y}))) / (1 + _E * sin(radians({y})))) / (2 * _E)) * (1 - _E2)"


@query("area_acres_wgs84", fx.with_frames(f"""
SELECT property_id, round((radians(x1) - radians(x0)) * ({_AUTHALIC.format(y='y1')} - {_AUTHALIC.format(y='y0')}) * 6378137e0 * 6378137e0 / 2 / 4046.8564224e0, 4) AS acres
FROM parcels""".replace("_E2", _E2).replace("_E", _E)))
def area_acres_wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored_parcels(spark, sf_dir).select("property_id", F.round("net_acres_wgs84", 4).alias("acres"))


@query("nearby_wgs84", fx.with_frames(f"""
SELECT query_id, property_id, round(m, 3) AS metres FROM (
  SELECT query_id, property_id,
         sqrt(power(greatest(0e0, x0 - lon, lon - x1) * cos(radians(lat)) * 111319.49079327358e0 / sqrt(w), 2)
         + power(greatest(0e0, y0 - lat, lat - y1) * 111319.49079327358e0 * (1 - {_E2}) / (w * sqrt(w)), 2)) AS m
  FROM parcels, (SELECT *, 1 - {_E2} * power(sin(radians(lat)), 2) AS w FROM (
    SELECT s_suppkey AS query_id, -71.5e0 + (s_suppkey % 40) * 0.0012e0 + 0.0004e0 AS lon, 43.0e0 + (s_suppkey // 3 % 50) * 0.0008e0 + 0.0003e0 AS lat FROM supplier)))
WHERE m <= 400"""))
def nearby_wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.nearby(fx.stored_parcels(spark, sf_dir), _points(spark, sf_dir), 400.0, earth="wgs84")
    return found.select("query_id", "property_id", F.round("distance_meters", 3).alias("metres"))


# One query point per supplier, somewhere on the lot grid.
_POINT_LON = "-71.5e0 + (s_suppkey % 40) * 0.0012e0 + 0.0004e0"
_POINT_LAT = "43.0e0 + (s_suppkey {div} 3 % 50) * 0.0008e0 + 0.0003e0"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS query_id", f"{_POINT_LON} AS lon", f"{_POINT_LAT.format(div='div')} AS lat"
    )


def _nearby_sql(radius: int, where: str) -> str:
    return fx.with_frames(f"""
SELECT query_id, property_id, round(m, 3) AS metres FROM (
  SELECT query_id, property_id, property_type, sqrt(power(greatest(0e0, x0 - lon, lon - x1) * cos(radians(lat)) * 111320e0, 2)
         + power(greatest(0e0, y0 - lat, lat - y1) * 111320e0, 2)) AS m
  FROM parcels, (SELECT s_suppkey AS query_id, {_POINT_LON} AS lon, {_POINT_LAT.format(div='//')} AS lat FROM supplier))
WHERE m <= {radius} AND {where}""")


@query("nearby", _nearby_sql(400, "true"))
def nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.nearby(fx.stored_parcels(spark, sf_dir), _points(spark, sf_dir), 400.0)
    return found.select("query_id", "property_id", F.round("distance_meters", 3).alias("metres"))


@query("endpoint_nearby", _nearby_sql(300, "property_type IN ('Single Family', 'Vacant Land')"))
def endpoint_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.endpoint_nearby(fx.stored_parcels(spark, sf_dir), _points(spark, sf_dir), -1.0)
    return found.select("query_id", "property_id", F.round("distance_meters", 3).alias("metres"))


def _register_profile(profile: str) -> None:
    """The resolve, comps and gap queries of one rule set."""

    @query(f"resolve_parcel_{profile}", sql("SELECT listing_id, target_id, resolve_method FROM resolved", profile))
    def resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = Sp.resolve_parcel(fx.stored_listings(spark, sf_dir), fx.stored_parcels(spark, sf_dir), profile)
        return found.select("listing_id", "target_id", "resolve_method")

    @query(f"find_comps_{profile}", sql("""
SELECT target_id, is_land, property_id, round(d, 3) AS metres, found_via, kind AS property_type,
       CASE WHEN raw_type IS NOT NULL THEN true END AS comp_eligible, round(acres, 6) AS acres FROM comps""", profile))
    def comps(spark: SparkSession, sf_dir: str) -> DataFrame:
        parcels = fx.stored_parcels(spark, sf_dir)
        resolved = Rc.materialize(Sp.resolve_parcel(fx.stored_listings(spark, sf_dir), parcels, profile))
        found = Sp.find_comps(Sp.target_parcels(resolved, parcels, profile), parcels, profile)
        return found.select(
            "target_id", "is_land", "property_id", F.round("distance_m", 3).alias("metres"),
            joined("found_via").alias("found_via"), "property_type", "comp_eligible", r6("acres").alias("acres"),
        )

    @query(f"compute_gap_{profile}", sql("""
SELECT listing_id, target_id, has_comps, round(comp_median, 4) AS comp_median, comp_min, comp_max, comp_count, comp_ids,
       round(gap, 4) AS gap, round(gap_pct, 6) AS gap_pct, round(relative_gap_pct, 6) AS relative_gap_pct, target_assessed_value
FROM results""", profile))
    def results(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = run(spark, sf_dir, profile).results
        return out.select(
            "listing_id", "target_id", "has_comps", F.round("comp_median", 4).alias("comp_median"), "comp_min", "comp_max",
            "comp_count", joined("comp_property_ids").alias("comp_ids"), F.round("gap", 4).alias("gap"),
            r6("gap_pct").alias("gap_pct"), r6("relative_gap_pct").alias("relative_gap_pct"), "target_assessed_value",
        )

    @query(f"rank_gaps_{profile}", sql(f"""
SELECT listing_id, property_type, rank() OVER (PARTITION BY property_type ORDER BY gap DESC NULLS LAST) AS rank
FROM results WHERE has_comps {"" if profile == "service" else "AND property_type IN ('Single Family', 'Land')"}""", profile))
    def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranked = Gp.rank_gaps(run(spark, sf_dir, profile).results, profile)
        return ranked.select("listing_id", "property_type", "rank")

    @query(f"place_gaps_{profile}", sql(f"""
SELECT listing_id, property_type, row_number() OVER (PARTITION BY property_type ORDER BY gap DESC NULLS LAST, listing_id) AS place
FROM results WHERE has_comps {"" if profile == "service" else "AND property_type IN ('Single Family', 'Land')"}""", profile))
    def places(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Places are stored with the rows given, so only the columns in use are.
        results = run(spark, sf_dir, profile).results.select("listing_id", "property_type", "has_comps", "gap")
        return Gp.place_gaps(results, profile).select("listing_id", "property_type", "place")

    @query(f"report_frame_{profile}", sql("""
SELECT r.listing_id, CASE WHEN has_comps THEN NULL ELSE 'no_comps' END AS error, round(gap_pct, 6) AS gap_pct,
       count(c.property_id) AS candidates, count(u.property_id) AS used, round(coalesce(sum(c.assessed_value), 0), 2) AS total_value
FROM results r LEFT JOIN comps c ON c.target_id = r.target_id AND c.is_land = LAND
LEFT JOIN used u ON u.target_id = c.target_id AND u.is_land = c.is_land AND u.property_id = c.property_id
GROUP BY r.listing_id, has_comps, gap_pct""".replace(
        "LAND", "false" if profile == "service" else "coalesce(r.property_type = 'Land', false)"), profile))
    def report(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = Rp.report_frame(run(spark, sf_dir, profile), profile)
        used = F.filter("candidates", lambda c: c["used"])
        total = F.aggregate("candidates", F.lit(0.0), lambda acc, c: acc + F.coalesce(c["value"], F.lit(0.0)))
        return frame.select(
            "listing_id", "error", r6("gap_summary.gap_pct").alias("gap_pct"),
            F.size("candidates").cast("bigint").alias("candidates"), F.size(used).cast("bigint").alias("used"),
            F.round(total, 2).alias("total_value"),
        )

    @query(f"candidate_report_{profile}", sql("""
SELECT (SELECT count(*) FROM wanted) AS eligible, (SELECT count(*) FROM results) AS resolved,
       (SELECT count(*) FROM wanted) - (SELECT count(*) FROM results) AS unresolved,
       count(*) FILTER (reject_reason = 'blank_address') AS excluded_blank_address,
       count(*) FILTER (reject_reason = 'size') AS excluded_size, count(*) FILTER (reject_reason = 'type') AS excluded_type,
       count(*) FILTER (reject_reason IS NULL AND raw_type IS NULL AND property_id IS NOT NULL) AS kept_without_type,
       2 * (SELECT count(*) FROM results) AS points_and_targets,
       2 * count(*) FILTER (reject_reason IS NULL AND property_id IS NOT NULL) AS neighbours_and_lines
FROM (SELECT r.listing_id, j.* FROM results r LEFT JOIN judged j ON j.target_id = r.target_id AND j.is_land = LAND)""".replace(
        "LAND", "false" if profile == "service" else "coalesce(r.property_type = 'Land', false)"), profile))
    def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
        listings = fx.stored_listings(spark, sf_dir)
        eligible = Sp.eligible_listings(listings) if profile == "batch" else listings
        return Rp.candidate_report(run(spark, sf_dir, profile, True, ["comp_eligible"]), eligible, profile)


_register_profile("service")
_register_profile("batch")


@query("containing_parcels", sql("SELECT listing_id, property_id, round(acres, 6) AS acres FROM contained"))
def containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.containing_parcels(fx.stored_listings(spark, sf_dir), fx.stored_parcels(spark, sf_dir))
    return found.select("listing_id", "property_id", r6("computed_acres").alias("acres"))


@query("unresolved_listings", sql("SELECT listing_id, resolve_method FROM resolved WHERE target_id IS NULL", "batch"))
def unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.resolve_parcel(fx.stored_listings(spark, sf_dir), fx.stored_parcels(spark, sf_dir), "batch")
    return Sp.unresolved_listings(found).select("listing_id", "resolve_method")


@query("merge_reasons", sql("SELECT target_id, property_id, found_via FROM comps"))
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run(spark, sf_dir).comps.select("target_id", "property_id", F.explode("found_via").alias("reason"))
    touching, near = found.where("reason = 'geometric'"), found.where("reason <> 'geometric'")
    order = F.array(F.lit("geometric"), F.lit("near_similar_size"), F.lit("near_same_street"))
    out = merge_reasons(touching, near)
    return out.select(
        "target_id", "property_id",
        joined(F.filter(order, lambda r: F.array_contains("found_via", r))).alias("found_via"),
    )


# --- ranking and stored results --------------------------------------------------------------------


@query("without_comps", sql("SELECT listing_id FROM results WHERE NOT has_comps"))
def without_comps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gp.without_comps(run(spark, sf_dir).results).select("listing_id")


@query("relative_gap", """
SELECT o_orderkey AS listing_id, round(o_totalprice - median(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS relative
FROM orders""")
def relative_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("listing_id"), F.col("o_orderpriority").alias("property_type"),
        F.col("o_totalprice").alias("gap_pct"), F.lit(True).alias("has_comps"),
    )
    return Gp.relative_gap(rows).select("listing_id", F.round("relative_gap_pct", 4).alias("relative"))


@query("top_n_per_type", sql("""
SELECT listing_id, property_type, round(gap, 4) AS gap FROM results WHERE has_comps
QUALIFY row_number() OVER (PARTITION BY property_type ORDER BY gap DESC NULLS LAST, listing_id) <= 25"""))
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = run(spark, sf_dir).results.where("has_comps")
    return Gp.top_n_per_type(results, 25).select("listing_id", "property_type", F.round("gap", 4).alias("gap"))


@query("rank_sections", sql("""
SELECT listing_id, property_type, row_number() OVER w AS place, coalesce(year_built >= 2020, false) AS newer_construction,
       greatest(count(*) OVER (PARTITION BY property_type) - 15, 0) AS more
FROM results WHERE has_comps AND property_type IN ('Single Family', 'Land')
WINDOW w AS (PARTITION BY property_type ORDER BY gap DESC NULLS LAST, listing_id) QUALIFY row_number() OVER w <= 15""", "batch"))
def rank_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Gp.rank_sections(run(spark, sf_dir, "batch").results)
    return rows.select("listing_id", "property_type", F.col("place").cast("bigint").alias("place"), "newer_construction", "more")


@query("write_ranked_csv", sql("""
SELECT row_number() OVER (ORDER BY property_type = 'Single Family', gap DESC NULLS LAST, listing_id) AS place,
       address_line_1 AS address, property_type, year_built, round(target_assessed_value, 2) AS target_assessed_value,
       CAST(NULL AS DOUBLE) AS recent_sale_price, round(price, 2) AS price, round(comp_median, 3) AS comp_median, comp_count,
       round(comp_min, 2) AS comp_min, round(comp_max, 2) AS comp_max, round(gap, 3) AS gap, round(gap_pct, 5) AS gap_pct,
       round(relative_gap_pct, 5) AS relative_gap_pct
FROM results WHERE has_comps AND property_type IN ('Single Family', 'Land')""", "batch"))
def ranked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.scratch(spark)
    results = run(spark, sf_dir, "batch").results.withColumnRenamed("address_line_1", "address")
    Wr.write_ranked_csv(results, folder)
    schema = ", ".join(f"{n} {'string' if n in ('address', 'property_type') else 'double'}" for n in Wr.RANKED_COLUMNS)
    back = spark.read.option("header", True).schema(schema).csv(folder)
    # Files follow each other by name, lines by their place in the file.
    lines = back.withColumns({"_all": F.lit(0), "_file": F.col("_metadata.file_name"), "_start": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()})
    lines = row_numbers(lines, "_all", [F.col("_file"), F.col("_start"), F.col("_line")], "place")
    place = F.col("place").cast("bigint").alias("place")
    cents = {n: F.round(n, d).alias(n) for d, names in ((2, ("target_assessed_value", "price", "comp_min", "comp_max")), (3, ("comp_median", "gap")), (5, ("gap_pct", "relative_gap_pct"))) for n in names}
    whole = {n: F.col(n).cast("int").alias(n) for n in ("comp_count", "year_built")}
    return lines.select(place, *[(cents | whole).get(n, F.col(n)) for n in Wr.RANKED_COLUMNS])


@query("recompute_summary", sql("""
SELECT (SELECT count(*) FROM listings) AS total_listings, count(*) AS computed, count(*) FILTER (has_comps) AS with_comps FROM results"""))
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gp.recompute_summary(fx.stored_listings(spark, sf_dir), run(spark, sf_dir).results)


@query("gap_for_listing", sql("SELECT listing_id, target_id, round(gap, 4) AS gap, comp_count FROM results WHERE listing_id = 'L77'"))
def gap_for_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Rc.gap_for_listing(fx.stored_listings(spark, sf_dir), fx.stored_parcels(spark, sf_dir), "L77")
    return out.select("listing_id", "target_id", F.round("gap", 4).alias("gap"), "comp_count")


# An older snapshot: some parcels are missing, some worth less; some listings are missing, some dearer.
@query("recompute_changes", sql("""
SELECT listing_id, target_id, has_comps, comp_count, round(gap, 4) AS gap, round(relative_gap_pct, 6) AS relative_gap_pct FROM results"""))
def recompute_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels, listings = fx.stored_parcels(spark, sf_dir), fx.stored_listings(spark, sf_dir)
    h, g = F.pmod(F.xxhash64("property_id"), F.lit(500)), F.pmod(F.xxhash64("listing_id"), F.lit(300))
    old_parcels = parcels.where(h != 0).withColumn("assessed_value", F.when(h == 1, F.col("assessed_value") / 2).otherwise(F.col("assessed_value")))
    old_listings = listings.where(g != 0).withColumn("price", F.when(g == 1, F.col("price") + 1000).otherwise(F.col("price")))
    stored = Rc.materialize(Rc.run_gaps(old_listings, old_parcels).results)
    out = Ic.recompute_changes(stored, old_listings, listings, old_parcels, parcels).results
    return out.select("listing_id", "target_id", "has_comps", "comp_count", F.round("gap", 4).alias("gap"), r6("relative_gap_pct").alias("relative_gap_pct"))


# --- the same searches over the table stored by place ---------------------------------------------


@query("stored_gap_for_listing", sql("SELECT listing_id, target_id, round(gap, 4) AS gap, comp_count FROM results WHERE listing_id = 'L77'"))
def stored_gap_for_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Rc.gap_for_listing(fx.stored_listings(spark, sf_dir), fx.parcel_tiles(spark, sf_dir), "L77")
    return out.select("listing_id", "target_id", F.round("gap", 4).alias("gap"), "comp_count")


@query("stored_find_comps", sql("""
SELECT target_id, property_id, round(d, 3) AS metres, found_via FROM comps"""))
def stored_find_comps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Rc.run_gaps(fx.stored_listings(spark, sf_dir), fx.parcel_tiles(spark, sf_dir)).comps
    return found.select("target_id", "property_id", F.round("distance_m", 3).alias("metres"), joined("found_via").alias("found_via"))


@query("stored_resolve_parcel", sql("SELECT listing_id, target_id, resolve_method FROM resolved", "batch"))
def stored_resolve_parcel(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.resolve_parcel(fx.stored_listings(spark, sf_dir), fx.parcel_tiles(spark, sf_dir), "batch")
    return found.select("listing_id", "target_id", "resolve_method")


@query("stored_nearby", _nearby_sql(400, "true"))
def stored_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Sp.nearby(fx.parcel_tiles(spark, sf_dir), _points(spark, sf_dir), 400.0)
    return found.select("query_id", "property_id", F.round("distance_meters", 3).alias("metres"))


# One state is recomputed over a table that holds a stale row for every listing.
@query("recompute", sql("""
SELECT l.listing_id, coalesce(r.has_comps, false) AS has_comps, CASE WHEN r.listing_id IS NULL THEN -1 ELSE r.comp_count END AS comp_count,
       round(r.gap_pct - m.mid, 6) AS relative_gap_pct
FROM listings l LEFT JOIN results r ON r.listing_id = l.listing_id AND upper(l.state) = 'NH'
LEFT JOIN (SELECT property_type, median(gap_pct) AS mid FROM results WHERE has_comps AND upper(state) = 'NH' GROUP BY property_type) m
  ON m.property_type = r.property_type AND r.has_comps"""))
def recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = fx.stored_listings(spark, sf_dir)
    stale = fill_schema(listings.select("listing_id", F.lit(False).alias("has_comps"), F.lit(-1).alias("comp_count")), schemas.GAP_RESULTS)
    table, _ = Rc.recompute(listings, fx.stored_parcels(spark, sf_dir), stale, "nh")
    return table.select("listing_id", "has_comps", "comp_count", r6("relative_gap_pct").alias("relative_gap_pct"))


@query("ranked_query", sql("""
SELECT listing_id, formatted_address AS address, property_type, round(gap, 4) AS gap, comp_count FROM results
WHERE state = 'NH' AND has_comps QUALIFY row_number() OVER (PARTITION BY property_type ORDER BY gap DESC NULLS FIRST, listing_id) <= 40"""))
def ranked_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Gp.gap_rows(run(spark, sf_dir).results, now())
    found = L.ranked_query(stored, fx.stored_listings(spark, sf_dir), "NH", limit=40)
    return found.select("listing_id", "address", "property_type", F.round("gap", 4).alias("gap"), "comp_count")


# --- reports -----------------------------------------------------------------------------------------


@query("map_features", sql("""
SELECT kind, count(*) AS features, count(DISTINCT listing_id) AS listings FROM (
  SELECT 'listing' AS kind, listing_id FROM results WHERE latitude IS NOT NULL
  UNION ALL SELECT 'target', listing_id FROM results
  UNION ALL SELECT CASE WHEN u.property_id IS NULL THEN 'excluded' ELSE 'used' END, r.listing_id FROM results r
    JOIN comps c ON c.target_id = r.target_id AND c.is_land = coalesce(r.property_type = 'Land', false)
    LEFT JOIN used u ON u.target_id = c.target_id AND u.is_land = c.is_land AND u.property_id = c.property_id
  UNION ALL SELECT 'hookline', r.listing_id FROM results r
    JOIN used u ON u.target_id = r.target_id AND u.is_land = coalesce(r.property_type = 'Land', false) WHERE latitude IS NOT NULL)
GROUP BY kind""", "batch"))
def map_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = Rp.map_features(run(spark, sf_dir, "batch"), "batch")
    return features.groupBy("kind").agg(
        F.count("geometry").alias("features"), F.count_distinct("listing_id").alias("listings")
    )


@query("map_popups", sql("""
SELECT listing_id, '<b>' || coalesce(address_line_1, 'None') || '</b><br>$' || format('{:,}', CAST(round_even(coalesce(price, 0), 0) AS BIGINT))
       || ' | ' || property_type AS popup FROM results WHERE latitude IS NOT NULL""", "batch"))
def map_popups(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = Rp.map_features(run(spark, sf_dir, "batch"), "batch")
    return features.where("kind = 'listing'").select("listing_id", "popup")


@query("listing_groups", """
SELECT o_custkey AS listing_id, arg_max(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS listing_point,
       arg_max(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'O') AS target_parcel,
       string_agg(o_orderkey, '|' ORDER BY o_orderkey) FILTER (o_orderstatus = 'P') AS neighbors
FROM orders WHERE o_custkey % 10 <> 0 GROUP BY o_custkey""")
def listing_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").select(
        F.expr("CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END").alias("listing_id"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'listing_point' WHEN 'O' THEN 'target_parcel' ELSE 'neighbor_parcel' END").alias("feature_type"),
        F.col("o_orderkey").alias("feature"),
    )
    out = Rp.listing_groups(rows, ["feature"])
    return out.select("listing_id", "listing_point", "target_parcel", F.nullif(joined("neighbors"), F.lit("")).alias("neighbors"))
