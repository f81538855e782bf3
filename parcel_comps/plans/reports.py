"""Report frames: nested results per listing, map features, candidate counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.geometry import (
    hookline,
    point_geojson,
    to_multipolygon,
)
from parcel_comps.functions.scalars import lot_size_similar, round2, unit_style_address
from parcel_comps.operators.gaps import used_comps
from parcel_comps.operators.skew import skew_join
from parcel_comps.operators.spatial import with_shape
from parcel_comps.plans.recompute import GapRun
from parcel_comps.profiles import Profile, get_profile


def _is_land(profile: Profile) -> Column:
    land = F.coalesce(F.col("property_type") == "Land", F.lit(False))
    return (land if profile.skip_size_for_land else F.lit(False)).alias("is_land")


def target_candidates(run: GapRun, profile: str | Profile = "service") -> DataFrame:
    """One row per (target, candidate), with ``used``, ``size_ok`` and marker position; no polygons yet."""
    p = get_profile(profile)
    size_ok = lot_size_similar(round2("t_acres"), round2("acres"))
    if p.skip_size_for_land:
        size_ok = size_ok | F.col("is_land")
    comps = run.comps
    if "reject_reason" in comps.columns:
        comps = comps.where("reject_reason is null")
    return comps.select(
        "target_id", "is_land", "property_id",
        F.col("address").alias("comp_address"),
        F.col("raw_type").alias("land_use_desc"),
        round2("acres").alias("acres"),
        size_ok.alias("size_ok"),
        F.col("assessed_value").alias("value"),
        F.array_join("found_via", "+").alias("found_via"),
        used_comps(comps, p).alias("used"),
        "comp_eligible",
        unit_style_address("address").alias("has_unit_style_address"),
        "marker",
        "distance_m",
        "shape_id",
    )


def listing_candidates(run: GapRun, profile: str | Profile = "service") -> DataFrame:
    """``target_candidates`` of every listing, beside its place, with ``comp_geometry``.

    Polygons join the candidates of each target, not those of each listing, of which there are many times more.
    """
    drawn = with_shape(target_candidates(run, profile), run.shapes, "shape_id", "comp_geometry", "left")
    listings = run.resolved.where("target_id is not null").select(
        "listing_id", "target_id", _is_land(get_profile(profile)), "longitude", "latitude",
    )
    return skew_join(
        listings, drawn, ["target_id", "is_land"], ["listing_id"], how="inner"
    ).drop("is_land", "target_id")


def report_frame(run: GapRun, profile: str | Profile = "service") -> DataFrame:
    """Per listing: the target, every candidate used or not, and the summary or the error.

    Candidates and their polygons are gathered once for each target, however many listings it has.
    """
    candidate = F.struct(
        F.col("property_id").alias("pid"), F.col("comp_address").alias("address"),
        "land_use_desc", "acres", "size_ok", "value", "found_via", "used",
        F.col("marker.lat").alias("lat"), F.col("marker.lon").alias("lon"),
        to_multipolygon("comp_geometry").alias("geometry"),
    )
    key = ["target_id", "is_land"]
    drawn = with_shape(target_candidates(run, profile), run.shapes, "shape_id", "comp_geometry", "left")
    # One target's own neighbours: bounded by what lies within the search radius.
    candidates = drawn.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("property_id", candidate.alias("c")))).alias("_all")
    )
    listed = run.results.withColumn("is_land", _is_land(get_profile(profile)))
    joined = skew_join(listed, candidates, key, ["listing_id"], count_on=run.resolved.select("target_id", _is_land(get_profile(profile))))
    target = F.struct(
        F.col("address_line_1").alias("address"), "property_type", "price", "square_footage",
        "year_built", "latitude", "longitude", "target_acres", "target_assessed_value",
    )
    summary = F.struct("comp_count", "comp_median", "comp_min", "comp_max", "gap", "gap_pct")
    return joined.select(
        "listing_id",
        target.alias("target"),
        "error",
        F.transform(
            F.coalesce("_all", F.array().cast(candidates.schema["_all"].dataType)),
            lambda e: e["c"],
        ).alias("candidates"),
        F.when(F.col("has_comps"), summary).alias("gap_summary"),
    )


def _money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 0))


def _feature(kind: Column | str, geometry: Column, popup: Column) -> list[Column]:
    return [
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        F.to_json(geometry).alias("geometry"),
        popup.alias("popup"),
    ]


def map_features(run: GapRun, profile: str | Profile = "service") -> DataFrame:
    """Map features of every listing: its point, its parcel, its candidates and hooklines."""
    candidates = listing_candidates(run, profile)
    results = run.results
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    points = results.where(located).select(
        "listing_id",
        *_feature(
            "listing",
            point_geojson("longitude", "latitude"),
            F.concat(
                F.lit("<b>"), F.coalesce("address_line_1", F.lit("None")), F.lit("</b><br>"),
                _money(F.coalesce("price", F.lit(0.0))), F.lit(" | "),
                F.coalesce("property_type", F.lit("None")),
            ),
        ),
    )
    assessed = F.when(
        F.coalesce("target_assessed_value", F.lit(0.0)) != 0, _money(F.col("target_assessed_value"))
    ).otherwise(F.lit(fixed.POPUP_TEXTS["no_value"]))
    shapes = run.targets.select("target_id", "t_shape").dropDuplicates(["target_id"])
    # A target without a polygon is drawn as a feature without one.
    shapes = with_shape(shapes, run.shapes, "t_shape", "t_geometry", "left")
    targets = skew_join(results, shapes, ["target_id"], ["listing_id"], how="inner").select(
        "listing_id",
        *_feature(
            "target",
            to_multipolygon("t_geometry"),
            F.concat(F.lit(fixed.POPUP_TEXTS["target"]), assessed),
        ),
    )
    value = F.when(F.col("value").isNotNull(), _money(F.col("value"))).otherwise(fixed.POPUP_TEXTS["no_value"])
    shown = F.when(F.col("used"), fixed.POPUP_TEXTS["used"]).otherwise(fixed.POPUP_TEXTS["unused"])
    parcels = candidates.select(
        "listing_id",
        *_feature(
            F.when(F.col("used"), "used").otherwise("excluded"),
            to_multipolygon("comp_geometry"),
            F.concat(
                F.lit("<b>"), F.coalesce("comp_address", F.lit("")), F.lit("</b><br>"),
                F.coalesce("land_use_desc", F.lit("?")), F.lit(" | "),
                F.coalesce(F.col("acres").cast("string"), F.lit("None")), F.lit(" ac<br>"),
                value, F.lit("<br>"), shown,
            ),
        ),
    )
    lines = candidates.where(F.col("used") & F.col("latitude").isNotNull()).select(
        "listing_id",
        *_feature(
            "hookline",
            hookline("longitude", "latitude", "marker.lon", "marker.lat"),
            F.lit(""),
        ),
    )
    return points.unionByName(targets).unionByName(parcels).unionByName(lines)


def candidate_report(
    run: GapRun, eligible: DataFrame, profile: str | Profile = "service"
) -> DataFrame:
    """Counts of a run made with ``keep_rejected``: listings, exclusions per reason, features.

    Exclusions count once per listing, as every listing repeats its parcel's candidates.
    """
    p = get_profile(profile)
    reason = F.col("reject_reason")
    per_target = run.comps.groupBy("target_id", "is_land").agg(
        F.count_if(reason == "blank_address").alias("blank_address"),
        F.count_if(reason == "size").alias("size"),
        F.count_if(reason == "type").alias("type"),
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason.isNull() & F.col("comp_eligible").isNull()).alias("untyped"),
    )
    land = F.coalesce(F.col("property_type") == "Land", F.lit(False))
    resolved = run.resolved.where("target_id is not null").withColumn(
        "is_land", land if p.skip_size_for_land else F.lit(False)
    )
    listings = resolved.groupBy("target_id", "is_land").agg(F.count(F.lit(1)).alias("listings"))
    joined = listings.join(per_target, ["target_id", "is_land"], "left")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.col(name) * F.col("listings")), F.lit(0)).alias(name)

    totals = joined.agg(
        F.coalesce(F.sum("listings"), F.lit(0)).alias("resolved"),
        *[total(name) for name in ("blank_address", "size", "type", "untyped", "kept")],
    )
    n_eligible = eligible.agg(F.count(F.lit(1))).scalar()
    return totals.select(
        n_eligible.alias("eligible"),
        "resolved",
        (n_eligible - F.col("resolved")).alias("unresolved"),
        F.col("blank_address").alias("excluded_blank_address"),
        F.col("size").alias("excluded_size"),
        F.col("type").alias("excluded_type"),
        F.col("untyped").alias("kept_without_type"),
        # A point and a parcel per listing, a parcel and a line per candidate.
        (F.col("resolved") * 2).alias("points_and_targets"),
        (F.col("kept") * 2).alias("neighbours_and_lines"),
    )


def listing_groups(features: DataFrame, order: list[str]) -> DataFrame:
    """Regroup tagged features by listing: its point, its target, its neighbours.

    ``features`` has ``listing_id``, ``feature_type`` and ``feature``. The last point
    and target by ``order`` win; rows without a listing id are skipped.
    """
    rank = F.struct(*order)

    def last(kind: str) -> Column:
        return F.max_by("feature", F.when(F.col("feature_type") == kind, rank))

    neighbour = F.when(
        F.col("feature_type") == "neighbor_parcel", F.struct(rank.alias("at"), "feature")
    )
    return features.where("listing_id is not null").groupBy("listing_id").agg(
        last("listing_point").alias("listing_point"),
        last("target_parcel").alias("target_parcel"),
        F.transform(F.array_sort(F.collect_list(neighbour)), lambda e: e["feature"]).alias(
            "neighbors"
        ),
    )
