"""The gap job: listings and parcels in, ranked gaps out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.scalars import empty_to_null
from parcel_comps.operators.gaps import gap_columns, gap_rows, relative_gap, target_statistics
from parcel_comps.operators.lookup import find_listing, find_listings
from parcel_comps.operators.skew import skew_join
from parcel_comps.operators.spatial import (
    Parcels,
    count_places,
    eligible_listings,
    find_comps,
    place_columns,
    resolve_places,
    shapes_of,
    target_parcels,
)
from parcel_comps.plans.checkpoints import materialize
from parcel_comps.plans.versions import Table, upsert_into
from parcel_comps.profiles import Profile, get_profile

#: What medians take from each comp.
VALUE_COLUMNS = ("target_id", "is_land", "property_id", "property_type", "assessed_value", "t_acres", "acres")


@dataclass
class GapRun:
    """The stages of one run; ``results`` has a row per resolved listing."""

    resolved: DataFrame
    targets: DataFrame
    comps: DataFrame
    results: DataFrame
    #: Polygons by ``shape_id``, for reports; all those of the parcels given.
    shapes: DataFrame


def named_listings(listings: DataFrame) -> DataFrame:
    """Listings without id under their first address line."""
    named = F.coalesce(empty_to_null(F.col("listing_id").cast("string")), F.col("address_line_1"))
    return listings.withColumn("listing_id", named.cast(listings.schema["listing_id"].dataType))


def run_gaps(
    listings: DataFrame,
    parcels: Parcels,
    profile: str | Profile = "service",
    close_m: float = fixed.CLOSE_RADIUS_M,
    far_m: float = fixed.FAR_RADIUS_M,
    tol: float = fixed.SIZE_RATIO,
    keep_rejected: bool = False,
    comp_columns: list[str] | None = None,
) -> GapRun:
    """Resolve every listing, find comps once per distinct parcel, compute all gaps.

    All but the price follows from a listing's place, so places are resolved and valued, and each listing moves once, to its
    place. Places, targets, comps and gap rows are read several times further on (distinct
    targets, hot keys, medians, reports), so all are materialised. A listing without id
    goes by its first address line. ``comps`` has all columns of ``find_comps``, or ``comp_columns`` and those that medians need: every
    rejected neighbour in reach is a row, so a run that only counts them should store little of each.
    """
    p = get_profile(profile)
    listings = named_listings(listings)
    if p.eligible_listings_only:
        listings = eligible_listings(listings)
    keys, rows = place_columns(p), listings
    if p.skip_size_for_land:
        keys, rows = [*keys, "is_land"], listings.withColumn("is_land", F.coalesce(F.col("property_type") == "Land", F.lit(False)))
    places = materialize(count_places(rows, keys))
    if not p.skip_size_for_land:
        places = places.withColumn("is_land", F.lit(False))
    places = materialize(resolve_places(places, parcels, p).select(*keys, *({"is_land"} - {*keys}), "_n", "target_id", "resolve_method"))
    targets = materialize(target_parcels(places, parcels, p))
    comps = find_comps(targets, parcels, p, close_m, far_m, tol, keep_rejected)
    if comp_columns is not None:
        kept_columns = {*VALUE_COLUMNS, *comp_columns, *(["reject_reason"] if keep_rejected else [])}
        comps = comps.select(*[c for c in comps.columns if c in kept_columns])
    comps = materialize(comps)
    kept = comps.where("reject_reason is null") if keep_rejected else comps
    valued = skew_join(places.drop("_n"), target_statistics(kept, targets, p), ["target_id", "is_land"], place_columns(p))
    if not p.skip_size_for_land:
        valued = valued.drop("is_land")
    found = skew_join(rows, valued, keys, ["listing_id"], null_safe=True, counts=places.select(*keys, "_n"))
    gaps = materialize(gap_columns(found, p).drop("is_land"))
    resolved = gaps.select(*listings.columns, "target_id", "resolve_method")
    return GapRun(resolved, targets, comps, relative_gap(gaps.where("target_id is not null")), shapes_of(parcels))


def gap_for_listing(
    listings: DataFrame, parcels: Parcels, listing_id: str, profile: str | Profile = "service"
) -> DataFrame:
    """The gap of one listing; no row if it does not exist or resolve."""
    return run_gaps(find_listing(listings, listing_id), parcels, profile).results.drop(
        "relative_gap_pct"
    )


def recompute(
    listings: DataFrame,
    parcels: Parcels,
    gap_results: Table,
    state: str,
    city: str | None = None,
    zip_code: str | None = None,
    property_type: str | None = None,
    profile: str | Profile = "service",
) -> tuple[Table, DataFrame]:
    """Recompute the matching listings; returns (new gap table, results of this run).

    Relative gaps are taken within the listings recomputed together.
    """
    wanted = find_listings(listings, state, city, zip_code, property_type)
    results = run_gaps(wanted, parcels, profile).results
    updated = upsert_into(gap_results, gap_rows(results), ["listing_id"], ["computed_at"])
    return updated, results
