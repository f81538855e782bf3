"""Recompute only what two snapshots can have changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.addresses import normalize_address
from parcel_comps.functions.geodesy import FLAT_EXCESS
from parcel_comps.operators import grid
from parcel_comps.operators.gaps import relative_gap
from parcel_comps.operators.spatial import Parcels, attributes_of, point_boxes
from parcel_comps.plans.checkpoints import materialize
from parcel_comps.plans.recompute import named_listings, run_gaps
from parcel_comps.profiles import Profile, get_profile


@dataclass
class ChangedGaps:
    """Results for all listings of the new snapshot, and the ids of those that were searched again."""

    results: DataFrame
    searched: DataFrame


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys that only one frame has or whose rows differ. Rows are compared by 128 bits over all columns of ``new``."""
    columns = sorted(c for c in new.columns if c != key)

    def prints(df: DataFrame, name: str) -> DataFrame:
        own = [F.col(c) for c in columns]
        return df.select(F.col(key), F.struct(F.xxhash64(*own), F.xxhash64(F.lit(1), *own)).alias(name))

    both = prints(old, "_old").join(prints(new, "_new"), key, "full_outer")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(key)


def affected_listings(
    stored: DataFrame, old_listings: DataFrame, new_listings: DataFrame, old_parcels: Parcels, new_parcels: Parcels, profile: Profile, far_m: float
) -> DataFrame:
    """Ids of listings whose result may differ: changed ones, and those that changed parcels can reach.

    A changed parcel reaches the points in its box, old or new, and, as a comp, every target within the far radius. Where
    listings are matched by address, it also reaches those with its address.
    """
    before, after = attributes_of(old_parcels), attributes_of(new_parcels)
    keys = materialize(changed_keys(before.select(after.columns), after, "property_id"))
    places = [df.join(keys, "property_id", "left_semi").select(F.col("property_id").alias("_changed"), "address", "box") for df in (before, after)]
    moved = materialize(places[0].unionByName(places[1]))
    boxes = moved.where("box is not null").select("_changed", "box")
    hit = [changed_keys(old_listings.select(new_listings.columns), new_listings, "listing_id")]
    points = point_boxes(new_listings, profile, "listing_id")
    hit.append(grid.box_join(points, boxes, "_point_box", "box", "listing_id", "_changed", left_is_small=True).select("listing_id"))
    touch_m = profile.touch_tol if profile.touch_unit == "metres" else profile.touch_tol * fixed.METRES_PER_DEGREE
    reach = max(far_m, touch_m) * (FLAT_EXCESS if profile.earth == "wgs84" else 1.0)
    known = stored.select("target_id").distinct()
    targets = before.unionByName(after.select(before.columns)).where("box is not null").select(
        F.col("property_id").alias("target_id"), grid.widen(F.col("box"), reach, F.col("center.lat")).alias("_search")
    ).join(known, "target_id", "left_semi")
    near = grid.box_join(targets, boxes, "_search", "box", "target_id", "_changed").select("target_id").distinct()
    hit.append(stored.join(near, "target_id", "left_semi").select("listing_id"))
    if profile.address_fallback:
        lines = moved.select(normalize_address("address", profile.unicode_words).alias("_line")).where("_line <> ''").distinct()
        own = new_listings.select("listing_id", normalize_address("address_line_1", profile.unicode_words).alias("_line"))
        hit.append(own.join(lines, "_line", "left_semi").select("listing_id"))
    every = hit[0]
    for more in hit[1:]:
        every = every.unionByName(more)
    return every.where("listing_id is not null").distinct()


def recompute_changes(
    stored: DataFrame,
    old_listings: DataFrame,
    new_listings: DataFrame,
    old_parcels: Parcels,
    new_parcels: Parcels,
    profile: str | Profile = "service",
    far_m: float = fixed.FAR_RADIUS_M,
) -> ChangedGaps:
    """What ``run_gaps`` gives for the new snapshot, from its ``stored`` results for the old one.

    Listings and parcels have each id once. Relative gaps, which depend on all results, are computed anew.
    """
    p = get_profile(profile)
    old_listings, new_listings = named_listings(old_listings), named_listings(new_listings)
    searched = materialize(affected_listings(stored, old_listings, new_listings, old_parcels, new_parcels, p, far_m))
    run = run_gaps(new_listings.join(searched, "listing_id", "left_semi"), new_parcels, p, far_m=far_m)
    kept = stored.join(new_listings.select("listing_id"), "listing_id", "left_semi").join(searched, "listing_id", "left_anti")
    gaps = kept.drop("relative_gap_pct").unionByName(run.results.drop("relative_gap_pct"))
    return ChangedGaps(relative_gap(materialize(gaps)), searched)
