"""Gap analytics: comps to medians, gaps, ranks and report rows."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from parcel_comps import fixed_values as fixed
from parcel_comps.functions import scalars as S
from parcel_comps.operators.skew import group_median, row_numbers, skew_join, value_ranks
from parcel_comps.plans.checkpoints import materialize
from parcel_comps.profiles import Profile, get_profile

# Medians that are broadcast to the results; more are joined by shuffles.
FEW_GROUPS = 10_000


def used_comps(comps: DataFrame, profile: str | Profile = "service") -> Column:
    """Does a comp count towards the median: a valued home of comparable size?"""
    p = get_profile(profile)
    used = (F.col("property_type") == fixed.VALUE_COMP_TYPE) & F.col("assessed_value").isNotNull()
    if p.recheck_size:
        size_ok = S.lot_size_similar(S.round2("t_acres"), S.round2("acres")) | F.col("is_land")
        used = used & size_ok
    return F.coalesce(used, F.lit(False))


def comp_statistics(comps: DataFrame, profile: str | Profile = "service") -> DataFrame:
    """Median, extremes, count and ids of the used comps of each target parcel."""
    used = comps.where(used_comps(comps, profile))
    gathered = used.groupBy("target_id", "is_land").agg(
        F.array_sort(F.collect_list("property_id")).alias("comp_property_ids"),
        F.array_sort(F.collect_list("assessed_value")).alias("comp_values"),
    )
    n = F.size("comp_values")

    def at(place: Column) -> Column:
        return F.element_at("comp_values", place.cast("int"))

    half = [at(F.floor((n + k) / 2)).cast("double") * 0.5 for k in (1, 2)]
    return gathered.select(
        "target_id", "is_land", (half[0] + half[1]).alias("comp_median"), at(F.lit(1)).alias("comp_min"), at(n).alias("comp_max"),
        n.alias("comp_count"), "comp_property_ids", "comp_values",
    )


def target_statistics(comps: DataFrame, targets: DataFrame, profile: str | Profile = "service") -> DataFrame:
    """``comp_statistics`` of every target, beside its own value and size."""
    values = targets.select(
        "target_id", "is_land", F.col("t_assessed_value").alias("target_assessed_value"),
        F.col("t_acres").alias("target_acres"),
    )
    return values.join(comp_statistics(comps, profile), ["target_id", "is_land"], "left")


def compute_gap(
    resolved: DataFrame,
    comps: DataFrame,
    targets: DataFrame,
    profile: str | Profile = "service",
) -> DataFrame:
    """One gap result per resolved listing: median of used comps minus price.

    The comps of a parcel are reduced once and joined to all its listings. Listings
    without usable comps have ``has_comps`` false and NULL statistics. A missing
    price gives no gap, a price of 0 no percentage (and in the batch rules no gap).
    """
    p = get_profile(profile)
    land = F.coalesce(F.col("property_type") == "Land", F.lit(False))
    listings = resolved.where("target_id is not null").withColumn("is_land", land if p.skip_size_for_land else F.lit(False))
    per_target = target_statistics(comps, targets, p)
    return gap_columns(skew_join(listings, per_target, ["target_id", "is_land"], ["listing_id"]), p).drop("is_land")


def gap_columns(joined: DataFrame, profile: str | Profile = "service") -> DataFrame:
    """The gap of each listing from the statistics beside it."""
    p = get_profile(profile)
    price = F.nullif("price", F.lit(0.0)) if p.name == "batch" else F.col("price")
    gap = F.col("comp_median") - price
    has_comps = F.col("comp_count").isNotNull()
    return joined.withColumns(
        {
            "target_is_land": F.coalesce(F.col("property_type") == "Land", F.lit(False)),
            "has_comps": has_comps,
            "comp_count": F.coalesce("comp_count", F.lit(0)),
            "gap": gap,
            "gap_pct": F.try_divide(gap, F.col("price")) * 100.0,
            "error": F.when(~has_comps, F.lit("no_comps")),
        }
    )


def relative_gap(results: DataFrame, scope: str = "property_type") -> DataFrame:
    """Add ``relative_gap_pct``: percent gap minus the exact median of its type.

    The median is over exactly the rows given, so what is ranked together is the
    caller's choice.
    """
    medians = materialize(group_median(results.where("has_comps"), scope, "gap_pct", "_group_median"))
    if medians.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        # Few medians go to the results, which then stay where they are.
        few = F.broadcast(medians.withColumnRenamed(scope, "_scope"))
        joined = results.join(few, F.col(scope).eqNullSafe(F.col("_scope")), "left")
    else:
        joined = skew_join(results, medians, [scope], ["listing_id"], null_safe=True)
    relative = F.when(F.col("has_comps"), F.col("gap_pct") - F.col("_group_median"))
    return joined.withColumn("relative_gap_pct", relative).select(
        *results.columns, "relative_gap_pct"
    )


def gap_rows(results: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Results in the layout of the stored gap table."""
    stamp = computed_at if computed_at is not None else F.current_timestamp()
    return results.select(
        "listing_id", "has_comps", "target_assessed_value", "comp_median", "comp_min",
        "comp_max", "comp_count", "comp_property_ids", "gap", "gap_pct", "relative_gap_pct",
        stamp.alias("computed_at"),
    )


def rank_gaps(results: DataFrame, profile: str | Profile = "service") -> DataFrame:
    """Results with comps and their ``rank`` per property type, largest gap first.

    Equal gaps share a rank; results without a gap come last. Ranks are counted from
    value totals (see ``value_ranks``), so one type may hold any number of listings.
    The batch rules keep Land and Single Family only.
    """
    p = get_profile(profile)
    ranked = results.where("has_comps")
    if p.eligible_listings_only:
        ranked = ranked.where(F.col("property_type").isin(fixed.LISTING_TYPES))
    # Missing gaps take part as a value below all others.
    ranked = ranked.withColumn("_gap", F.coalesce("gap", F.lit(-sys.float_info.max)))
    ranks = value_ranks(ranked, "property_type", "_gap").select(
        "property_type", "_gap", (F.col("n_above") + 1).alias("rank")
    )
    return skew_join(ranked, ranks, ["property_type", "_gap"], ["listing_id"], null_safe=True).drop("_gap")


def place_gaps(results: DataFrame, profile: str | Profile = "service") -> DataFrame:
    """Results with comps and their ``place`` per property type: largest gap first, ties by listing id, missing gaps last."""
    p = get_profile(profile)
    ranked = results.where("has_comps")
    if p.eligible_listings_only:
        ranked = ranked.where(F.col("property_type").isin(fixed.LISTING_TYPES))
    return row_numbers(ranked, "property_type", [F.col("gap").desc_nulls_last(), F.col("listing_id").asc_nulls_last()], "place")


def without_comps(results: DataFrame) -> DataFrame:
    """The unranked rest: results with no usable comps."""
    return results.where(~F.col("has_comps"))


def top_n_per_type(results: DataFrame, n: int | None, nulls_last: bool = True) -> DataFrame:
    """The first ``n`` results per type by gap, ties by listing id; ``None`` keeps all.

    Spark limits every partition to ``n`` rows per type before the shuffle.
    """
    if n is None:
        return results
    gap = F.col("gap").desc_nulls_last() if nulls_last else F.col("gap").desc_nulls_first()
    order = W.Window.partitionBy("property_type").orderBy(gap, "listing_id")
    return (
        results.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= n).drop("_row")
    )


def rank_sections(results: DataFrame, n: int = fixed.REPORT_ROWS) -> DataFrame:
    """Top ``n`` per report block with the new-construction flag and how many more there are."""
    rows = results.where(F.col("has_comps") & F.col("property_type").isin(fixed.LISTING_TYPES))
    order = W.Window.partitionBy("property_type").orderBy(
        F.col("gap").desc_nulls_last(), "listing_id"
    )
    top = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    # Two block types at most, so the counts are two rows.
    totals = rows.groupBy("property_type").agg(F.count(F.lit(1)).alias("_total"))
    more = F.greatest(F.col("_total") - F.lit(n), F.lit(0))
    return (
        top.join(F.broadcast(totals), "property_type")
        .withColumn("block", F.when(F.col("property_type") == "Land", 1).otherwise(2))
        .withColumn("newer_construction", S.newer_construction_flag("year_built"))
        .withColumn("more", more)
        .drop("_total")
    )


def recompute_summary(listings: DataFrame, results: DataFrame) -> DataFrame:
    """Listings given, results computed, results with comps."""
    total = listings.agg(F.count(F.lit(1))).scalar()
    return results.agg(
        F.count(F.lit(1)).alias("computed"), F.count_if("has_comps").alias("with_comps")
    ).select(total.alias("total_listings"), "computed", "with_comps")
