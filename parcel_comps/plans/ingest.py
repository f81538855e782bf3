"""Ingest jobs for parcels and listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import schemas
from parcel_comps.operators.linkage import link_assessments
from parcel_comps.operators.lookup import active_listings
from parcel_comps.operators.normalize import (
    fill_schema,
    normalize_ct,
    normalize_listing,
    normalize_ma,
    normalize_nh,
)
from parcel_comps.operators.quality import disambiguate_ids, town_counts, validate_records
from parcel_comps.plans.versions import Table, upsert_into


def normalize_parcels(
    features: DataFrame,
    state: str,
    mapping: DataFrame,
    town: str | Column | None = None,
    source_date: Column | None = None,
) -> DataFrame:
    """Raw features of one state to parcel records with distinct ids per town."""
    state = state.upper()
    if state == "CT":
        rows = normalize_ct(features, mapping, town, source_date=source_date)
        # By content, so that an id survives other splits, other folders and other clusters.
        spread = [c for c in rows.columns if not c.startswith("_")]
        rows = disambiguate_ids(rows, "property_id", "_OBJECTID", ["municipality"], spread)
        rows = rows.drop("_OBJECTID")
    elif state == "MA":
        rows = normalize_ma(features, mapping, town, source_date=source_date)
    elif state == "NH":
        rows = normalize_nh(features, town, source_date=source_date)
    else:
        raise ValueError(f"no normaliser for state {state!r}")
    return rows


def link_features(features: DataFrame, assessments: DataFrame) -> DataFrame:
    """New Hampshire features with their assessment written into ``properties``."""
    parsed = features.withColumn("_p", F.from_json("properties", schemas.NH_PROPERTIES))
    own = [n for n in schemas.NH_PROPERTIES.fieldNames() if n not in (
        "total_market_value", "vgsi_location", "mblu", "acres", "land_use_desc", "match_method")]
    flat = parsed.select(
        *[F.col(f"_p.{n}").alias(n) for n in own],
        *[c for c in features.columns if c != "properties"],
    )
    linked = link_assessments(flat, assessments)
    return linked.select(
        F.to_json(F.struct(*schemas.NH_PROPERTIES.fieldNames())).alias("properties"),
        *[c for c in features.columns if c != "properties"],
    )


@dataclass
class ParcelIngest:
    """The new table and the reports of one ingest: counts of gaps, and of rows per expected town."""

    table: Table
    records: DataFrame
    towns: DataFrame | None


def run_parcel_ingest(
    features: DataFrame,
    state: str,
    mapping: DataFrame,
    target: Table,
    order: list[str],
    town: str | Column | None = None,
    now: Column | None = None,
    source_date: Column | None = None,
    towns: DataFrame | None = None,
) -> ParcelIngest:
    """Normalise, check and upsert the features of all towns of a state in one job.

    A stored ``target`` (``VersionedTable``) gets a new version, in which only the parts of these towns are rewritten.

    ``towns`` (``municipality``) lists what was expected; without it there is no town report.
    """
    rows = normalize_parcels(features, state, mapping, town, source_date)
    records = validate_records(rows)
    counts = None if towns is None else town_counts(rows, towns, ["municipality"])
    extra = [F.col(c) for c in order]
    full = fill_schema(rows).select("*") if not extra else rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.PROPERTY_VALUES.fields
        ],
        *extra,
    )
    table = upsert_into(target, full, ["property_id"], order, stamp="loaded_at", now=now)
    return ParcelIngest(table, records, counts)


def ingest_parcels(
    features: DataFrame,
    state: str,
    mapping: DataFrame,
    target: Table,
    order: list[str],
    town: str | Column | None = None,
    now: Column | None = None,
    source_date: Column | None = None,
) -> Table:
    """The table of ``run_parcel_ingest`` alone."""
    return run_parcel_ingest(features, state, mapping, target, order, town, now, source_date).table


def ingest_listings(
    raw: DataFrame,
    target: Table,
    source: str,
    order: list[str],
    state: str,
    city: str | None = None,
    types: list[str] | None = None,
    now: Column | None = None,
) -> Table:
    """Upsert the active listings of landed provider pages."""
    rows = normalize_listing(active_listings(raw, state, city, types), source)
    return upsert_into(target, rows, ["listing_id"], order, stamp="fetched_at", now=now)
