"""Filtered lookups over listings, parcel values and stored gap results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps.operators.gaps import top_n_per_type

_FOLDED = "_folded"
_GAP_COLUMNS = [
    "target_assessed_value", "comp_median", "comp_min", "comp_max", "comp_count", "gap",
    "gap_pct", "relative_gap_pct",
]


def _given(value: str | None) -> bool:
    return value is not None and value.strip() != ""


def _same(df: DataFrame, column: str, value: str) -> Column:
    """Equality whatever the case; by the stored folded key, which scans can skip by, where there is one."""
    key = f"{column}{_FOLDED}"
    return (F.col(key) if key in df.columns else F.upper(column)) == F.upper(F.lit(value))


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(_FOLDED)])


def write_for_lookups(df: DataFrame, path: str, columns: list[str]) -> None:
    """Store a table with folded keys of ``columns``, sorted by them and with bloom filters over them.

    Look-ups on the stored table compare the keys, so row groups without a value are not read.
    """
    keys = [f"{c}{_FOLDED}" for c in columns]
    folded = df.withColumns({k: F.upper(c) for k, c in zip(keys, columns, strict=True)})
    writer = folded.repartitionByRange(*keys).sortWithinPartitions(*keys).write
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
    writer.parquet(path)


def find_listings(
    listings: DataFrame,
    state: str,
    city: str | None = None,
    zip_code: str | None = None,
    property_type: str | None = None,
) -> DataFrame:
    """Listings of a state, newest first. Blank options are no predicate; zip is exact."""
    found = listings.where(_same(listings, "state", state))
    if _given(city):
        found = found.where(_same(found, "city", city))
    if _given(zip_code):
        found = found.where(F.col("zip_code") == zip_code)
    if _given(property_type):
        found = found.where(_same(found, "property_type", property_type))
    return _plain(found).orderBy(F.col("listed_date").desc_nulls_last())


def find_listing(listings: DataFrame, listing_id: str) -> DataFrame:
    return listings.where(F.col("listing_id") == listing_id).limit(1)


def find_property_values(
    parcels: DataFrame,
    state: str,
    municipality: str | None = None,
    city: str | None = None,
    zip_code: str | None = None,
    property_type: str | None = None,
) -> DataFrame:
    """Parcel values of a state by id, without the geometry column."""
    found = parcels.where(_same(parcels, "state", state))
    for column, value in (("municipality", municipality), ("city", city)):
        if _given(value):
            found = found.where(_same(found, column, value))
    if _given(zip_code):
        found = found.where(F.col("zip") == zip_code)
    if _given(property_type):
        found = found.where(_same(found, "property_type", property_type))
    return _plain(found.drop("geometry")).orderBy("property_id")


def distinct_state_city(listings: DataFrame) -> DataFrame:
    return listings.select("state", "city").distinct().orderBy(
        F.asc_nulls_last("state"), F.asc_nulls_last("city")
    )


def distinct_towns(features: DataFrame, field: str) -> DataFrame:
    """Distinct non-empty town names of raw features, sorted; ``field`` is the property name."""
    town = F.get_json_object("properties", f"$.{field}")
    return features.select(town.alias("town")).where("town <> ''").distinct().orderBy("town")


def active_listings(
    listings: DataFrame,
    state: str,
    city: str | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    """Raw provider listings that are active, of a state, optionally a city and types."""
    found = listings.where((F.col("status") == "Active") & (F.col("state") == state))
    if _given(city):
        found = found.where(F.col("city") == city)
    if types:
        found = found.where(F.col("propertyType").isin(types))
    return found


def ranked_query(
    gap_results: DataFrame,
    listings: DataFrame,
    state: str,
    city: str | None = None,
    zip_code: str | None = None,
    property_type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Stored gaps of a state's listings by type and gap; ``limit`` applies per type."""
    wanted = listings.where(F.col("state") == state)
    for column, value in (
        ("city", city), ("zip_code", zip_code), ("property_type", property_type),
    ):
        if value is not None:
            wanted = wanted.where(F.col(column) == value)
    wanted = wanted.select(
        "listing_id", F.col("formatted_address").alias("address"), "property_type", "year_built",
        "price",
    )
    stored = gap_results.where("has_comps").select("listing_id", *_GAP_COLUMNS)
    rows = top_n_per_type(wanted.join(stored, "listing_id"), limit, nulls_last=False)
    return rows.orderBy(F.asc_nulls_last("property_type"), F.desc_nulls_first("gap"), "listing_id")
