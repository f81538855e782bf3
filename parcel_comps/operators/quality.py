"""Checks on normalised parcels: duplicate ids, required columns, empty towns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import schemas
from parcel_comps.functions.scalars import empty_to_null
from parcel_comps.operators.skew import skew_join


def disambiguate_ids(
    df: DataFrame, id_col: str, object_id: str, within: list[str], spread: list[str]
) -> DataFrame:
    """Append ``#OBJECTID<n>`` to ids that occur more than once inside ``within``.

    NULL ids are left alone. A row without an object id gets a hash of its
    ``spread`` columns instead, so its id does not change between runs.
    """
    keys = [*within, id_col]
    repeated = (
        df.where(F.col(id_col).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(*keys, F.lit(True).alias("_repeated"))
    )
    marked = skew_join(df, repeated, keys, spread)
    number = F.col(object_id).cast("string")
    # An object id of 0 counts as missing.
    has_number = F.coalesce((number != "") & (number != "0"), F.lit(False))
    suffix = F.when(has_number, F.concat(F.lit("#OBJECTID"), number)).otherwise(
        F.concat(F.lit("#"), F.hex(F.xxhash64(*spread)))
    )
    return marked.withColumn(
        id_col, F.when(F.col("_repeated"), F.concat(F.col(id_col), suffix)).otherwise(F.col(id_col))
    ).select(*df.columns)


def validate_records(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Raise if a common column is missing; else count rows, missing ids and geometries."""
    missing = sorted(set(schemas.PARCEL_RECORD.fieldNames()) - set(df.columns))
    if missing:
        raise ValueError(f"records lack required columns: {missing}")
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(empty_to_null("parcel_id").isNull()).alias("no_parcel_id"),
        F.count_if(F.col(geometry).isNull()).alias("no_geometry"),
    )


def town_counts(df: DataFrame, towns: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per expected town, with towns that have none flagged."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    records: Column = F.coalesce("_n", F.lit(0))
    return towns.join(counts, keys, "left").select(
        *towns.columns, records.alias("records"), (records == 0).alias("empty_town")
    )
