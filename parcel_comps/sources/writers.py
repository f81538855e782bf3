"""Writers for feature files, map layers and ranked tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import schemas
from parcel_comps.functions.geometry import to_multipolygon
from parcel_comps.functions.scalars import town_slug
from parcel_comps.operators.skew import hot_keys, with_salt

RANKED_COLUMNS = [
    "address", "property_type", "year_built", "target_assessed_value", "recent_sale_price",
    "price", "comp_median", "comp_count", "comp_min", "comp_max", "gap", "gap_pct",
    "relative_gap_pct",
]


def feature_json(geometry: Column, properties: Column) -> Column:
    """One GeoJSON feature as text."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            geometry.alias("geometry"),
            properties.alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )


def parcel_features(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Normalised parcels as (state, town, feature text)."""
    properties = F.struct(*schemas.PARCEL_RECORD.fieldNames())
    return df.select(
        F.lower("state").alias("state"),
        town_slug("municipality").alias("town"),
        "property_id",
        feature_json(to_multipolygon(geometry), properties).alias("value"),
    )


def write_features(
    df: DataFrame, path: str, file_rows: int = 250_000, geometry: str = "geometry"
) -> None:
    """Features of every town under ``state=../town=..``, one feature per line.

    Rows are shuffled by town. A town with more than ``file_rows`` rows is split by a
    hash of the property id, so its size decides how many tasks write it.
    """
    keys = ["state", "town"]
    features = parcel_features(df, geometry)
    salted = with_salt(features, hot_keys(features, keys, file_rows), keys, ["property_id"])
    shuffled = salted.repartition(*keys, "_salt").drop("_salt", "property_id")
    shuffled.write.partitionBy(*keys).option("maxRecordsPerFile", file_rows).text(path)


def split_layers(features: DataFrame) -> DataFrame:
    """Tag features (``geometry`` JSON text) with their map layer.

    Polygons and MultiPolygons share a layer and are both written as MultiPolygon. Other
    geometries, and rows without one, are in the layer "other".
    """
    kind = F.get_json_object("geometry", "$.type")
    layer = (
        F.when(kind == "Point", "points")
        .when(kind.isin("Polygon", "MultiPolygon"), "polygons")
        .when(kind == "LineString", "lines")
        .otherwise("other")
    )
    promoted = F.concat(
        F.lit('{"type":"MultiPolygon","coordinates":['),
        F.get_json_object("geometry", "$.coordinates"),
        F.lit("]}"),
    )
    return features.withColumn("layer", layer).withColumn(
        "geometry", F.when(kind == "Polygon", promoted).otherwise(F.col("geometry"))
    )


def write_feature_layers(features: DataFrame, path: str) -> None:
    """Points, polygons, lines and others under ``layer=..``; reading ``path`` itself gives all of them."""
    split_layers(features).write.partitionBy("layer").json(path)


def ranked_table(results: DataFrame) -> DataFrame:
    """The 13 report columns of ranked results, Land first, then Single Family."""
    block = F.when(F.col("property_type") == "Land", 0).when(
        F.col("property_type") == "Single Family", 1
    )
    rows = results.withColumn("recent_sale_price", F.lit(None).cast("double"))
    return rows.where(block.isNotNull() & F.col("has_comps")).orderBy(
        block, F.col("gap").desc_nulls_last(), "listing_id"
    ).select(*RANKED_COLUMNS)


def write_ranked_csv(results: DataFrame, path: str) -> None:
    """Ranked results as CSV parts in order; the sort is a range shuffle, not one task."""
    writer = ranked_table(results).write.option("header", True)
    # Blank addresses are kept as they are.
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
