"""Readers for landed parcel, listing, assessment and alias files."""

from __future__ import annotations

import warnings

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel_comps import fixed_values as fixed
from parcel_comps import schemas
from parcel_comps.functions.geometry import parse_point
from parcel_comps.functions.scalars import strip


def expand_paths(spark: SparkSession, paths: str | list[str], suffixes: list[str]) -> list[str]:
    """Files as given and the direct children of directories, sorted, per suffix in order.

    Sub-directories are never searched; missing paths and empty directories warn.
    """
    # Each call and each name looked up in the JVM is a round trip, and there may be very many files.
    new_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    found: list[str] = []
    for name in [paths] if isinstance(paths, str) else paths:
        path = new_path(name)
        fs = path.getFileSystem(conf)
        try:
            status = fs.getFileStatus(path)
        except Py4JJavaError as error:
            if "FileNotFoundException" not in error.java_exception.getClass().getName():
                raise
            warnings.warn(f"{name} does not exist, skipped", stacklevel=2)
            continue
        if status.isFile():
            found.append(name)
            continue
        children = sorted(
            status.getPath().toString() for status in fs.listStatus(path) if status.isFile()
        )
        inside = [child for suffix in suffixes for child in children if child.endswith(suffix)]
        if not inside:
            warnings.warn(f"{name} holds no {' / '.join(suffixes)} files", stacklevel=2)
        found.extend(inside)
    return found


def _read_json(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))
    reader = spark.read.schema(schema).option("multiLine", True)
    return reader.json(files).withColumn("_file", F.col("_metadata.file_path"))


def read_features(spark: SparkSession, paths: str | list[str], one_per_line: bool = False) -> DataFrame:
    """FeatureCollection files to one row per feature.

    Columns: ``properties`` and ``geometry`` as JSON text (Esri ``attributes`` count
    as properties), ``_file`` and ``_pos``. With ``one_per_line`` the input is a
    directory written by ``write_features``: one feature per line, so large towns
    are split between tasks.
    """
    if one_per_line:
        lines = spark.read.schema(schemas.FEATURE).json(paths)
        rows = lines.select("*", F.col("_metadata.file_path").alias("_file"))
        return rows.select(
            F.coalesce("properties", "attributes").alias("properties"),
            "geometry",
            "_file",
            F.monotonically_increasing_id().alias("_pos"),
        )
    files = expand_paths(spark, paths, [".geojson"])
    docs = _read_json(spark, files, schemas.FEATURE_COLLECTION)
    return docs.select("_file", F.posexplode("features").alias("_pos", "feature")).select(
        F.coalesce("feature.properties", "feature.attributes").alias("properties"),
        "feature.geometry",
        "_file",
        F.col("_pos").cast("bigint"),
    )


def read_listings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Provider listings from FeatureCollections, arrays or single objects, one row each.

    A feature's Point fills latitude and longitude when its properties carry none.
    """
    files = expand_paths(spark, paths, [".json", ".geojson"])
    schema = T.StructType(
        schemas.RAW_LISTING.fields + schemas.FEATURE_COLLECTION.fields
    )
    docs = _read_json(spark, files, schema)
    names = schemas.RAW_LISTING.fieldNames()
    # Array elements of one file are separate rows here, in file order.
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    plain = docs.where(
        (F.coalesce("type", F.lit("")) != "FeatureCollection")
    ).select(*names, "_file", F.col("_row").alias("_pos"))
    features = (
        docs.where(F.col("type") == "FeatureCollection")
        .select("_file", F.posexplode("features").alias("_pos", "f"))
        .select(
            "_file",
            F.col("_pos").cast("bigint"),
            F.from_json("f.properties", schemas.RAW_LISTING).alias("p"),
            parse_point("f.geometry").alias("xy"),
        )
    )
    use_point = F.col("p.longitude").isNull() & F.col("xy").isNotNull()
    placed = {
        "longitude": F.when(use_point, F.col("xy.x")).otherwise(F.col("p.longitude")),
        "latitude": F.when(use_point, F.col("xy.y")).otherwise(F.col("p.latitude")),
    }
    features = features.select(
        *[placed.get(n, F.col(f"p.{n}")).alias(n) for n in names], "_file", "_pos"
    )
    return plain.unionByName(features)


def read_assessments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Assessment CSV with a header; all seven columns are text, empty is NULL."""
    reader = spark.read.schema(schemas.ASSESSMENTS).option("header", True)
    return reader.option("quote", '"').option("escape", '"').option("multiLine", True).csv(paths)


def read_type_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Alias CSV (``standardized,raw_aliases``) to a checked ``alias -> standardized`` frame."""
    rows = spark.read.schema("standardized string, raw_aliases string").option(
        "header", True
    ).csv(path)
    aliases = rows.select(
        strip("standardized").alias("standardized"),
        F.explode(F.split(F.coalesce("raw_aliases", F.lit("")), r"\|")).alias("alias"),
    )
    names = rows.select(strip("standardized").alias("standardized"))
    return _mapping(aliases, names)


def type_mapping(spark: SparkSession) -> DataFrame:
    """The built-in aliases as a mapping frame."""
    rows = [(alias, name) for name, aliases in fixed.TYPE_ALIASES.items() for alias in aliases]
    aliases = _inline(spark, rows)
    return _mapping(aliases, aliases.select("standardized").distinct())


def older_type_mapping(spark: SparkSession) -> DataFrame:
    """The older table of raw land-use values."""
    return _inline(spark, list(fixed.OLDER_TYPE_ALIASES.items()))


def _inline(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """A literal (alias, standardized) table."""
    pairs = [F.struct(F.lit(a).alias("alias"), F.lit(s).alias("standardized")) for a, s in rows]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def _mapping(aliases: DataFrame, names: DataFrame) -> DataFrame:
    aliases = aliases.select(
        F.lower(strip("alias")).alias("alias"), "standardized", F.lit(0).alias("own")
    ).where("alias <> '' and standardized <> ''")
    # A standard name is its own alias unless something else already claims it.
    own = names.where("standardized <> ''").select(
        F.lower("standardized").alias("alias"), "standardized", F.lit(1).alias("own")
    )
    chosen = (
        aliases.unionByName(own)
        .groupBy("alias")
        .agg(
            F.min_by("standardized", F.struct("own", "standardized")).alias("standardized"),
            F.count_distinct(F.when(F.col("own") == 0, F.col("standardized"))).alias("_names"),
        )
    )
    clash = F.concat(F.lit("alias mapped to more than one standard type: "), F.col("alias"))
    return chosen.select(
        "alias",
        F.when(F.col("_names") > 1, F.raise_error(clash))
        .otherwise(F.col("standardized"))
        .alias("standardized"),
    )
