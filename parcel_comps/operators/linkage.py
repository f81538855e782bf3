"""Record linkage: parcels to assessments, missing addresses, address look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.addresses import (
    address_variants,
    mblu_key,
    normalize_address,
    parcel_key,
)
from parcel_comps.functions.scalars import empty_to_null, is_blank, strip
from parcel_comps.operators.skew import skew_join
from parcel_comps.operators.store import last_wins

_ASSESSED = ["total_market_value", "location", "mblu", "acres", "land_use_desc"]


def unique_index(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Rows whose key occurs exactly once; a repeated key is dropped altogether.

    NULL and empty keys are ignored. The counting combines map-side, so a key
    shared by very many rows costs one row per task.
    """
    keyed = df.withColumn(name, key).where(F.col(name).isNotNull())
    if dict(keyed.dtypes)[name] == "string":
        keyed = keyed.where(F.col(name) != "")
    row = F.struct(*[F.col(c) for c in df.columns])
    counted = keyed.groupBy(name).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
    return counted.where("_n = 1").select(name, "_row.*")


def collision_report(df: DataFrame, key: Column, sample: int = 5) -> DataFrame:
    """Number of keys held by several rows, the rows affected, and a few such keys."""
    counts = (
        df.select(key.alias("key"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    totals = counts.agg(
        F.count(F.lit(1)).alias("colliding_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("affected_rows"),
    )
    few = counts.orderBy("key").limit(sample).agg(
        F.array_sort(F.collect_list("key")).alias("sample_keys")
    )
    # Two one-row frames side by side.
    return totals.select("*", few.scalar().alias("sample_keys"))


def link_assessments(parcels: DataFrame, assessments: DataFrame, how: str = "left") -> DataFrame:
    """Attach assessments to parcels (``PID``, ``StreetAddress``).

    The map/block/lot/unit key decides; only parcels it leaves unmatched try their
    normalised address. Keys or addresses shared by several assessments match
    nothing. Every parcel is kept unless ``how`` is "inner".
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    rows = assessments.select(*_ASSESSED)
    row = F.struct(*_ASSESSED)
    by_key = unique_index(rows, mblu_key("mblu"), "_key").select("_key", row.alias("_by_key"))
    by_address = unique_index(
        rows, normalize_address("location", unicode=True), "_address"
    ).select("_address", row.alias("_by_address"))
    spread = ["PID", "StreetAddress"]
    keyed = parcels.withColumn("_key", parcel_key(F.col("PID").cast("string")))
    linked = skew_join(keyed, by_key, ["_key"], spread)
    # A matched row has no address key, so it passes the second join untouched.
    # Hot addresses are counted on the parcels, not on the outcome of the first join.
    address = empty_to_null(normalize_address("StreetAddress", unicode=True))
    linked = linked.withColumn("_address", F.when(F.col("_by_key").isNull(), address))
    all_addresses = parcels.select(address.alias("_address"))
    linked = skew_join(linked, by_address, ["_address"], spread, count_on=all_addresses)
    match = F.coalesce("_by_key", "_by_address")
    method = F.when(F.col("_by_key").isNotNull(), "mblu").when(
        F.col("_by_address").isNotNull(), "address"
    )
    result = linked.select(
        *parcels.columns,
        match["total_market_value"].alias("total_market_value"),
        match["location"].alias("vgsi_location"),
        match["mblu"].alias("mblu"),
        match["acres"].alias("acres"),
        match["land_use_desc"].alias("land_use_desc"),
        method.alias("match_method"),
    )
    return result.where("match_method is not null") if how == "inner" else result


def match_report(linked: DataFrame, sample: int = 10) -> DataFrame:
    """Totals by match method, the match rate, a low-rate flag and a few unmatched ids."""
    matched = F.count("match_method")
    total = F.count(F.lit(1))
    rate = F.coalesce(F.try_divide(matched.cast("double"), total), F.lit(0.0))
    totals = linked.agg(
        total.alias("total_parcels"),
        F.count_if(F.col("match_method") == "mblu").alias("matched_mblu"),
        F.count_if(F.col("match_method") == "address").alias("matched_address"),
        F.count_if(F.col("match_method").isNull()).alias("unmatched"),
        rate.alias("match_rate"),
        (rate < fixed.MIN_MATCH_RATE).alias("low_match_rate"),
    )
    few = linked.where("match_method is null").select("PID").orderBy("PID").limit(sample)
    ids = few.agg(F.array_sort(F.collect_list("PID")).alias("sample_unmatched"))
    return totals.select("*", ids.scalar().alias("sample_unmatched"))


def missing_addresses(parcels: DataFrame, assessments: DataFrame, order: list[str]) -> DataFrame:
    """Parcel addresses no assessment has, in the spelling that comes first by ``order``."""
    expected = (
        parcels.where(~is_blank("StreetAddress"))
        .withColumn("address_key", normalize_address("StreetAddress", unicode=True))
        .where("address_key <> ''")
        .groupBy("address_key")
        .agg(F.min_by(strip("StreetAddress"), F.struct(*order)).alias("address"))
    )
    found = (
        assessments.select(normalize_address("location", unicode=True).alias("address_key"))
        .where("address_key <> ''")
        .distinct()
    )
    return expected.join(found, "address_key", "left_anti")


def choose_lookup(addresses: DataFrame, results: DataFrame) -> DataFrame:
    """Pick one search result per ``address`` over its spelling variants.

    ``results`` holds the answers of an address search: ``query``, ``position`` (its
    place in the answer, from 0), ``value`` and ``id``. The earliest variant that has
    a candidate with exactly its own normalised text, or has only one candidate,
    decides. Failing that the first candidate of the first answered variant is taken
    as ambiguous, with up to five candidate texts; no answer at all is no_match, and so
    is a missing address.
    """
    exact = normalize_address("value", unicode=True) == normalize_address("query", unicode=True)
    texts = F.collect_list(F.when(F.col("position") < 5, F.struct("position", "value")))
    per_query = results.groupBy("query").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct("id", "value"), F.when(exact, F.col("position"))).alias("_exact"),
        F.min_by(F.struct("id", "value"), "position").alias("_first"),
        F.transform(F.array_sort(texts), lambda t: t["value"]).alias("_texts"),
    )
    # min_by passes over rows without an ordering value: no exact candidate gives NULL.
    per_query = per_query.select(
        F.col("query").alias("variant"),
        F.struct(
            (F.col("_exact").isNotNull() | (F.col("_n") == 1)).alias("clear"),
            F.coalesce("_exact", "_first").alias("pick"),
            F.col("_texts").alias("texts"),
        ).alias("answer"),
    )
    variants = addresses.select("address").distinct().select(
        "address", F.posexplode_outer(address_variants("address")).alias("variant_no", "variant")
    )
    answered = skew_join(variants, per_query, ["variant"], ["address"])
    best = answered.groupBy("address").agg(
        F.min(
            F.when(F.col("answer.clear"), F.struct("variant_no", "variant", "answer.pick"))
        ).alias("clear"),
        F.min(
            F.when(
                F.col("answer").isNotNull(),
                F.struct("variant_no", "variant", "answer.pick", "answer.texts"),
            )
        ).alias("any"),
    )
    chosen = F.coalesce("clear.pick", "any.pick")
    used = F.coalesce("clear.variant", "any.variant")
    return best.select(
        "address",
        F.when(F.col("clear").isNotNull(), "ok")
        .when(F.col("any").isNotNull(), "ambiguous")
        .otherwise("no_match")
        .alias("status"),
        F.when(used != F.col("address"), used).alias("via"),
        chosen["id"].alias("id"),
        chosen["value"].alias("value"),
        F.when(F.col("clear").isNull(), F.col("any.texts")).alias("candidates"),
    )


def lookup_report(lookups: DataFrame) -> DataFrame:
    """Look-ups per status; statuses that did not occur are counted as 0."""
    counts = [
        F.count_if(F.col("status") == status).alias(status)
        for status in ("ok", "ambiguous", "no_match")
    ]
    long = "stack(3, 'ok', ok, 'ambiguous', ambiguous, 'no_match', no_match) as (status, lookups)"
    return lookups.agg(*counts).selectExpr(long)


def attach_by_id(
    df: DataFrame, attributes: DataFrame, key: str, columns: list[str], order: list[str]
) -> DataFrame:
    """Left-join attribute columns by trimmed id; the last row per id wins."""
    trimmed = attributes.withColumn("_id", strip(F.col(key).cast("string")))
    kept = list(dict.fromkeys(["_id", *columns, *order]))
    lookup = last_wins(trimmed.select(*kept), ["_id"], order)
    keyed = df.withColumn("_id", strip(F.col(key).cast("string")))
    return skew_join(keyed, lookup.select("_id", *columns), ["_id"], [key]).select(
        *df.columns, *columns
    )


def combine_sources(sequential: DataFrame, targeted: DataFrame) -> DataFrame:
    """Assessment rows of both passes in one frame, each tagged with its pass."""
    return sequential.withColumn("match_source", F.lit("sequential")).unionByName(
        targeted.withColumn("match_source", F.lit("targeted"))
    )


def merge_reasons(*found: DataFrame) -> DataFrame:
    """Union of (target_id, property_id, reason) frames, one row per pair with all reasons."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("target_id", "property_id").agg(
        F.array_sort(F.collect_set("reason")).alias("found_via")
    )
