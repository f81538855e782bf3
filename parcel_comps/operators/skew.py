"""Joins and ranks that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from parcel_comps.plans.checkpoints import materialize

# Rows of one key a single task should take before the key is split.
HOT_ROWS = 1_000_000
# A key is hot only above this share of all rows, so a list of hot keys never has more
# than 100,000 entries, and what stays whole is below it, at any table size.
HOT_SHARE = 100_000
# Value bands in the middle of their groups that are broadcast; more are joined by shuffles.
FEW_BANDS = 20_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more rows than ``hot_rows`` and 1/``HOT_SHARE`` of all, with the ``_splits`` each needs."""
    counts = df.where(_complete(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = F.coalesce(df.agg(F.count(F.lit(1))).scalar(), F.lit(0)) / HOT_SHARE
    most = F.greatest(F.lit(float(hot_rows)), share)
    return counts.where(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_splits"))


def _complete(keys: list[str]) -> Column:
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def with_salt(df: DataFrame, hot: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, a hash of ``spread`` for hot ones and, unbounded, for NULL ones."""
    # Rows with a NULL key match nothing, so their salts need not repeat anywhere.
    splits = F.coalesce("_splits", F.when(~_complete(keys), F.lit(2**31 - 1)))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread), splits), F.lit(0)).cast("int")
    return df.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_splits")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    count_on: DataFrame | None = None,
    null_safe: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that splits hot keys of ``left`` over several tasks.

    Rows of a left key with more than ``hot_rows`` rows are spread by a hash of the
    ``spread`` columns and its right rows are repeated once per split. Left rows
    with a NULL key, which otherwise all land in one task, are spread as well.
    Keys are counted on ``left``, or on ``count_on`` where a frame with at least the
    same keys is cheaper to read. ``how`` is "left" or "inner". With ``null_safe``
    NULL is a key like any other, and ``counts`` may give the number ``_n`` of left rows of each key.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join supports 'left' and 'inner'")
    if null_safe:
        if counts is None:
            counts = (left if count_on is None else count_on).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return _null_safe_join(left, right, keys, spread, how, hot_rows, counts)
    hot = hot_keys(count_on if count_on is not None else left, keys, hot_rows)
    copies = F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)
    repeated = right.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(copies))
    salted = with_salt(left, hot, keys, spread)
    return salted.join(repeated.drop("_splits"), [*keys, "_salt"], how).drop("_salt")


def _null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str, hot_rows: int, counts: DataFrame
) -> DataFrame:
    names = [f"_key{n}" for n in range(len(keys))]

    def other(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in df.columns if c not in keys])

    def meet(mine: list[str], theirs: list[str]) -> Column:
        same = F.lit(True)
        for a, b in zip(mine, theirs):
            same = same & F.col(a).eqNullSafe(F.col(b))
        return same

    share = F.coalesce(counts.agg(F.sum("_n")).scalar(), F.lit(0)) / HOT_SHARE
    most = F.greatest(F.lit(float(hot_rows)), share)
    hot = F.broadcast(other(counts.where(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_splits"))))
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_splits", F.lit(1))).cast("int")
    salted = left.join(hot, meet(keys, names), "left").withColumn("_salt", salt).drop(*names, "_splits")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)).alias("_copy")
    repeated = other(right.join(hot, meet(keys, names), "left").select(*right.columns, copies))
    return salted.join(repeated, meet([*keys, "_salt"], [*names, "_copy"]), how).drop("_salt", "_copy", *names)


def _band(value: str) -> Column:
    """A monotone function of the value alone; at most ~370,000 bands per group."""
    return (F.signum(F.col(value)) * F.floor(F.log1p(F.abs(F.col(value))) * 256.0)).cast("int")


def value_ranks(df: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct values per group with the number of rows that sort below and above them.

    Columns ``group, value, n, n_below, n_above``; NULL values are left out. Equal
    values are counted before anything is shuffled by value, and the running sums go
    over coarse value bands first and inside a band second. So a group may hold any
    share of the table: no task ever sees it whole.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_band", _band(value))
    )
    bands = counted.groupBy(group, "_band").agg(F.sum("n").alias("_in_band"))
    by_band = W.Window.partitionBy(group).orderBy("_band")
    whole = W.Window.partitionBy(group)
    bands = bands.select(
        F.col(group).alias("_g"),
        F.col("_band").alias("_b"),
        (F.sum("_in_band").over(by_band) - F.col("_in_band")).alias("_before_band"),
        F.sum("_in_band").over(whole).alias("_total"),
    )
    inside = W.Window.partitionBy(group, "_band").orderBy(value)
    n_below = F.col("_before_band") + F.sum("n").over(inside) - F.col("n")
    return (
        counted.join(bands, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_band") == F.col("_b")))
        .withColumn("n_below", n_below)
        .select(group, value, "n", "n_below", (F.col("_total") - F.col("n_below") - F.col("n")).alias("n_above"))
    )


def row_numbers(df: DataFrame, group: str, order: list[Column], name: str = "row") -> DataFrame:
    """``df`` with its rows numbered from 1 in each group, in the order given, which must be total.

    Rows are range-partitioned by group and order, and stored, so that all further steps see the same partitions; each
    is numbered by itself, on top of the rows of its group in the partitions before it. A group of any size spreads over many tasks.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    placed = materialize(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each group and partition
    earlier = W.Window.partitionBy(group).orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1)
    before = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = W.Window.partitionBy("_part", group).orderBy(*order)
    numbered = placed.withColumn("_at", F.row_number().over(inside))
    joined = numbered.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))


def group_median(df: DataFrame, group: str, value: str, name: str = "median") -> DataFrame:
    """Exact median per group (mean of the two middle values), for groups of any size.

    Rows are counted by value bands first; then only the values of the one or two bands that hold the middle move. The
    list of these bands is broadcast up to ``FEW_BANDS`` of them.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(group), F.col(value), _band(value).alias("_band"))
    by_band, whole = W.Window.partitionBy(group).orderBy("_band"), W.Window.partitionBy(group)
    bands = rows.groupBy(group, "_band").agg(F.count(F.lit(1)).alias("_in")).select(
        F.col(group).alias("_g"), F.col("_band").alias("_b"), "_in", (F.sum("_in").over(by_band) - F.col("_in")).alias("_before"),
        F.sum("_in").over(whole).alias("_total"),
    )
    first, last = F.floor((F.col("_total") - 1) / 2.0), F.floor(F.col("_total") / 2.0)
    middle = materialize(bands.where((F.col("_before") <= last) & (first < F.col("_before") + F.col("_in"))).drop("_in"))
    if middle.limit(FEW_BANDS + 1).count() <= FEW_BANDS:
        middle = F.broadcast(middle)
    held = rows.join(middle, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_band") == F.col("_b")))
    counted = held.groupBy(group, "_band", value, "_before", "_total").agg(F.count(F.lit(1)).alias("n"))
    inside = W.Window.partitionBy(group, "_band").orderBy(value)
    counted = counted.withColumn("_below", F.col("_before") + F.sum("n").over(inside) - F.col("n"))

    def at(position: Column) -> Column:
        here = (F.col("_below") <= position) & (position < F.col("_below") + F.col("n"))
        return F.max(F.when(here, F.col(value)))

    return counted.groupBy(group).agg(((at(first) + at(last)) / 2.0).alias(name))
