"""Scalar column functions: parsing, dates, types, sizes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed

ColumnOrName = Column | str

_BLANKS = " \t\n\r\f\v"
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# 1901-01-01 and 9999-12-31T23:59:59.999 in epoch milliseconds.
_FIRST_SALE_MS = -2177452800000
_LAST_DATE_MS = 253402300799999


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(col(c), F.lit(_BLANKS))


def blank_to_null(c: ColumnOrName) -> Column:
    return F.nullif(strip(c), F.lit(""))


def empty_to_null(c: ColumnOrName) -> Column:
    return F.nullif(col(c), F.lit(""))


def is_blank(c: ColumnOrName) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def safe_num(c: ColumnOrName) -> Column:
    """Text to double; NULL, empty and unparsable text give NULL."""
    text = col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_int(c: ColumnOrName) -> Column:
    """Text or number to integer, rounded; NULL where it does not fit."""
    return F.round(safe_num(c)).try_cast("int")


def epoch_ms_date(c: ColumnOrName) -> Column:
    """Epoch milliseconds to a UTC date; anything up to the year 1900 is a sentinel."""
    ms = col(c).try_cast("bigint")
    day = F.floor(ms / F.lit(86400000.0)).cast("int")
    return F.when(ms.between(_FIRST_SALE_MS, _LAST_DATE_MS), F.date_from_unix_date(day))


def yyyymmdd_date(c: ColumnOrName) -> Column:
    text = strip(col(c).cast("string"))
    return F.when(text.rlike(r"^\d{8}$") & (text != "00000000"), F.try_to_date(text, "yyyyMMdd"))


def iso_date_only(c: ColumnOrName) -> Column:
    """The date in front of the ``T`` of an ISO timestamp."""
    return F.try_to_date(F.substring_index(col(c), "T", 1), "yyyy-MM-dd")


def combined_bathrooms(full: ColumnOrName, half: ColumnOrName) -> Column:
    full, half = safe_num(full), safe_num(half)
    total = F.coalesce(full, F.lit(0.0)) + F.coalesce(half, F.lit(0.0)) * 0.5
    return F.when(full.isNotNull() | half.isNotNull(), total)


def lot_acres(size: ColumnOrName, units: ColumnOrName) -> Column:
    """Acres from a size and its own unit text; an unknown unit gives NULL."""
    size, unit = col(size), F.lower(strip(units))
    return F.when(unit.startswith("acre"), size).when(
        unit.contains("sf") | unit.contains("sq") | unit.contains("feet"),
        size / F.lit(fixed.SQFT_PER_ACRE),
    )


def build_address(
    number: ColumnOrName, street: ColumnOrName, location: ColumnOrName, fallback: ColumnOrName
) -> Column:
    """Number and street, then location; the ready-made address when all are missing."""
    given = F.filter(F.array(col(number), col(street)), lambda p: p.isNotNull() & ~p.isin("", " "))
    base = F.array_join(F.transform(given, strip), " ")
    place = blank_to_null(location)
    full = F.when(place.isNotNull() & (base != ""), F.concat(base, F.lit(" "), place))
    return F.coalesce(full, place, empty_to_null(base), col(fallback))


def parse_known_type(c: ColumnOrName) -> Column:
    """The canonical name of a known type, ignoring case and outer blanks; else NULL."""
    text = F.lower(strip(c))
    known = F.lit(None).cast("string")
    for name in reversed(fixed.KNOWN_TYPES):
        known = F.when(text == name.lower(), F.lit(name)).otherwise(known)
    return known


def lot_size_similar(a: ColumnOrName, b: ColumnOrName, tol: float = fixed.SIZE_RATIO) -> Column:
    a, b = col(a), col(b)
    usable = (a > 0) & (b > 0)
    ratio = F.when(usable, F.greatest(a, b) / F.least(a, b))
    return F.coalesce(ratio <= F.lit(float(tol)), F.lit(False))


def plausible_size(
    acres: ColumnOrName, lot_sqft: ColumnOrName, zero_is_missing: bool = False
) -> Column:
    """Could a parcel of ``acres`` be the lot a listing of ``lot_sqft`` describes?"""
    acres, lot = col(acres), col(lot_sqft)
    if zero_is_missing:
        lot = F.nullif(lot, F.lit(0.0))
    limit = F.greatest(
        lot / fixed.SQFT_PER_ACRE * fixed.LOT_SIZE_FACTOR, F.lit(fixed.LOT_SIZE_FLOOR_ACRES)
    )
    return acres <= F.when(lot.isNull(), F.lit(fixed.NO_LOT_SIZE_MAX_ACRES)).otherwise(limit)


def slugify(c: ColumnOrName) -> Column:
    text = F.lower(F.coalesce(empty_to_null(c), F.lit("unknown")))
    return F.btrim(F.regexp_replace(text, "[^a-z0-9]+", "-"), F.lit("-"))


def town_slug(c: ColumnOrName) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("_"))


def request_key(params: ColumnOrName) -> Column:
    """SHA-256 of ``k=v&`` over the sorted keys of a string map."""
    entries = F.array_sort(F.map_entries(col(params)))
    part = F.transform(
        entries,
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")), F.lit("&")),
    )
    return F.sha2(F.array_join(part, ""), 256)


def request_params_json(params: ColumnOrName) -> Column:
    """The request map as JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(params)))))


def newer_construction_flag(year: ColumnOrName) -> Column:
    return F.coalesce(col(year) >= fixed.NEW_CONSTRUCTION_YEAR, F.lit(False))


def unit_style_address(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).contains("#"), F.lit(False))


def round2(c: ColumnOrName) -> Column:
    """Two decimals, nearest to the binary value, exact halves to even."""
    x = col(c)
    scaled = x * 100.0
    # The product may round onto a half; its exact error tells which side x is on.
    split = x * 134217729.0
    high = split - (split - x)
    error = (high * 100.0 - scaled) + (x - high) * 100.0
    low = F.floor(scaled)
    half = scaled - low == 0.5
    whole = F.when(half & (error < 0), low).when(half & (error > 0), low + 1)
    return F.coalesce(whole.cast("double"), F.rint(scaled)) / 100.0
