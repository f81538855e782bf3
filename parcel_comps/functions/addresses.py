"""Address and parcel-key column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.scalars import ColumnOrName, col, strip

_ABBREVIATE = fixed.STREET_WORDS
_EXPAND = {short: word for word, short in fixed.STREET_WORDS.items()}
_DIRECTION_SHORT = fixed.DIRECTIONS
_DIRECTION_LONG = {short: word for word, short in fixed.DIRECTIONS.items()}


def _map(words: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])


def _tokens(c: ColumnOrName, unicode: bool) -> Column:
    """Upper-case words with punctuation read as blanks."""
    flag = "(?U)" if unicode else ""
    text = F.regexp_replace(F.upper(col(c)), flag + r"[^\w\s]", " ")
    words = F.split(F.trim(F.regexp_replace(text, flag + r"\s+", " ")), " ")
    return F.filter(words, lambda w: w != "")


def _replace_words(words: Column, mapping: dict[str, str]) -> Column:
    if not mapping:
        return words
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(_map(mapping), w), w))


def normalize_address(c: ColumnOrName, unicode: bool = False) -> Column:
    """Upper case, no punctuation, short street words; NULL and blank give ``''``."""
    words = _replace_words(_tokens(c, unicode), _ABBREVIATE)
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def street_of(normalized: ColumnOrName, unicode: bool = False) -> Column:
    """A normalised address without its leading house number."""
    digits = r"\p{Nd}" if unicode else "[0-9]"
    return F.regexp_replace(col(normalized), f"^{digits}+( |$)", "")


def street_name_only(c: ColumnOrName, unicode: bool = False) -> Column:
    return street_of(normalize_address(c, unicode), unicode)


def _no_leading_zeros(c: Column) -> Column:
    return F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), F.lit("0"))


def unit_token(c: ColumnOrName) -> Column:
    """Unit text with leading zeros stripped per word; no unit at all is ``'00'``."""
    words = F.filter(F.split(F.upper(col(c)), r"\s+"), lambda w: w != "")
    bare = F.transform(words, _no_leading_zeros)
    none = F.forall(bare, lambda w: w == "0")  # also true for no words
    return F.when(col(c).isNull() | none, F.lit("00")).otherwise(F.array_join(bare, " "))


def _key(map_: Column, block: Column, lot: Column, unit: Column) -> Column:
    return F.struct(
        _no_leading_zeros(map_).alias("map"),
        _no_leading_zeros(block).alias("block"),
        _no_leading_zeros(lot).alias("lot"),
        unit_token(unit).alias("unit"),
    )


def parcel_key(c: ColumnOrName) -> Column:
    """Map/block/lot/unit from a parcel id, packed (``127-268000-00``) or spaced."""
    words = F.filter(F.split(strip(c), r"[-\s]+"), lambda w: w != "")

    def word(i: int) -> Column:
        return F.get(words, F.lit(i))

    packed = word(1).rlike(r"^\d{6}$")
    return F.when(
        F.size(words) >= 2,
        F.when(
            packed, _key(word(0), F.substring(word(1), 1, 3), F.substring(word(1), 4, 3), word(2))
        ).otherwise(_key(word(0), word(1), F.coalesce(word(2), F.lit("0")), word(3))),
    )


def mblu_key(c: ColumnOrName) -> Column:
    """Map/block/lot/unit from slash-separated text."""
    parts = F.filter(F.transform(F.split(col(c), "/"), strip), lambda p: p != "")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    return F.when(F.size(parts) >= 3, _key(part(0), part(1), part(2), part(3)))


def address_variants(c: ColumnOrName) -> Column:
    """The original text, then its spellings with long and short direction and street words."""
    words = _tokens(c, unicode=True)
    plain = F.array_join(words, " ")
    spellings = [
        F.array_join(_replace_words(_replace_words(words, directions), streets), " ")
        for directions in ({}, _DIRECTION_LONG, _DIRECTION_SHORT)
        for streets in ({}, _EXPAND, _ABBREVIATE)
    ]
    others = F.array_remove(F.array_distinct(F.array(*spellings)), plain)
    return F.when(col(c).isNotNull(), F.concat(F.array(col(c)), others))
