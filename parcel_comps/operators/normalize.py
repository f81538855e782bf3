"""Raw feeds to the common parcel record, the listing table and assessment rows."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel_comps import fixed_values as fixed
from parcel_comps import schemas
from parcel_comps.functions import scalars as S
from parcel_comps.functions.geometry import parse_geometry, parse_point, vertex_mean


# Python's table of HTML names; a no-break space reads as a blank here.
_ENTITIES = {k[:-1]: v.replace("\xa0", " ") for k, v in html5.items() if k.endswith(";")}


def standardize_type(
    df: DataFrame, column: str, mapping: DataFrame, keep_unknown_raw: bool = False
) -> DataFrame:
    """Replace raw types by their standard names; unknown ones stay, trimmed.

    A short mapping is broadcast by Spark's own size rule. Blank becomes NULL. With ``keep_unknown_raw`` (the older table's rule) unknown
    and blank values are left exactly as they are.
    """
    lookup = mapping.select(
        F.col("alias").alias("_alias"), F.col("standardized").alias("_standard")
    )
    joined = df.withColumn("_alias", F.lower(S.strip(column))).join(
        lookup, "_alias", "left"
    )
    unknown = F.col(column) if keep_unknown_raw else S.blank_to_null(column)
    return joined.withColumn(column, F.coalesce("_standard", unknown)).select(*df.columns)


def fill_schema(df: DataFrame, schema: T.StructType = schemas.PROPERTY_VALUES) -> DataFrame:
    """The schema's columns in order; missing ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _records(
    features: DataFrame,
    schema: T.StructType,
    fields: Callable[[Callable[[str], Column]], dict[str, Column]],
    mapping: DataFrame | None,
    town: str | Column | None,
    source_url: str | None,
    source_date: Column | None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Shared projection of the three feeds: parse, map, locate, standardise."""
    parsed = features.withColumn("_p", F.from_json("properties", schema)).withColumn(
        "_shape", parse_geometry("geometry")
    )
    if town is None:
        town = F.lit(None).cast("string")
    parsed = parsed.withColumn("_town", F.lit(town) if isinstance(town, str) else town)
    where = F.coalesce(
        vertex_mean("_shape"),
        F.when(
            parse_point("geometry").isNotNull(),
            F.struct(
                parse_point("geometry")["y"].alias("lat"),
                parse_point("geometry")["x"].alias("lon"),
            ),
        ),
    )
    columns = {
        "source_url": F.lit(source_url).cast("string"),
        "source_date": source_date if source_date is not None else F.current_date(),
        "latitude": F.col("_where.lat"),
        "longitude": F.col("_where.lon"),
        **fields(lambda name: F.col(f"_p.{name}")),
    }
    rows = parsed.withColumn("_where", where).select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.PARCEL_RECORD.fields
        ],
        F.col("_shape").alias("geometry"),
        *[F.col(f"_p.{name}").alias(f"_{name}") for name in extra],
        *[F.col(name) for name in ("_file", "_pos") if name in features.columns],
    )
    return standardize_type(rows, "property_type", mapping) if mapping is not None else rows


def normalize_ct(
    features: DataFrame,
    mapping: DataFrame,
    town: str | Column | None = None,
    source_url: str | None = None,
    source_date: Column | None = None,
) -> DataFrame:
    """Connecticut features (``properties``, ``geometry``) to the parcel record.

    ``_OBJECTID`` is carried along for ``disambiguate_ids``.
    """

    def fields(p: Callable[[str], Column]) -> dict[str, Column]:
        place = F.coalesce(S.empty_to_null(p("Town_Name")), F.col("_town"))
        parcel = p("Parcel_ID")
        return {
            "property_id": F.concat(F.lit("CT:"), S.empty_to_null(parcel)),
            "state": F.lit("CT"),
            "municipality": place,
            "parcel_id": parcel,
            "address": p("Location_1"),
            "city": F.coalesce(S.empty_to_null(p("Property_City")), place),
            "acreage": S.safe_num(p("Land_Acres")),
            "assessed_value": S.safe_num(p("Assessed_Total")),
            "assessed_land_value": S.safe_num(p("Assessed_Land")),
            "assessed_building_value": S.safe_num(p("Assessed_Building")),
            "assessment_year": S.safe_int(p("Valuation_Year")),
            "last_sale_price": S.safe_num(p("Sale_Price")),
            "last_sale_date": S.epoch_ms_date(p("Sale_Date")),
            "building_sqft": S.safe_num(p("Living_Area")),
            "bedrooms": S.safe_num(p("Number_of_Bedroom")),
            "bathrooms": S.combined_bathrooms(p("Number_of_Baths"), p("Number_of_Half_Baths")),
            "year_built": S.safe_int(p("ayb")),
            "property_type": p("State_Use_Description"),
            "source": F.lit(fixed.SOURCE_CT),
        }

    return _records(
        features, schemas.CT_PROPERTIES, fields, mapping, town, source_url, source_date,
        extra=("OBJECTID",),
    )


def normalize_ma(
    features: DataFrame,
    mapping: DataFrame,
    town: str | Column | None = None,
    source_url: str | None = None,
    source_date: Column | None = None,
) -> DataFrame:
    """Massachusetts features (Esri attributes and rings) to the parcel record."""

    def fields(p: Callable[[str], Column]) -> dict[str, Column]:
        place = F.coalesce(S.empty_to_null(p("CITY")), F.col("_town"))
        return {
            "property_id": F.concat(F.lit("MA:"), S.empty_to_null(p("LOC_ID"))),
            "state": F.lit("MA"),
            "municipality": place,
            "parcel_id": p("LOC_ID"),
            "address": S.build_address(
                p("ADDR_NUM"), p("FULL_STR"), p("LOCATION"), p("SITE_ADDR")
            ),
            "city": place,
            "zip": p("ZIP"),
            "acreage": S.lot_acres(S.safe_num(p("LOT_SIZE")), p("LOT_UNITS")),
            "assessed_value": S.safe_num(p("TOTAL_VAL")),
            "assessed_land_value": S.safe_num(p("LAND_VAL")),
            "assessed_building_value": S.safe_num(p("BLDG_VAL")),
            "assessment_year": S.safe_int(p("FY")),
            "last_sale_price": S.safe_num(p("LS_PRICE")),
            "last_sale_date": S.yyyymmdd_date(p("LS_DATE")),
            # An area of 0 is a value; only a missing one falls back.
            "building_sqft": F.coalesce(S.safe_num(p("RES_AREA")), S.safe_num(p("BLD_AREA"))),
            "year_built": S.safe_int(p("YEAR_BUILT")),
            "property_type": p("USE_DESC"),
            "source": F.lit(fixed.SOURCE_MA),
        }

    return _records(
        features, schemas.MA_ATTRIBUTES, fields, mapping, town, source_url, source_date
    )


def normalize_nh(
    features: DataFrame, town: str | Column | None = None, source_date: Column | None = None
) -> DataFrame:
    """New Hampshire parcels joined with their assessments to the parcel record."""

    def fields(p: Callable[[str], Column]) -> dict[str, Column]:
        place = F.coalesce(S.empty_to_null(p("Town")), F.col("_town"))
        return {
            "property_id": F.concat(F.lit("NH:"), S.empty_to_null(p("PID"))),
            "state": F.lit("NH"),
            "municipality": place,
            "parcel_id": p("PID"),
            "address": F.coalesce(S.empty_to_null(p("vgsi_location")), p("StreetAddress")),
            "city": place,
            "acreage": S.safe_num(p("acres")),
            "assessed_value": S.safe_num(p("total_market_value")),
            "property_type": p("land_use_desc"),
            "source": F.lit(fixed.SOURCE_NH),
        }

    return _records(features, schemas.NH_PROPERTIES, fields, None, town, None, source_date)


def normalize_listing(raw: DataFrame, source: str) -> DataFrame:
    """Provider listings to the listing table, without ``fetched_at``."""
    names = {
        "listing_id": "id",
        "formatted_address": "formattedAddress",
        "address_line_1": "addressLine1",
        "address_line_2": "addressLine2",
        "zip_code": "zipCode",
        "property_type": "propertyType",
        "square_footage": "squareFootage",
        "lot_size": "lotSize",
        "year_built": "yearBuilt",
        "listing_type": "listingType",
        "days_on_market": "daysOnMarket",
        "mls_name": "mlsName",
        "mls_number": "mlsNumber",
        "agent": "listingAgent",
        "office": "listingOffice",
        "price_history": "history",
    }
    computed = {
        "listed_date": S.iso_date_only("listedDate"),
        "removed_date": S.iso_date_only("removedDate"),
        "source": F.lit(source),
    }
    columns = [f for f in schemas.LISTINGS.fields if f.name != "fetched_at"]
    return raw.select(
        *[
            computed.get(f.name, F.col(names.get(f.name, f.name))).cast(f.dataType).alias(f.name)
            for f in columns
        ],
        *[F.col(name) for name in ("_file", "_pos") if name in raw.columns],
    )


def page_text(html: Column) -> Column:
    """Visible text of a page with every tag turned into a line break."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"(?is)<(script|style)[^>]*>.*?</(script|style)\s*>", "\n")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", "\n")
    return decode_entities(text)


def decode_entities(text: Column) -> Column:
    """Character references replaced: all HTML names, and decimal and hexadecimal numbers.

    Text is split at "&", so every reference is looked up once and none is decoded twice.
    """
    names = F.map_from_arrays(F.lit(list(_ENTITIES)), F.lit(list(_ENTITIES.values())))
    name = F.regexp_extract

    def decoded(part: Column, i: Column) -> Column:
        reference = name(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substr(part, F.length(reference) + 2)
        digits = F.when(reference.rlike("^#[xX]"), F.conv(F.substr(reference, F.lit(3)), 16, 10)).when(
            reference.startswith("#"), F.substr(reference, F.lit(2))
        ).cast("int")
        # Numbers are written as UTF-32 and read back.
        number = F.when(
            (digits > 0) & (digits < 0x110000) & ~digits.between(0xD800, 0xDFFF),
            F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32"),
        )
        char = F.coalesce(number, F.try_element_at(names, reference))
        whole = F.concat(F.lit("&"), part)
        return F.when(i == 0, part).otherwise(F.coalesce(F.concat(char, rest), whole))

    return F.array_join(F.transform(F.split(text, "&"), decoded), "")


def extract_assessment(pages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Assessment rows from parcel pages (``page_id``, ``html``).

    Pages without a total market value are not parcel records and give no row. The
    page id stands in for a missing parcel number.
    """

    def found(pattern: str, text: str = "_text") -> Column:
        return S.empty_to_null(F.regexp_extract(text, "(?U)" + pattern, 1))

    def plain(value: Column) -> Column:
        return F.replace(value, F.lit(","), F.lit(""))

    after_heading = F.regexp_extract("_text", fixed.PAGE_PATTERNS["land_use"], 1)
    rows = (
        pages.withColumn("_text", page_text(F.col("html")))
        .where(F.col("_text").contains(fixed.PAGE_MARK))
        .withColumn("_land_use", after_heading)
        .select(
            F.coalesce(found(fixed.PAGE_PATTERNS["pid"]), F.col("page_id").cast("string")).alias("pid"),
            S.strip(found(fixed.PAGE_PATTERNS["location"])).alias("location"),
            plain(found(fixed.PAGE_PATTERNS["total_market_value"])).alias("total_market_value"),
            found(fixed.PAGE_PATTERNS["mblu"]).alias("mblu"),
            found(fixed.PAGE_PATTERNS["acres"]).alias("acres"),
            S.strip(found(fixed.PAGE_PATTERNS["description"], "_land_use")).alias("land_use_desc"),
            F.lit("sequential").alias("match_source"),
        )
    )
    return standardize_type(rows, "land_use_desc", mapping)
