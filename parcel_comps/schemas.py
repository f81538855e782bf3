"""Explicit schemas of every table and landed file."""

from __future__ import annotations

from pyspark.sql import types as T

STR, DBL, INT, LNG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
BOOL, DATE, TS = T.BooleanType(), T.DateType(), T.TimestampType()

POINT = T.StructType([T.StructField("x", DBL), T.StructField("y", DBL)])
# parts -> rings -> points; ring 0 of a part is its outer ring, the rest are holes.
GEOMETRY = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))
BOX = T.StructType([T.StructField(n, DBL) for n in ("xmin", "ymin", "xmax", "ymax")])


def _schema(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# The 25 fields every parcel feed is normalised to.
PARCEL_RECORD = _schema({
    "property_id": STR, "state": STR, "county": STR, "municipality": STR, "parcel_id": STR,
    "address": STR, "city": STR, "zip": STR, "latitude": DBL, "longitude": DBL, "acreage": DBL,
    "assessed_value": DBL, "assessed_land_value": DBL, "assessed_building_value": DBL,
    "assessment_year": INT, "last_sale_price": DBL, "last_sale_date": DATE, "building_sqft": DBL,
    "bedrooms": DBL, "bathrooms": DBL, "year_built": INT, "property_type": STR, "source": STR,
    "source_url": STR, "source_date": DATE,
})

PROPERTY_VALUES = T.StructType(
    PARCEL_RECORD.fields + [T.StructField("geometry", GEOMETRY), T.StructField("loaded_at", TS)]
)

LISTINGS = _schema({
    "listing_id": STR, "formatted_address": STR, "address_line_1": STR, "address_line_2": STR,
    "city": STR, "state": STR, "zip_code": STR, "county": STR, "latitude": DBL, "longitude": DBL,
    "property_type": STR, "bedrooms": DBL, "bathrooms": DBL, "square_footage": DBL,
    "lot_size": DBL, "year_built": INT, "status": STR, "price": DBL, "listing_type": STR,
    "listed_date": DATE, "removed_date": DATE, "days_on_market": INT, "mls_name": STR,
    "mls_number": STR, "agent": STR, "office": STR, "price_history": STR, "source": STR,
    "fetched_at": TS,
})

GAP_RESULTS = _schema({
    "listing_id": STR, "has_comps": BOOL, "target_assessed_value": DBL, "comp_median": DBL,
    "comp_min": DBL, "comp_max": DBL, "comp_count": INT,
    "comp_property_ids": T.ArrayType(STR), "gap": DBL, "gap_pct": DBL, "relative_gap_pct": DBL,
    "computed_at": TS,
})

SOURCE_CACHE = _schema({
    "source": STR, "endpoint": STR, "request_key": STR, "request_params": STR,
    "response_body": STR, "status_code": INT, "fetched_at": TS, "expires_at": TS,
    "hit_count": INT, "last_hit_at": TS,
})
CACHE_KEY = ["source", "endpoint", "request_key"]

ASSESSMENTS = _schema({
    "pid": STR, "location": STR, "total_market_value": STR, "mblu": STR, "acres": STR,
    "land_use_desc": STR, "match_source": STR,
})

# Properties and geometry stay JSON text until a normaliser picks its fields.
FEATURE = _schema({"type": STR, "geometry": STR, "properties": STR, "attributes": STR})
FEATURE_COLLECTION = _schema({"type": STR, "features": T.ArrayType(FEATURE)})

CT_PROPERTIES = _schema({name: STR for name in (
    "Parcel_ID", "OBJECTID", "Town_Name", "Location_1", "Property_City", "Land_Acres",
    "Assessed_Total", "Assessed_Land", "Assessed_Building", "Valuation_Year", "Sale_Price",
    "Sale_Date", "Living_Area", "Number_of_Bedroom", "Number_of_Baths", "Number_of_Half_Baths",
    "ayb", "State_Use_Description",
)})

MA_ATTRIBUTES = _schema({name: STR for name in (
    "LOC_ID", "CITY", "ZIP", "ADDR_NUM", "FULL_STR", "LOCATION", "SITE_ADDR", "LOT_SIZE",
    "LOT_UNITS", "TOTAL_VAL", "LAND_VAL", "BLDG_VAL", "FY", "LS_PRICE", "LS_DATE", "RES_AREA",
    "BLD_AREA", "YEAR_BUILT", "USE_DESC",
)})

NH_PROPERTIES = _schema({name: STR for name in (
    "PID", "Town", "StreetAddress", "SLU", "SLUC", "DisplayId", "NH_GIS_ID", "Name",
    "total_market_value", "vgsi_location", "mblu", "acres", "land_use_desc", "match_method",
)})

# Provider listing objects; the three nested objects are kept as JSON text.
RAW_LISTING = _schema({
    "id": STR, "formattedAddress": STR, "addressLine1": STR, "addressLine2": STR, "city": STR,
    "state": STR, "zipCode": STR, "county": STR, "latitude": DBL, "longitude": DBL,
    "propertyType": STR, "bedrooms": DBL, "bathrooms": DBL, "squareFootage": DBL, "lotSize": DBL,
    "yearBuilt": INT, "status": STR, "price": DBL, "listingType": STR, "listedDate": STR,
    "removedDate": STR, "daysOnMarket": INT, "mlsName": STR, "mlsNumber": STR,
    "listingAgent": STR, "listingOffice": STR, "history": STR,
})
