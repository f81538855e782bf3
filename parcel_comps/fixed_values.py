"""Fixed values that results depend on: word lists, aliases and constants."""

# Street words and their short forms, applied per token.
STREET_WORDS = {
    "ROAD": "RD",
    "STREET": "ST",
    "LANE": "LN",
    "DRIVE": "DR",
    "AVENUE": "AVE",
    "MOUNTAIN": "MTN",
    "TRAIL": "TRL",
    "CIRCLE": "CIR",
    "COURT": "CT",
    "BOULEVARD": "BLVD",
    "HIGHWAY": "HWY",
    "PLACE": "PL",
}

# Compass words and their short forms.
DIRECTIONS = {"NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W"}

# Standard property types and the raw values each one stands for.
TYPE_ALIASES = {
    "Single Family": [
        "single family",
        "one fam",
        "one fam w acc",
        "single family residential",
        "single fam residential",
    ],
    "Vacant Land": [
        "vacant land",
        "vacant - pot dev",
        "vacant",
        "res land",
        "potnldev",
        "undev",
        "dev land",
        "developable residential land",
        "potentially developable residential land",
        "ocean frt residential",
        "ocean frt  vacant",
        "res aclnud vacant",
        "ac lnd imp vacant",
        "single fam vacant",
    ],
    "Two Family": ["two family", "2 family"],
    "Three Family": ["3 family"],
}

# The older raw value -> standard type table.
OLDER_TYPE_ALIASES = {
    "single family": "Single Family",
    "two family": "Two Family",
    "vacant land": "Vacant Land",
    "vacant - pot dev": "Vacant Land",
    "vacant": "Vacant Land",
    "condo - no land": "Condo",
    "common land": "Common Land",
    "mobile home": "Mobile Home",
    "commercial": "Commercial",
    "store/shop": "Commercial",
    "office bld": "Commercial",
    "motels": "Commercial",
    "town - comm": "Municipal",
    "vac w/ ob": "Vacant Land with Outbuilding",
    "res  pud": "Residential PUD",
    "one fam": "Single Family",
    "one fam w acc": "Single Family",
    "2 family": "Two Family",
    "3 family": "Three Family",
    "res land": "Vacant Land",
    "condo": "Condo",
    "condo-vac": "Condo",
    "municpal": "Municipal",
    "municpal-comm": "Municipal",
    "state nh": "Municipal",
    "charitable": "Municipal",
    "potnldev": "Vacant Land",
    "undev": "Vacant Land",
    "dev land": "Vacant Land",
    "day care": "Commercial",
    "medical off-res": "Commercial",
    "office": "Commercial",
    "store": "Commercial",
    "commwhse": "Commercial",
    "condo-com": "Commercial",
    "rest/bar": "Commercial",
    "condo ind": "Commercial",
    "mobil hm": "Mobile Home",
    "camper": "Camper",
    "apt 4-8": "Multi-Family",
    "apt 9+up": "Multi-Family",
    "mult hs": "Multi-Family",
    "pud": "Residential PUD",
    "open space": "Open Space",
    "out blds": "Vacant Land with Outbuilding",
    "other rec": "Recreational",
    "farm rec": "Recreational",
    "farm": "Farm",
}

# Types a parsed value may have; anything else is not a known type.
KNOWN_TYPES = ["Single Family", "Multi Family", "Two Family", "Vacant Land"]
# Neighbour types worth showing, and the one that counts towards the median.
COMP_ELIGIBLE_TYPES = ["Single Family", "Vacant Land"]
VALUE_COMP_TYPE = "Single Family"
# Listing types that are analysed.
LISTING_TYPES = ["Single Family", "Land"]

# Source tags of the three parcel feeds.
SOURCE_CT = "CT_OPM_CAMA_2024"
SOURCE_MA = "MA_MassGIS_L3_Parcels_Live"
SOURCE_NH = "NH_GRANIT_VGSI"

METRES_PER_DEGREE = 111320.0
SQM_PER_ACRE = 4046.8564224
SQFT_PER_ACRE = 43560.0
CLOSE_RADIUS_M = 100.0
FAR_RADIUS_M = 250.0
SIZE_RATIO = 2.5
MAX_PARTS = 2
MAX_HOLES = 2
MAX_VERTEX_M = 500.0
NO_LOT_SIZE_MAX_ACRES = 200.0
LOT_SIZE_FACTOR = 20.0
LOT_SIZE_FLOOR_ACRES = 5.0
DEFAULT_NEARBY_M = 300.0
MAX_NEARBY_M = 5000.0
ENDPOINT_MAX_NEARBY_M = 1000.0
NEW_CONSTRUCTION_YEAR = 2020
MIN_MATCH_RATE = 0.8
REPORT_ROWS = 15

# What a parcel page is told by, and the patterns of its labelled fields.
PAGE_MARK = "Total Market Value"
PAGE_PATTERNS = {
    "pid": r"PID\s*\n?\s*(\d+)",
    "location": r"Location\s*\n+\s*(.+?)\s*\n",
    "total_market_value": r"Total Market Value\s*\n?\s*\$?([\d,]+)",
    "mblu": r"Mblu\s*\n?\s*([\d/ ]+)",
    "acres": r"Size \(Acres\)\s*\n?\s*([\d.]+)",
    "land_use": r"(?s)Land Use(.*)$",
    "description": r"Description\s*\n+\s*(.+?)\s*\n",
}

# Texts of map popups.
POPUP_TEXTS = {
    "target": "<b>Target parcel</b><br>Assessed: ",
    "no_value": "no VGSI match",
    "used": "USED in comp",
    "unused": "shown for context, not used",
}
