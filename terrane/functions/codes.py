"""Lookup tables and literals shared by every plan.

FIXED VALUES: the entries below must equal the reference's values for results to
agree. They are stated plainly, in their natural order, in one place.
"""

# --- FIXED VALUES -----------------------------------------------------------

# Town code -> city, analytics decode (Q3a); anything else is OTHER/COUNTY.
TOWN_CITY = {
    "B": "BRECKENRIDGE",
    "F": "FRISCO",
    "D": "DILLON",
    "S": "SILVERTHORNE",
    "K": "KEYSTONE",
    "C": "COPPER/COUNTY",
    "M": "MONTEZUMA",
    "R": "RURAL",
    "BR": "BLUE RIVER",
    "H": "HEENEY",
}
TOWN_CITY_DEFAULT = "OTHER/COUNTY"

# Town code -> city, model-feature decode (Q3b); anything else is OTHER.
TOWN_CITY_ML = {
    "B": "BRECKENRIDGE",
    "F": "FRISCO",
    "D": "DILLON",
    "S": "SILVERTHORNE",
    "K": "KEYSTONE",
    "C": "COPPERMOUNTAIN",
    "BR": "BLUERIVER",
}
TOWN_CITY_ML_DEFAULT = "OTHER"

# Dashboard property-type inference (Q3c variant): (label, abst1 codes,
# description words), first match wins; the default is Single Family.
DASHBOARD_TYPE_RULES = [
    ("Condo", ["1233"], ["CONDO"]),
    ("Townhouse", ["1230"], ["TOWNHOME", "Townhome"]),
    ("Single Family", ["1112"], ["SINGLE FAM", "1 Story", "2 Story"]),
    ("Vacant Land", ["1135", "100"], []),
    ("Duplex-Triplex", ["1113"], ["DUPLEX", "TRIPLEX"]),
]
DASHBOARD_TYPE_DEFAULT = "Single Family"
# Dashboard city -> town code (similar-property search); unknown -> B.
DASHBOARD_TOWN_CODES = {"BRECKENRIDGE": "B", "FRISCO": "F", "DILLON": "D", "SILVERTHORNE": "S", "KEYSTONE": "K",
                        "COPPER MOUNTAIN": "C"}
DASHBOARD_TOWN_DEFAULT = "B"
SIMILAR_MIN_PRICE = 10000
SIMILAR_DEFAULT_BEDS = 3
SIMILAR_DEFAULT_BATHS = 2

# Benchmark scenarios (M14): two archetypes in four towns, plus macro inputs.
SCENARIO_TOWNS = ["BRECKENRIDGE", "FRISCO", "SILVERTHORNE", "DILLON"]
SCENARIO_ARCHETYPES = [
    {"desc": "Entry Condo", "prop_type": "Condo", "sfla": 600, "beds": 1, "baths": 1, "year_blt": 1980,
     "garage_size": 0, "acres": 0, "grade_numeric": 4, "cond_numeric": 4, "scenic_view": 0},
    {"desc": "Family Home", "prop_type": "Single Family", "sfla": 2200, "beds": 3, "baths": 2.5, "year_blt": 1995,
     "garage_size": 400, "acres": 0.25, "grade_numeric": 5, "cond_numeric": 5, "scenic_view": 2},
]
SCENARIO_MACRO = {"mortgage_rate": 6.5, "sp500": 5000, "cpi": 310.0, "county_pop": 31.0}
# Error-band default when no run is active: a quarter of the baseline price.
ERROR_BAND_DEFAULT_MAE = 1_500_000.0 * 0.25

# Property-type abstract codes (Q3c), first match wins in this order.
SINGLE_FAMILY_CODES = ["1212"]
CONDO_CODES = ["1230", "1231"]
TOWNHOUSE_CODES = ["1214"]
VACANT_LAND_CODES = ["100", "200"]

# Owner mailing towns counted as local (Q3d, case-sensitive).
LOCAL_TOWNS = ["BRECKENRIDGE", "FRISCO", "DILLON", "SILVERTHORNE", "KEYSTONE", "COPPER MOUNTAIN"]
LOCATION_LOCAL = "Local (In-County)"
LOCATION_IN_STATE = "In-State (Non-Local)"
LOCATION_OUT_OF_STATE = "Out-of-State"
HOME_STATE = "CO"
# Owner-analysis labels of the same rule.
OWNER_LOCATION_LABELS = ("In-County", "In-State (Out of County)", "Out of State")

# Building class keywords (Q3g), checked in this order on the lower-cased text.
BUILDING_CLASS_KEYWORDS = [
    ("Residential", ["residential", "dwelling", "apartment", "residence", "res"]),
    ("Commercial", ["commercial", "store", "office", "hotel", "lodging", "retail", "bank"]),
    ("Industrial", ["industrial", "warehouse", "factory"]),
    ("Public/Institutional", ["public", "school", "church", "hospital", "government"]),
]
BUILDING_CLASS_DEFAULT = "Other"

# Owner entity keywords (Q3h), checked in this order on the upper-cased name.
OWNER_TYPE_KEYWORDS = [
    ("LLC / Limited Liability", ["LLC", "LIMITED LIABILITY"]),
    ("Trust", ["TRUST", "TR", "TRUSTEE"]),
    ("Corporation", ["INC", "CORP", "INCORPORATED", "LTD"]),
    ("Partnership", ["PARTNERS", "LP", "LLP"]),
    ("Church / Religious", ["CHURCH", "DIOCESE", "MINISTRIES", "TEMPLE", "SYNAGOGUE", "MOSQUE"]),
]
OWNER_TYPE_DEFAULT = "Individual"
OWNER_TYPE_UNKNOWN = "Unknown"

# Ordinal quality grades (Q3l); anything else is 3.
QUALITY_ORDINAL = {"A": 6, "X": 6, "B": 5, "C": 4, "D": 3, "E": 2, "F": 1}
QUALITY_DEFAULT = 3

# Month names.
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Price bands relative to the annual median (A14): upper bound in percent, label.
PRICE_BANDS = [
    (50.0, "1. Budget (<50% Med)", "lt"),
    (100.0, "2. Below Med (50-100%)", "le"),
    (150.0, "3. Above Med (100-150%)", "le"),
    (200.0, "4. Premium (150-200%)", "le"),
]
PRICE_BAND_TOP = "5. Luxury (>200% Med)"

# Resort lift points (G3): series name -> [(lat, lon)].
RESORT_POINTS = {
    "dist_breck": [(39.4805, -106.0666)],
    "dist_keystone": [(39.605, -105.9439)],
    "dist_copper": [(39.5022, -106.1506)],
    "dist_abasin": [(39.6425, -105.8719)],
    "dist_dillon": [(39.6050, -106.0660)],
}
# Resorts whose nearest lift feeds the model (G5); Dillon is excluded.
LIFT_RESORTS = ["dist_breck", "dist_keystone", "dist_copper", "dist_abasin"]
EARTH_RADIUS_KM = 6367.0
KM_TO_MILES = 0.621371
METRES_TO_MILES = 0.000621371

# Known county population by year.
KNOWN_POPULATION = [
    (1960, 2000), (1970, 2700), (1980, 8800), (1990, 12800),
    (2000, 23500), (2010, 28000), (2020, 31000), (2024, 31500),
]

# Pandas missing-value tokens used by the all-text CSV scan.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Luxury threshold and weight (F9), and the evaluation luxury segment (M8).
LUXURY_PRICE = 2_000_000
LUXURY_WEIGHT = 2.0

# Baseline-delta thresholds (M16) and error-band scale.
DELTA_MIN_ABS = 1.0
DELTA_MIN_SHOWN = 100.0
ERROR_BAND_PRICE_SCALE = 1_500_000.0

# Similar-property score weights.
# Categories that an explanation compares with.
REFERENCE_CATEGORIES = {"city": "BRECKENRIDGE", "prop_type": "Single Family"}
SIMILAR_TYPE_PENALTY = 50.0
SIMILAR_SQFT_UNIT = 500.0
SIMILAR_YEAR_UNIT = 10.0
SIMILAR_MIN_SAME_TOWN = 5
SIMILAR_TOP = 3

# The two residential building labels, assigned by code before keyword classes.
RESIDENTIAL_BUILDING_LABELS = {
    "Single Family Home": ["1212"],
    "Apartment/Condo/Townhome": ["1214", "1230", "1231"],
}

# Physical-city decode used by the owner-occupancy check (Q3k); else OTHER.
TOWN_PHYSICAL_CITY = {
    "B": "BRECKENRIDGE",
    "D": "DILLON",
    "F": "FRISCO",
    "S": "SILVERTHORNE",
    "K": "KEYSTONE",
    "C": "COPPER MOUNTAIN",
    "M": "MONTEZUMA",
    "R": "RURAL",
    "BR": "BLUE RIVER",
    "H": "HEENEY",
}
COUNTY_TOWNS = ["BRECKENRIDGE", "DILLON", "FRISCO", "SILVERTHORNE", "KEYSTONE", "COPPER MOUNTAIN",
                "BLUE RIVER", "MONTEZUMA", "HEENEY"]
PO_BOX_PATTERN = "PO BOX|P.O. BOX"

# Cities averaged by the cross-city trend (A34) and shown by the trends chart.
TREND_CITIES = ["BRECKENRIDGE", "FRISCO", "SILVERTHORNE", "DILLON", "KEYSTONE"]

# Correlation strength cut-offs and significance level.
CORR_MODERATE = 0.3
CORR_STRONG = 0.6
SIGNIFICANCE = 0.05

# Lift-name keywords per resort for line distances (G4), matched case-insensitively.
RESORT_LIFT_KEYWORDS = {
    "dist_breck": ["Breckenridge", "Peak 8", "Peak 9", "Peak 7", "Peak 6", "Beaver Run", "Quicksilver",
                   "SuperConnect", "Imperial", "Falcon"],
    "dist_keystone": ["Keystone", "River Run", "Montezuma", "Peru", "Santiago", "Outback", "Wayback"],
    "dist_copper": ["Copper", "American Eagle", "American Flyer", "Super Bee", "Kokomo", "Union Creek", "Timberline"],
    "dist_abasin": ["Arapahoe", "Black Mountain", "Pallavicini", "Lenawee", "Zuma"],
    "dist_dillon": ["Dillon Marina"],
}

# Default resort distances (miles) by city centre (G7); unknown cities use the
# BRECKENRIDGE row.
CITY_DEFAULT_DISTANCES = {
    "BRECKENRIDGE": {"dist_breck": 0.5, "dist_keystone": 12, "dist_copper": 16, "dist_abasin": 18, "dist_dillon": 10},
    "FRISCO": {"dist_breck": 9, "dist_keystone": 9, "dist_copper": 6, "dist_abasin": 13, "dist_dillon": 4},
    "SILVERTHORNE": {"dist_breck": 12, "dist_keystone": 7, "dist_copper": 11, "dist_abasin": 10, "dist_dillon": 1},
    "DILLON": {"dist_breck": 11, "dist_keystone": 5, "dist_copper": 12, "dist_abasin": 9, "dist_dillon": 0.5},
    "KEYSTONE": {"dist_breck": 14, "dist_keystone": 0.5, "dist_copper": 15, "dist_abasin": 6, "dist_dillon": 6},
    "COPPER MOUNTAIN": {"dist_breck": 17, "dist_keystone": 18, "dist_copper": 0.5, "dist_abasin": 21, "dist_dillon": 12},
}
DEFAULT_DISTANCE_CITY = "BRECKENRIDGE"

# Cities kept by the geo export.
GEO_EXPORT_CITIES = ["BRECKENRIDGE", "FRISCO", "SILVERTHORNE", "DILLON", "KEYSTONE", "COPPER MOUNTAIN"]

# UTM zone 13N on WGS84 (G4 projection).
UTM_CENTRAL_MERIDIAN = -105.0
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563

# --- end of FIXED VALUES -----------------------------------------------------
