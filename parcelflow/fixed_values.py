"""Lookup tables and constants of the domain. All are fixed values: results depend on them as they stand."""

# Room label -> room id, and the smallest plausible unit area (m2) per room id.
ROOM_IDS = {
    "Studio": 1, "1 B/R": 2, "2 B/R": 3, "3 B/R": 4, "4 B/R": 5, "5 B/R": 6, "6 B/R": 7, "7 B/R": 8, "8 B/R": 9,
}
MIN_AREA_BY_ROOM_ID = {1: 25, 2: 50, 3: 80, 4: 100, 5: 140, 6: 170, 7: 200, 8: 250, 9: 300, 10: 330, 621: 80}

# Room labels that are not homes.
NON_HOME_ROOMS = ["Office", "Shop", "Single Room", "0", "No_rooms_en", "Missing_rooms_en"]

# Room label -> number used in category shares, in matching order.
ROOM_NUMBERS = [("1 B/R", 1), ("2 B/R", 2), ("3 B/R", 3), ("More than 3B/R", 4), ("Studio", 11), ("PENTHOUSE", 621)]

# Labels folded into one large-home group.
LARGE_HOME_LABELS = ["4 B/R", "5 B/R", "6 B/R", "7 B/R", "8 B/R", "9 B/R", "10 B/R"]
LARGE_HOME_GROUP = "More than 3B/R"

# Keyword in a project name -> developer. Later entries win.
DEVELOPER_KEYWORDS = [
    ("emaar", "Emaar Properties"),
    ("emirates living", "Emaar Properties"),
    ("springs", "Emaar Properties"),
    ("binghatti", "Binghatti Developers"),
    ("damac", "DAMAC Properties"),
    ("sobha", "Sobha Realty"),
    ("nakheel", "Nakheel Properties"),
    ("dubai properties", "Dubai Properties"),
    ("meraas", "Meraas"),
    ("habtoor", "Habtoor Group"),
    ("ellington", "Ellington Properties"),
    ("omniyat", "Omniyat"),
    ("aldar", "Aldar Properties"),
    ("majid", "Majid Al Futtaim"),
    ("mag", "MAG Property Development"),
]

# Texts that stand for "no metro nearby" and for a missing developer.
NO_METRO = ["no_nearest_metro_en", "missing_nearest_metro_en", "nan", "none"]
MISSING_DEVELOPER = "Missing_developer_name_en"

# Transaction rules.
EXCLUDED_TRANSACTION_GROUPS = ["Gifts", "Mortgages"]
HOME_USAGE, HOME_TYPE = "Residential", "Unit"

# Columns imputed per building and per project, median-imputed columns, labelled columns.
BUILDING_FILL = ["elevators", "swimming_pools"]
PROJECT_FILL = [
    "land_type_en", "nearest_mall_en", "nearest_metro_en", "nearest_landmark_en", "project_start_date",
    "project_end_date", "completion_date", "built_up_area",
]
MEDIAN_FILL = ["has_parking", "meter_sale_price", "unit_balcony_area", "built_up_area", "swimming_pools"]
LABELLED = ["project_name_en", "land_type_en", "developer_name_en", "building_name_en", "property_sub_type_en", "floor_key"]

# Unit columns completed from the building row.
UNIT_FILL = [
    "area_id", "land_number", "building_number", "rooms_en", "property_sub_type_id", "actual_area", "creation_date",
    "master_project_en", "master_project_ar", "project_id", "project_name_en",
]

# Decay of sentiment and price reaction per event code.
# (code, sentiment half-life in months, peak month of the price reaction, price sensitivity, direction)
EVENT_DECAY = [
    ("GEO_RISK_ESCALATION", 1.5, 4.0, 0.020, -1),
    ("GEO_RISK_DEESCALATION", 1.5, 2.0, 0.010, 1),
    ("INFRA_DELAY_OR_CANCEL", 4.0, 6.0, 0.012, -1),
    ("REGULATORY_TIGHTENING_RE", 5.0, 5.0, 0.015, -1),
    ("REGULATORY_EASING_RE", 3.0, 3.0, 0.012, 1),
    ("SUPPLY_DELAY", 3.0, 5.0, 0.008, -1),
    ("OIL_PRICE_SHOCK_UP", 2.0, 3.0, 0.010, 1),
    ("ENERGY_POLICY_SHIFT", 6.0, 8.0, 0.008, -1),
    ("GLOBAL_TOURISM_SHOCK", 3.0, 4.0, 0.018, -1),
    ("NEW_SUPPLY_ANNOUNCEMENT", 4.0, 6.0, 0.010, -1),
    ("PANDEMIC_OUTBREAK", 1.0, 3.0, 0.025, -1),
    ("DEFAULT", 3.0, 4.0, 0.015, -1),
]

# Severity rank per event code (unknown codes rank 0).
EVENT_SEVERITY = [
    ("GEO_RISK_ESCALATION", 10),
    ("PANDEMIC_OUTBREAK", 9),
    ("GLOBAL_TOURISM_SHOCK", 8),
    ("REGULATORY_TIGHTENING_RE", 7),
    ("OIL_PRICE_SHOCK_UP", 6),
    ("INFRA_DELAY_OR_CANCEL", 5),
    ("ENERGY_POLICY_SHIFT", 4),
    ("SUPPLY_DELAY", 5),
    ("NEW_SUPPLY_ANNOUNCEMENT", 5),
    ("REGULATORY_EASING_RE", 6),
    ("GEO_RISK_DEESCALATION", 7),
]

# Event strength bounds and the weight of an unscored event.
STRENGTH_MIN, STRENGTH_MAX, DEFAULT_WEIGHT = 0.2, 1.5, 0.5

# Place keywords -> (region, country), first match wins; sources that imply a place.
GEO_KEYWORDS = [
    (["dubai", "abu dhabi", "sharjah", "ajman", "rak", "fujairah"], "GCC", "UAE"),
    (["saudi", "riyadh"], "GCC", "Saudi Arabia"),
    (["kuwait"], "GCC", "Kuwait"),
    (["bahrain"], "GCC", "Bahrain"),
    (["oman", "muscat"], "GCC", "Oman"),
    (["qatar", "doha"], "GCC", "Qatar"),
    (["iran"], "MENA", "Iran"),
    (["nigeria"], "Africa", "Nigeria"),
    (["philippines"], "Asia", "Philippines"),
]
LOCAL_SOURCES = ["Dubai Chronicle", "Abu Dhabi IPR", "Dubai Confidential", "Khaleej Times"]

# Area centre points (latitude, longitude).
AREA_CENTRES = [
    ("Al Barsha First", 25.1150, 55.2050),
    ("Al Barshaa South Second", 25.0921, 55.2410),
    ("Al Barshaa South Third", 25.0760, 55.2150),
    ("Al Barsha South Fourth", 25.0610, 55.2360),
    ("Al Barsha South Fifth", 25.0485, 55.2341),
    ("Al Hebiah First", 25.0334, 55.2205),
    ("Al Hebiah Second", 25.0420, 55.2450),
    ("Al Hebiah Third", 25.0160, 55.2380),
    ("Al Hebiah Fourth", 25.0210, 55.2150),
    ("Al Hebiah Sixth", 24.9950, 55.2320),
    ("Al Khairan First", 25.1850, 55.3550),
    ("Al Kifaf", 25.2350, 55.2950),
    ("Al Merkadh", 25.1480, 55.3050),
    ("Al Thanyah Third", 25.0850, 55.1550),
    ("Al Thanyah Fifth", 25.0685, 55.1450),
    ("Al Warsan First", 25.1650, 55.4150),
    ("Al Yelayiss 2", 24.9650, 55.2650),
    ("Bukadra", 25.1850, 55.3350),
    ("Burj Khalifa", 25.1972, 55.2744),
    ("Business Bay", 25.1850, 55.2750),
    ("Hadaeq Sheikh Mohammed Bin Rashid", 25.1150, 55.2950),
    ("Jabal Ali", 25.0000, 55.0500),
    ("Jabal Ali First", 25.0220, 55.1050),
    ("Jabal Ali Industrial Second", 24.9850, 55.1250),
    ("Madinat Al Mataar", 24.8950, 55.1550),
    ("Madinat Dubai Almelaheyah", 25.2650, 55.2750),
    ("Madinat Hind 4", 25.0250, 55.4550),
    ("Marsa Dubai", 25.0780, 55.1350),
    ("Me'Aisem First", 25.0350, 55.1950),
    ("Nadd Hessa", 25.1250, 55.3850),
    ("Palm Deira", 25.3150, 55.3050),
    ("Palm Jumeirah", 25.1124, 55.1390),
    ("Ras Al Khor Industrial First", 25.1950, 55.3650),
    ("Wadi Al Safa 2", 25.1200, 55.3700),
    ("Wadi Al Safa 3", 25.0850, 55.3250),
    ("Wadi Al Safa 4", 25.1450, 55.3050),
    ("Wadi Al Safa 5", 25.0950, 55.3650),
    ("Warsan Fourth", 25.1550, 55.4250),
    ("Zaabeel First", 25.2200, 55.2850),
    ("Zaabeel Second", 25.2050, 55.2950),
]
EARTH_RADIUS_KM, MAX_MATCH_KM = 6371.0, 8.0

# Areas served by a stand-in area group.
AREA_STAND_INS = [
    ("Al Barsha First", "proxy1"),
    ("Al Hebiah Second", "proxy1"),
    ("Al Hebiah Sixth", "proxy1"),
    ("Al Hebiah Third", "proxy1"),
    ("Madinat Hind 4", "proxy1"),
    ("Wadi Al Safa 3", "proxy1"),
    ("Wadi Al Safa 4", "proxy1"),
    ("Wadi Al Safa 7", "proxy1"),
    ("Bukadra", "proxy2"),
    ("Ras Al Khor Industrial First", "proxy2"),
    ("Jumeirah First", "proxy2"),
    ("Palm Deira", "proxy2"),
    ("Al Thanyah Third", "proxy3"),
    ("Jabal Ali Industrial Second", "proxy3"),
    ("Al Kifaf", "G1"),
    ("Warsan Fourth", "G3"),
    ("Jabal Ali", "G3"),
    ("Zaabeel Second", "G4"),
    ("Zaabeel First", "G4"),
]

# Members of each area group.
AREA_GROUPS = [
    ("G1", "Wadi Al Safa 4"), ("G1", "Al Kifaf"),
    ("G2", "Dubai Investment Park First"), ("G2", "Wadi Al Safa 7"),
    ("G3", "Warsan Fourth"), ("G3", "Jabal Ali"),
    ("G4", "Zaabeel Second"), ("G4", "Zaabeel First"),
    ("G5", "Saih Shuaib 2"), ("G5", "Nad Al Shiba First"),
    ("Proxy1", "Al Barsha South Fourth"), ("Proxy1", "Al Barshaa South Third"), ("Proxy1", "Al Yelayiss 2"),
    ("Proxy2", "Bukadra"), ("Proxy2", "Madinat Dubai Almelaheyah"),
    ("Proxy3", "Jabal Ali First"), ("Proxy3", "Me'Aisem First"),
]

# Plausible requested area (m2) per room label; any other label uses the last pair.
REQUEST_AREA_RANGES = [("Studio", 25.0, 45.0), ("1 B/R", 45.0, 70.0), ("2 B/R", 65.0, 90.0), ("3 B/R", 80.0, 110.0)]
REQUEST_AREA_RANGE_OTHER = (110.0, 145.0)
REQUEST_AREA_DEFAULT = 55.0

# Last-resort request defaults, and the fields a request may not set.
REQUEST_DEFAULTS = {
    "rooms_en": "1 B/R",
    "reg_type_en": "Off-Plan Properties",
    "floor_bin": "1-10",
    "Grade": "B",
    "project_grade": "B",
    "Developer_grade": "B",
    "Developer Reputation Tier": "Tier 2 - Established Premium",
    "trans_group_en": "Sales",
    "Locality Zone": "Suburban 🌳",
    "Price Tier": "Mid-Range ●",
    "Developer Tier": "Tier 2 – Established",
    "Reputation": "Good ✓",
    "Score": 7.0,
    "has_parking": 1,
    "swimming_pool": 1,
    "balcony": 1,
    "elevators": 1,
    "metro": 1,
}
LOCKED_REQUEST_FIELDS = [
    "Developer Reputation Tier", "trans_group_en", "Locality Zone", "Price Tier", "Developer Tier", "Reputation", "Score",
]

# Columns a history row is matched on.
PROFILE_COLUMNS = ["Developer_grade", "reg_type_en", "rooms_en", "trans_group_en"]

# Row-count rules.
MIN_AREA_ROWS, MIN_FIT_ROWS, MIN_SERIES_MONTHS, MIN_TRIM_ROWS = 6000, 30, 50, 10
MAX_ZERO_SHARE = 0.90
HORIZON, BACKTEST_MONTHS = 6, 6
HISTORY_START = "2020-01-01"

# Column lists of the link table.
PROJECT_DATES = ["project_start_date", "project_end_date", "completion_date", "cancellation_date", "registration_date"]
MICRO_COLUMNS = [
    "area_id_u", "unit_balcony_area", "floor_key", "floor_bin", "rooms_en_u", "actual_area_u", "creation_date_u",
    "creation_date_bld", "land_type_en", "floors", "rooms_en_bld", "built_up_area", "bld_levels", "swimming_pools",
    "elevators", "project_start_date", "project_end_date", "completion_date", "cancellation_date", "no_of_lands",
    "no_of_buildings", "no_of_villas", "no_of_units", "developer_name_en", "registration_date", "developer_number",
    "project_number", "trans_ubp_key", "property_id_bld", "property_id_u",
]
UNUSED = ["zone_id", "land_sub_number", "common_area", "actual_common_area", "rooms", "land_type_id"]
MICRO_ONLY = ["no_of_lands", "cancellation_date", "rooms_en_bld", "trans_ubp_key"]
