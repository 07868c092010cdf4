"""Plain settings. Fixed values are the thresholds and lookups results depend on."""

from __future__ import annotations

# --- fixed values: validity bounds -----------------------------------------
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
MAGNITUDE_RANGE = (1.0, 10.0)
DEPTH_RANGE_KM = (-10.0, 1000.0)
MIN_ID_LENGTH = 5  # an id must be longer than this

# --- fixed values: severity ladders, highest step first ---------------------
# (magnitude at or above, score, category)
MAGNITUDE_LADDER = [
    (8.0, 1.0, "Great"),
    (7.0, 0.9, "Major"),
    (6.0, 0.8, "Strong"),
    (5.0, 0.6, "Moderate"),
    (4.0, 0.4, "Light"),
    (3.0, 0.2, "Minor"),
]
MAGNITUDE_FLOOR = (0.1, "Micro")

WEATHER_SEVERITY_SCORES = {"Extreme": 1.0, "Severe": 0.8, "Moderate": 0.6, "Minor": 0.4}
WEATHER_SEVERITY_DEFAULT = 0.2
URGENCY_SCORES = {"Immediate": 1.0, "Expected": 0.8, "Future": 0.6}
URGENCY_DEFAULT = 0.4
SEVERITY_WEIGHT, URGENCY_WEIGHT = 0.7, 0.3

# --- fixed values: weather categories, first match wins ---------------------
WEATHER_CATEGORIES = [
    ("tornado", "Severe Weather"),
    ("hurricane|typhoon|cyclone", "Tropical Cyclone"),
    ("flood", "Flood"),
    ("winter|snow|ice|blizzard", "Winter Weather"),
    ("heat|temperature", "Temperature Extreme"),
    ("fire", "Fire Weather"),
    ("wind", "High Wind"),
]
CATEGORY_DEFAULT = "Other"

# --- fixed values: regions (name, min_lon, max_lon, min_lat, max_lat) -------
# Where boxes overlap, the later one in the list wins.
REGION_BOXES = [
    ("North America - West Coast", -125.0, -120.0, 32.0, 49.0),
    ("North America - East Coast", -80.0, -65.0, 25.0, 45.0),
    ("North America - Central", -110.0, -90.0, 30.0, 50.0),
    ("Japan Region", 129.0, 146.0, 30.0, 46.0),
    ("Indonesia Region", 95.0, 141.0, -11.0, 6.0),
    ("Philippines Region", 116.0, 127.0, 5.0, 21.0),
    ("Chile Region", -76.0, -66.0, -56.0, -17.0),
    ("New Zealand Region", 166.0, 179.0, -47.0, -34.0),
    ("Alaska Region", -170.0, -130.0, 54.0, 72.0),
    ("Mediterranean", -6.0, 37.0, 30.0, 47.0),
    ("Mid-Atlantic Ridge", -35.0, -10.0, -60.0, 70.0),
]
REGION_DEFAULT = "Other"

# --- fixed values: reference cities (name, latitude, longitude) -------------
CITIES = [
    ("Tokyo", 35.6762, 139.6503),
    ("Los Angeles", 34.0522, -118.2437),
    ("San Francisco", 37.7749, -122.4194),
    ("Mexico City", 19.4326, -99.1332),
    ("Jakarta", -6.2088, 106.8456),
    ("Manila", 14.5995, 120.9842),
    ("Santiago", -33.4489, -70.6693),
]
KM_PER_DEGREE = 111.0
NO_CITY_KM = 999999.0
# (distance at or below, risk), nearest first
RISK_BANDS = [(50.0, "High"), (200.0, "Medium")]
RISK_DEFAULT = "Low"

# --- fixed values: flags -----------------------------------------------------
RECENT_DAYS = 7
SIGNIFICANT_SCORE = 600
ALERT_MAGNITUDE = 5.0
ALERT_RISKS = ("High", "Medium")
IMMINENT_HOURS = 6
WEATHER_ALERT_SCORE = 0.7

# --- fixed values: jobs ------------------------------------------------------
DEDUP_HORIZON_HOURS = 24
ANOMALY_LOOKBACK_DAYS = 30
RAW_RETENTION_DAYS = 90
PROCESSED_RETENTION_DAYS = 365
POLL_INTERVAL = "5 minutes"

# --- fixed values: anomaly detection ----------------------------------------
STAT_FEATURES = ["magnitude", "depth_km", "significance", "severity_score"]
ZSCORE_LIMIT = 3.0
BASELINE_ROWS = 167
BASELINE_HOURS = 168
FREQUENCY_ZSCORE_LIMIT = 2.0
FREQUENCY_COUNT_LIMIT = 10
MAGNITUDE_JUMP = 1.5
CLUSTERS, CLUSTER_SEED, CLUSTER_MAX_ITER = 8, 42, 100
CLUSTER_STD_FACTOR, CLUSTER_FLAT_FACTOR = 2.0, 1.5
GRID_DEGREES = 1.0
GRID_ZSCORE_LIMIT = 2.0
GRID_MAGNITUDE_EXCESS = 1.0
SUCCESSION_COUNT, SUCCESSION_HOURS = 5, 24
PATTERN_ZSCORE_LIMIT = 2.0
PATTERN_EXTREME_COUNT = 5
HIGH_RISK_SCORE = 0.8

# --- fixed values: feeds -----------------------------------------------------
FEED_MIN_MAGNITUDE = 2.5
FEED_PAGE = 1000  # rows of a page, where a caller asks for pages
SIGNIFICANT_FEED = {"days": 7, "min_significance": 600, "limit": 100}
# name -> (column, lowest value, hours back); None keeps every event
LIVE_FEEDS = {
    "significant_month": ("significance", 600, 30 * 24),
    "4.5_month": ("magnitude", 4.5, 30 * 24),
    "2.5_month": ("magnitude", 2.5, 30 * 24),
    "all_hour": (None, None, 1),
    "all_day": (None, None, 24),
}

# --- fixed values: alerts ----------------------------------------------------
QUAKE_ALERT_LADDER = [(7.0, "Critical"), (6.0, "High"), (5.0, "Medium")]
WEATHER_ALERT_LEVELS = {"Extreme": "Critical", "Severe": "High", "Moderate": "Medium"}
ALERT_LEVEL_DEFAULT = "Low"
ANOMALY_ALERT_LEVEL = "Medium"
URGENT_LEVELS = ("Critical", "High")
URGENT_CHANNELS, DEFAULT_CHANNELS = ("teams", "sms"), ("teams",)
EVENT_ICONS = {"earthquake": "🌍", "weather": "⛈️", "anomaly": "⚠️"}
DEFAULT_ICON = "📢"
SMS_LIMIT = 160
CARD_VERSION = "1.4"
CARD_CONTENT_TYPE = "application/vnd.microsoft.card.adaptive"
# (title, url) pairs on critical cards; set the urls for your deployment
CARD_ACTIONS = [
    ("View Dashboard", "https://dashboard.example.com/"),
    ("Emergency Procedures", "https://emergency.example.com/procedures"),
]
# recipient group -> addresses; set for your deployment
CONTACTS = {
    "critical_contacts": ["+10000000001", "+10000000002"],
    "weather_team": ["weather-team"],
    "data_team": ["data-team"],
}
SMS_GROUP = "critical_contacts"
# (source, name, condition, channels, recipient group)
ALERT_RULES = [
    ("quakes", "Major Earthquake Alert", "magnitude >= 6.0", ["teams", "sms"], "critical_contacts"),
    ("weather", "Severe Weather Alert", "severity == 'Extreme'", ["teams"], "weather_team"),
    ("anomalies", "Anomaly Detection Alert", "anomaly_score > 0.8", ["teams"], "data_team"),
]

# --- fixed values: dashboard products ---------------------------------------
MAP_DAYS, MAP_MIN_MAGNITUDE = 7, 2.5
RECENT_ALERT_ITEMS = 8
POINT_LEVELS = ("event", "hour", "day")
ANOMALY_TYPES = ["statistical", "clustering", "geographic"]
BOOKMARKS = {
    "Critical Events": {"severity": ["Critical", "High"], "hours": 24},
    "Pacific Ring of Fire": {
        "regions": ["Japan Region", "Indonesia Region", "Chile Region"],
        "magnitude": (4.0, 10.0),
    },
}
