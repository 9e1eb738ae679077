"""Fixed values.

Values that must equal the tap model's for right results are kept here as
plain text, in their natural order, so every module and the SQL oracle read
the same ones.
"""

from __future__ import annotations

# --- fixed values: tap vocabulary -------------------------------------------
FARE_CLASSES = ("ADULT", "SENIOR", "YOUTH", "CHILD", "CONCESSION")
TAP_TYPES = ("TAP_ON", "TAP_OFF")

# --- fixed values: expected fare-class mix and fare per class ---------------
FARE_CLASS_DISTRIBUTION = (
    ("ADULT", 0.62),
    ("SENIOR", 0.14),
    ("YOUTH", 0.10),
    ("CHILD", 0.04),
    ("CONCESSION", 0.10),
)
FARE_BY_CLASS = (
    ("ADULT", 6.05),
    ("SENIOR", 4.50),
    ("YOUTH", 4.20),
    ("CHILD", 0.00),
    ("CONCESSION", 3.10),
)

# --- fixed values: daily volume bands (threshold, label), checked top down ---
VOLUME_BANDS = (
    (50000, "very_high"),
    (20000, "high"),
    (5000, "medium"),
    (500, "low"),
)
VOLUME_BAND_ELSE = "very_low"

# --- fixed values: measures and flags ---------------------------------------
UPLIFT_FLOOR_MULTIPLIER = 1.15
PEAK_HOURS = (8, 17)
TRAILING_BASELINE_DAYS = 56          # 8 weeks
KPI_TRAILING_DAYS = 7
LATE_WATERMARK = "2 hours"

# --- fixed values: two-Gaussian hourly demand curve --------------------------
# base + a1 * exp(-(h - c1)^2 / w1) + a2 * exp(-(h - c2)^2 / w2)
DEMAND_CURVE = {"base": 0.08, "a1": 0.50, "c1": 8.0, "w1": 6.0,
                "a2": 0.60, "c2": 17.0, "w2": 8.0}

# --- fixed values: geography -------------------------------------------------
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0
UNION_ANCHOR = (43.6453, -79.3806)   # (lat, lon) of the planar-distance anchor

# --- fixed values: stub forecast ---------------------------------------------
FORECAST_SEED_MOD = 100
FORECAST_SEED_OFFSET = 25
FORECAST_SCALE = 100
FORECAST_BAND = (0.85, 1.15)         # 80 % interval multipliers
FORECAST_MAX_HORIZON = 168
FORECAST_MAX_ID_LEN = 32
# hour factors: 1.5 for 07-09, 1.4 for 16-18, 0.5 for 00-05, else 1.0

# --- fixed values: freshness tiers (warn, error) in minutes ------------------
FRESHNESS_TIERS = {
    "bronze": (10, 30),
    "silver": (30, 120),
}
RETENTION_DAYS = 730
SCHEMA_VERSION_PATTERN = "^v[0-9]+$"
LAG_ALERT_SECONDS = 300

# --- binding of the driver's test tables to the tap model -------------------
# event_type of the `events` table stands for the five fare classes.
EVENT_TYPE_TO_FARE_CLASS = (
    ("view", "ADULT"),
    ("click", "SENIOR"),
    ("purchase", "YOUTH"),
    ("signup", "CHILD"),
    ("error", "CONCESSION"),
)
N_STATIONS_BOUND = 25                # station_id = k mod 25 (n_nationkey)
DUPLICATE_K_BELOW = 10               # rows with k < 10 are re-ingested
VIOLATION_BAD_TAP_TYPE_K = 99
VIOLATION_UNKNOWN_STATION_K = 98
UNKNOWN_STATION_ID = 99
ORDERS_AS_OF = "2001-08-01"

# --- event calendar (small inline table) ------------------------------------
# (event_id, start, end, station_ids, uplift_multiplier); times are UTC.
EVENT_CALENDAR = (
    ("E1", "2024-01-10 18:00:00", "2024-01-10 23:00:00", (3, 7), 4.5),
    ("E2", "2024-01-20 12:00:00", "2024-01-20 20:00:00", (7,), 2.8),
    ("E3", "2024-01-20 16:00:00", "2024-01-21 00:00:00", (7, 12), 3.5),
)

# --- user access scopes (small inline table) ---------------------------------
# (user, role, scope kind, scope value)
USER_SCOPES = (
    ("all@example.com", "executive", "all", None),
    ("line0@example.com", "operations-line0", "line", 0),
    ("partner@example.com", "external-partner", "stations", (7,)),
    ("analyst@example.com", "analyst", "all_but_pilots", None),
)
# Stations of experimental pilots.
PILOT_STATIONS = (3, 11)
