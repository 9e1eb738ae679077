"""Column helpers (scalar functions F1-F26).

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` only, so
expressions stay JVM-side inside whole-stage codegen; no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 / F23 -------------------------------------------------------------------
def hour_trunc(ts) -> Column:
    """Truncate to the hour (session zone is UTC)."""
    return F.date_trunc("hour", _c(ts))


def path_date(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def path_hour(ts) -> Column:
    return F.date_format(_c(ts), "HH")


# F2 -------------------------------------------------------------------------
def date_key(ts) -> Column:
    """Integer yyyymmdd key (``to_char`` has no Spark form)."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


# F3 / F4 / F5 / F7 -----------------------------------------------------------
def dow_sunday0(ts) -> Column:
    """Day of week with Sunday = 0 (SQL ``extract(dow)`` convention)."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def iso_dow(d) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("int")


def is_weekend(d) -> Column:
    return F.weekday(_c(d)) >= 5


# F11 / F12 / F13 / F20 -------------------------------------------------------
def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den), F.lit(0)).cast("double"))


def zero_guard_ratio(num, den) -> Column:
    """0 (not NULL) when the denominator is 0."""
    den = _c(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(_c(num).cast("double") / den.cast("double"))


def r6(c) -> Column:
    """Round a ratio to 6 places (the shared rounding rule for ratios)."""
    return F.round(_c(c).cast("double"), 6)


def money(c) -> Column:
    """Money as decimal(18,2) so sums do not depend on row order."""
    return _c(c).cast("decimal(18,2)")


def money_out(c) -> Column:
    """Decimal money sum back to double, 2 places."""
    return F.round(_c(c).cast("double"), 2)


# F14 / F15 -------------------------------------------------------------------
def planar_km(lat, lon, anchor=C.UNION_ANCHOR) -> Column:
    """Planar degree distance x 111 km; ignores cos(lat) by definition."""
    a_lat, a_lon = anchor
    return F.sqrt(F.pow(_c(lat) - F.lit(a_lat), 2) + F.pow(_c(lon) - F.lit(a_lon), 2)) * F.lit(C.KM_PER_DEGREE)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km, R = 6371; clamps the asin argument."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * C.EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


# F16 -------------------------------------------------------------------------
def demand_curve(hour) -> Column:
    k = C.DEMAND_CURVE
    h = _c(hour).cast("double")
    return (F.lit(k["base"])
            + F.lit(k["a1"]) * F.exp(-F.pow(h - F.lit(k["c1"]), 2) / F.lit(k["w1"]))
            + F.lit(k["a2"]) * F.exp(-F.pow(h - F.lit(k["c2"]), 2) / F.lit(k["w2"])))


# P6 / P7 ---------------------------------------------------------------------
def day_type(weekend) -> Column:
    return F.when(_c(weekend), F.lit("WEEKEND")).otherwise(F.lit("WEEKDAY"))


def volume_band(daily_taps) -> Column:
    x = _c(daily_taps)
    expr = None
    for threshold, label in C.VOLUME_BANDS:
        expr = F.when(x >= threshold, F.lit(label)) if expr is None else expr.when(x >= threshold, F.lit(label))
    return expr.otherwise(F.lit(C.VOLUME_BAND_ELSE))


# F21 / F22 -------------------------------------------------------------------
def schema_version_ok(c) -> Column:
    return _c(c).rlike(C.SCHEMA_VERSION_PATTERN)


def normalise_id(c) -> Column:
    return F.trim(F.upper(_c(c)))


def id_is_valid(c) -> Column:
    """Alphanumeric, or containing an underscore (the scoring rule)."""
    x = _c(c)
    return x.rlike("^[A-Za-z0-9]+$") | x.contains("_")


# F24 / F25 / F26 -------------------------------------------------------------
def json_int(c, path: str) -> Column:
    return F.get_json_object(_c(c), path).cast("int")


def split_codes(c, sep: str = "-") -> Column:
    return F.split(_c(c), sep)


# R1 helper ---------------------------------------------------------------------
def ord_sum(c) -> Column:
    """Sum of the code points of a string, without a UDF."""
    chars = F.split(_c(c), "")
    return F.aggregate(F.transform(chars, lambda ch: F.ascii(ch)), F.lit(0), lambda acc, x: acc + x)


def forecast_hour_factor(hour) -> Column:
    h = _c(hour)
    return (F.when((h >= 7) & (h <= 9), F.lit(1.5))
            .when((h >= 16) & (h <= 18), F.lit(1.4))
            .when(h <= 5, F.lit(0.5))
            .otherwise(F.lit(1.0)))
