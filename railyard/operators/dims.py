"""Dimensions: date (N1, N2, N7), station (N3), line (N4), code bridge.

The date dimension spans the years the data covers (a one-row aggregate over
the sources feeds ``sequence``), so it follows the data instead of a fixed
range; it holds one row per calendar day and stays small at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X


def date_spine(bounds: DataFrame) -> DataFrame:
    """``bounds`` has one row with integer ``y0`` and ``y1``; returns every
    day of those years, inclusive."""
    return bounds.select(F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                                              F.make_date("y1", F.lit(12), F.lit(31)),
                                              F.expr("INTERVAL 1 DAY"))).alias("calendar_date"))


def dim_date(spine: DataFrame, event_days: DataFrame | None = None) -> DataFrame:
    d = F.col("calendar_date")
    out = spine.select(
        X.date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        X.iso_dow(d).alias("day_of_week_iso"), F.date_format(d, "EEEE").alias("day_name"),
        X.is_weekend(d).alias("is_weekend"))
    out = out.withColumn("day_type", X.day_type("is_weekend"))
    if event_days is not None:
        ed = event_days.withColumnRenamed("service_date", "calendar_date")  # bounded: event days
        out = out.join(ed, "calendar_date", "left") \
                 .withColumn("is_event_day", F.coalesce(F.col("is_event_day"), F.lit(False)))
    return out


def dim_station(stations: DataFrame, lines: DataFrame) -> DataFrame:
    """Stations with line name and both distances to the anchor."""
    j = stations.join(lines, "line_id", "left")
    a_lat, a_lon = C.UNION_ANCHOR
    return j.select("station_id", "name", "line_id", "line_name", "zone", "lat", "lon",
                    X.r6(X.planar_km("lat", "lon")).alias("km_planar"),
                    X.r6(X.haversine_km("lat", "lon", F.lit(a_lat), F.lit(a_lon))).alias("km_haversine"))


def dim_line(stations: DataFrame, lines: DataFrame) -> DataFrame:
    per = stations.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_stations"),
                                          F.countDistinct("zone").alias("n_zones"))
    return lines.join(per, "line_id", "left").select(
        "line_id", "line_name", F.coalesce("n_stations", F.lit(0)).cast("bigint").alias("n_stations"),
        F.coalesce("n_zones", F.lit(0)).cast("bigint").alias("n_zones"))


def code_bridge(df: DataFrame, key: str, codes: str, sep: str = "-") -> DataFrame:
    """Hyphen-delimited code list -> one row per (key, position, code)."""
    return df.select(key, F.posexplode(X.split_codes(codes, sep)).alias("position", "code")) \
             .select(key, (F.col("position") + 1).alias("position"), "code")
