"""Marts: event demand uplift (static and trailing), station KPIs, line
performance.

Window partitions here are over the *hourly fact*, never over taps: a
(station, weekday, hour) partition holds at most one row per week, so no
window group grows with tap volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X
from railyard.operators import geo


def _with_calendar_keys(fact: DataFrame) -> DataFrame:
    return (fact.withColumn("day_of_week", X.dow_sunday0("tap_hour_utc"))
                .withColumn("hour_of_day", X.hour_of_day("tap_hour_utc")))


def _uplift_columns(riders, base, sd):
    riders, base, sd = F.col(riders), F.col(base), F.col(sd)
    return [
        X.r6(base).alias("baseline_riders"),
        X.r6(sd).alias("baseline_riders_sd"),
        X.r6(riders - base).alias("uplift_riders"),
        X.r6(F.when(base == 0, F.lit(None)).otherwise((riders - base) / base)).alias("uplift_multiplier"),
        X.r6(F.when(sd.isNull() | (sd == 0), F.lit(None)).otherwise((riders - base) / sd)).alias("uplift_z_score"),
        (F.try_divide(riders.cast("double"), base) >= F.lit(C.UPLIFT_FLOOR_MULTIPLIER)).alias("meets_uplift_floor"),
    ]


def uplift_static(fact: DataFrame) -> DataFrame:
    """As coded: baseline = mean and population sd of unique riders over all
    history of the same (station, weekday, hour), the row itself included."""
    f = _with_calendar_keys(fact)
    w = Window.partitionBy("station_id", "day_of_week", "hour_of_day")
    f = (f.withColumn("_b", F.avg("unique_riders").over(w))
          .withColumn("_sd", F.stddev_pop("unique_riders").over(w)))
    return f.select("date_key", "tap_hour_utc", "station_id", "line_id", "day_of_week", "hour_of_day",
                    "unique_riders", *_uplift_columns("unique_riders", "_b", "_sd"))


def uplift_trailing(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """As documented: baseline over the trailing 8 weeks (56 days before the
    row's day, the day itself excluded) of the same (station, weekday,
    hour), event days left out; each hour joined to the events active at its
    station (grain event x station x hour; hours without an event keep a
    NULL ``event_id``)."""
    event_days = geo.event_days(calendar)
    f = _with_calendar_keys(fact).withColumn("service_date", F.to_date("tap_hour_utc"))
    f = (f.join(event_days, "service_date", "left")
          .withColumn("is_event_day", F.coalesce(F.col("is_event_day"), F.lit(False)))
          .withColumn("_epoch_day", F.datediff("service_date", F.lit("1970-01-01").cast("date"))))
    w = (Window.partitionBy("station_id", "day_of_week", "hour_of_day")
         .orderBy("_epoch_day").rangeBetween(-C.TRAILING_BASELINE_DAYS, -1))
    clean = F.when(~F.col("is_event_day"), F.col("unique_riders"))
    f = f.withColumn("_b", F.avg(clean).over(w)).withColumn("_sd", F.stddev_pop(clean).over(w))
    ev = geo.exploded_events(calendar).select("event_id", "_ev_station", "start_ts", "end_ts")
    f = f.join(ev, (F.col("station_id") == F.col("_ev_station")) & (F.col("tap_hour_utc") >= F.col("start_ts"))
               & (F.col("tap_hour_utc") <= F.col("end_ts")), "left")
    return f.select("date_key", "tap_hour_utc", "station_id", "line_id", "event_id", "is_event_day",
                    "unique_riders", *_uplift_columns("unique_riders", "_b", "_sd"))


def station_kpis(ridership: DataFrame, revenue: DataFrame, since=None) -> DataFrame:
    """Station x day KPIs over the two facts (decisions D1, D2).

    ``since`` (a date Column) restricts both inputs to the trailing window,
    the incremental form of the mart."""
    r = ridership.withColumn("service_date", F.to_date("tap_hour_utc"))
    v = revenue.withColumn("service_date", F.to_date("tap_hour_utc"))
    if since is not None:
        r, v = r.filter(F.col("service_date") >= since), v.filter(F.col("service_date") >= since)
    rd = r.groupBy("station_id", "service_date").agg(
        F.sum("total_taps").alias("daily_taps"),
        F.max("total_taps").alias("peak_hour_taps"),
        X.r6(F.avg("total_taps")).alias("avg_hour_taps"),
        F.countDistinct("tap_hour_utc").alias("active_hours"))

    def cls(name):
        return F.sum(F.when(F.upper("fare_class") == name, F.col("paid_tap_count")).otherwise(0)).cast("bigint")

    fd = v.groupBy("station_id", "service_date").agg(
        F.sum(F.round(F.col("gross_fare_revenue_cad") * 100).cast("bigint")).alias("fare_revenue_cents"),
        cls("CONCESSION").alias("concession_taps"),
        cls("YOUTH").alias("youth_taps"),
        cls("SENIOR").alias("senior_taps"),
        cls("EMPLOYEE").alias("employee_taps"))
    j = rd.join(fd, ["station_id", "service_date"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return j.select(
        "station_id", "service_date", "daily_taps", "peak_hour_taps", "avg_hour_taps", "active_hours",
        z("fare_revenue_cents").alias("fare_revenue_cents"),
        F.round(z("fare_revenue_cents") / F.lit(100.0), 2).alias("fare_revenue_dollars"),
        z("concession_taps").alias("concession_taps"),
        z("youth_taps").alias("youth_taps"),
        z("senior_taps").alias("senior_taps"),
        z("employee_taps").alias("employee_taps"),
        X.r6(X.safe_div(z("concession_taps"), "daily_taps")).alias("concession_share"),
        X.volume_band("daily_taps").alias("daily_volume_band"),
    )


def stamp_materialized(df: DataFrame) -> DataFrame:
    """``_materialized_at`` (P9) for written tables; a clock column, so it is
    never part of a compared or hashed output."""
    return df.withColumn("_materialized_at", F.current_timestamp())


def line_performance(ridership: DataFrame, revenue: DataFrame, lines: DataFrame) -> DataFrame:
    """Line x day roll-up of ridership and revenue."""
    r = (ridership.withColumn("service_date", F.to_date("tap_hour_utc"))
         .groupBy("line_id", "service_date")
         .agg(F.sum("total_taps").alias("total_taps"),
              F.sum("tap_on_count").alias("tap_on_count"),
              F.sum("unique_riders").alias("rider_hours"),
              F.countDistinct("station_id").alias("active_stations")))
    v = (revenue.withColumn("service_date", F.to_date("tap_hour_utc"))
         .groupBy("line_id", "service_date")
         .agg(F.sum(X.money("gross_fare_revenue_cad")).alias("_rev"),
              F.sum("paid_tap_count").alias("paid_tap_count")))
    j = r.join(v, ["line_id", "service_date"], "left").join(lines, "line_id", "left")
    return j.select("line_id", "line_name", "service_date", "total_taps", "tap_on_count", "rider_hours",
                    "active_stations",
                    X.money_out(F.coalesce(F.col("_rev"), F.lit(0))).alias("gross_fare_revenue_cad"),
                    F.coalesce(F.col("paid_tap_count"), F.lit(0)).cast("bigint").alias("paid_tap_count"),
                    X.r6(X.safe_div("_rev", "paid_tap_count")).alias("avg_fare_per_tap_cad"))
