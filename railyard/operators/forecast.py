"""Batch forecasts and attribution.

R1 re-aims the stub scoring service as a batch job over a request table:
each request is exploded to ``horizon_hours`` points with ``sequence`` and
scored with column arithmetic (double literals, truncation like ``int()``).
R2 routes invalid requests to a reject frame with reasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X


def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) requests; ids are upper-cased and trimmed first."""
    r = requests.withColumn("station_id", X.normalise_id("station_id"))
    reasons = F.array_compact(F.array(
        F.when((F.length("station_id") < 1) | (F.length("station_id") > C.FORECAST_MAX_ID_LEN), F.lit("id_length")),
        F.when(~F.coalesce(X.id_is_valid("station_id"), F.lit(False)), F.lit("id_chars")),
        F.when(~F.coalesce(F.col("horizon_hours").between(1, C.FORECAST_MAX_HORIZON), F.lit(False)),
               F.lit("horizon_range"))))
    t = r.withColumn("_reasons", reasons)
    ok = t.filter(F.size("_reasons") == 0).drop("_reasons")
    bad = t.filter(F.size("_reasons") > 0).withColumn("reasons", F.array_join("_reasons", ",")).drop("_reasons")
    return ok, bad


def seed(station_id) -> F.Column:
    return X.ord_sum(station_id) % C.FORECAST_SEED_MOD + C.FORECAST_SEED_OFFSET


def predict(seed_col, hour_col) -> F.Column:
    """trunc(seed * hour factor * 100) on doubles."""
    return F.floor(seed_col.cast("double") * X.forecast_hour_factor(hour_col) * F.lit(float(C.FORECAST_SCALE))).cast("int")


def forecast_points(valid: DataFrame) -> DataFrame:
    """One row per (request, hour ahead) with the prediction and 80 % band."""
    lo, hi = C.FORECAST_BAND
    p = (valid.withColumn("_h", F.explode(F.sequence(F.lit(0), F.col("horizon_hours") - 1)))
         .withColumn("ts", F.col("as_of") + F.make_dt_interval(F.lit(0), F.col("_h")))
         .withColumn("predicted_ridership", predict(seed("station_id"), F.hour("ts"))))
    return p.select("station_id", "horizon_hours", "ts", "predicted_ridership",
                    F.floor(F.col("predicted_ridership") * F.lit(lo)).cast("int").alias("pi_lower_80"),
                    F.floor(F.col("predicted_ridership") * F.lit(hi)).cast("int").alias("pi_upper_80"))


def stub_for_hours(station_hours: DataFrame, id_col: str = "station_name") -> DataFrame:
    """The stub prediction for observed (station, hour) rows."""
    return station_hours.withColumn(
        "forecast", predict(seed(X.normalise_id(id_col)), F.hour("tap_hour_utc")))


def forecast_variance(actual: DataFrame) -> DataFrame:
    """Forecast vs actual variance and % per station-hour."""
    v = F.col("total_taps") - F.col("forecast")
    return actual.select("station_id", "tap_hour_utc", "total_taps", "forecast",
                         v.alias("variance"),
                         X.r6(X.safe_div(v, "forecast") * 100).alias("variance_pct"))


def mape(actual_vs_forecast: DataFrame, keys=("station_id",)) -> DataFrame:
    """Mean absolute percentage error (R3); hours with zero actuals skipped."""
    ape = F.abs(F.col("total_taps") - F.col("forecast")) / F.nullif(F.col("total_taps"), F.lit(0)).cast("double")
    return actual_vs_forecast.groupBy(*keys).agg(F.count(F.lit(1)).alias("hours"),
                                                 X.r6(F.avg(ape) * 100).alias("mape_pct"))


def uplift_attribution(static: DataFrame, hits: DataFrame, calendar: DataFrame) -> DataFrame:
    """Observed vs counterfactual riders per event with a 95 % interval.

    counterfactual = sum of the event stations' seasonal baselines, scaled by
    donor observed / donor baseline, donors being the other stations in the
    same hours; interval = ratio +- 1.96 * sqrt(sum sd^2) / counterfactual."""
    ev_hours = hits.select("event_id", "tap_hour_utc").distinct()
    cols = static.select("station_id", "tap_hour_utc", "unique_riders", "baseline_riders", "baseline_riders_sd")
    # all stations of an hour once; an event's own stations are taken off that, so no donor row is copied
    hours = cols.groupBy("tap_hour_utc").agg(F.sum("unique_riders").alias("_riders"),
                                             F.sum("baseline_riders").alias("_bases"))
    everyone = (ev_hours.join(hours, "tap_hour_utc").groupBy("event_id")
                .agg(F.sum("_riders").alias("_all_obs"), F.sum("_bases").alias("_all_base")))
    own = (ev_hours.join(calendar.select("event_id", F.explode("station_ids").alias("station_id")), "event_id")
           .distinct().join(cols, ["station_id", "tap_hour_utc"]).groupBy("event_id")
           .agg(F.sum("unique_riders").alias("observed"), F.sum("baseline_riders").alias("_base"),
                F.sum(F.pow("baseline_riders_sd", 2)).alias("_var")))
    a = (everyone.join(own, "event_id", "left")
         .withColumn("_donor_obs", F.col("_all_obs") - F.coalesce("observed", F.lit(0)))
         .withColumn("_donor_base", F.col("_all_base") - F.coalesce("_base", F.lit(0.0))))
    cf = F.col("_base") * F.try_divide(F.col("_donor_obs").cast("double"), F.nullif(F.col("_donor_base"), F.lit(0.0)))
    a = a.withColumn("_cf", cf).withColumn("_ratio", F.try_divide(F.col("observed").cast("double"),
                                                                   F.nullif(F.col("_cf"), F.lit(0.0))))
    half = F.lit(1.96) * F.sqrt("_var") / F.nullif(F.col("_cf"), F.lit(0.0))
    return a.select("event_id", F.col("observed").cast("bigint").alias("observed"),
                    X.r6("_cf").alias("counterfactual"), X.r6("_ratio").alias("uplift_ratio"),
                    X.r6(F.col("_ratio") - half).alias("ci_lower"), X.r6(F.col("_ratio") + half).alias("ci_upper"))


def forecast_with_drivers(trailing: DataFrame, hits: DataFrame) -> DataFrame:
    """Event-aware forecast (R4): trailing seasonal baseline x product of the
    active event multipliers, with the drivers kept as a struct."""
    mult = hits.groupBy("station_id", "tap_hour_utc").agg(
        F.exp(F.sum(F.log("uplift_multiplier"))).alias("_m"))
    base = trailing.select("station_id", "tap_hour_utc", "unique_riders", "baseline_riders").dropDuplicates(
        ["station_id", "tap_hour_utc"])
    j = base.join(mult, ["station_id", "tap_hour_utc"], "inner")
    pred = F.col("baseline_riders") * F.col("_m")
    return j.select("station_id", "tap_hour_utc", "unique_riders",
                    X.r6(pred).alias("predicted_riders"),
                    F.struct(X.r6("baseline_riders").alias("baseline"),
                             X.r6("_m").alias("event_uplift")).alias("drivers"))


# --- rolling-origin backtest (R3, R4, M11) ----------------------------------------------
#: Weeks of the seasonal mean, months of residuals behind an interval, its share of the days.
SEASON_WEEKS, RESIDUAL_MONTHS, LEAST_WEEKS, LEAST_RESIDUALS = 8, 12, 4, 60


def seasonal_forecast(daily: DataFrame, value: str = "taps", weeks: int = SEASON_WEEKS) -> DataFrame:
    """(station_id, service_date, actual, forecast): the mean of the same weekday
    in the ``weeks`` weeks before, known before the day begins.  Days without a
    row count as zero between a station's first and last day; a group of the
    window holds one row per week."""
    span = daily.groupBy("station_id").agg(F.min("service_date").alias("_a"), F.max("service_date").alias("_b"))
    days = span.select("station_id", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias("service_date"))
    dense = (days.join(daily.select("station_id", "service_date", F.col(value).alias("_v")),
                       ["station_id", "service_date"], "left")
             .select("station_id", "service_date", F.coalesce("_v", F.lit(0)).cast("double").alias("actual")))
    w = (Window.partitionBy("station_id", F.dayofweek("service_date")).orderBy(F.unix_date("service_date"))
         .rangeBetween(-7 * weeks, -1))
    return (dense.withColumn("forecast", F.avg("actual").over(w)).withColumn("_n", F.count("actual").over(w))
            .where(F.col("_n") >= LEAST_WEEKS).drop("_n"))


def backtest(daily: DataFrame, value: str = "taps", share: float = 0.8, months: int = RESIDUAL_MONTHS) -> DataFrame:
    """Forecasts with intervals as they would have been made (rolling origin):
    the bounds of a month are the forecast plus quantiles of the station's
    residuals in the ``months`` months before it.  Every residual is dealt to the
    months that may use it, so the quantiles are one grouped aggregate over
    groups of at most a year of days."""
    f = seasonal_forecast(daily, value).withColumn("month", F.trunc("service_date", "month"))
    residual = F.col("actual") - F.col("forecast")
    later = F.explode(F.sequence(F.add_months("month", 1), F.add_months("month", months), F.expr("INTERVAL 1 MONTH")))
    tail = (1 - share) / 2
    bounds = (f.select("station_id", later.alias("month"), residual.alias("_r")).groupBy("station_id", "month")
              .agg(F.percentile("_r", F.array(F.lit(tail), F.lit(1 - tail))).alias("_q"), F.count("*").alias("_n"))
              .where(F.col("_n") >= LEAST_RESIDUALS))
    return f.join(bounds, ["station_id", "month"]).select(
        "station_id", "service_date", "month", "actual", "forecast",
        (F.col("forecast") + F.col("_q")[0]).alias("lower"), (F.col("forecast") + F.col("_q")[1]).alias("upper"))


def backtest_summary(tested: DataFrame) -> DataFrame:
    """Per station: days, MAPE over days with traffic (R3), bias and the share of days inside the interval."""
    a, p = F.col("actual"), F.col("forecast")
    inside = (a >= F.col("lower")) & (a <= F.col("upper"))
    return tested.groupBy("station_id").agg(
        F.count("*").alias("days"), X.r6(F.avg(F.abs(a - p) / F.nullif(a, F.lit(0.0))) * 100).alias("mape_pct"),
        X.r6(F.avg(p - a)).alias("bias"), X.r6(F.avg(inside.cast("double"))).alias("covered"))


def interval_variance(tested: DataFrame) -> DataFrame:
    """Actual against forecast with its interval."""
    v = F.col("actual") - F.col("forecast")
    return tested.select("station_id", "service_date", "actual", X.r6("forecast").alias("forecast"),
                         X.r6("lower").alias("lower"), X.r6("upper").alias("upper"), X.r6(v).alias("variance"),
                         X.r6(X.safe_div(v, "forecast") * 100).alias("variance_pct"),
                         ((F.col("actual") >= F.col("lower")) & (F.col("actual") <= F.col("upper"))).alias("inside"))
