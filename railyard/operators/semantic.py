"""Semantic layer: measures, time intelligence and slice roll-ups.

Measures are aggregate ``Column`` builders keyed by name (M13), so any slice
is one ``groupBy(...).agg(measure)``.  Time intelligence runs on *daily*
aggregates: a running-total window partitioned by (year, month) holds at most
31 rows, and prior-year lookups are equi-joins on a shifted date key, so no
window group or join key grows with tap volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X


# --- measures (M1, M2, M5, M6, M7, M10, M13) --------------------------------------
def measures() -> dict[str, Column]:
    """Measure name -> aggregate over hourly fact rows joined with revenue."""
    return {
        "ridership": F.sum("unique_riders"),                      # M1 (hourly distincts summed, D5)
        "daily_taps": F.sum("total_taps"),                        # M2
        "fare_revenue": X.money_out(F.sum(X.money("total_fare_cad"))),  # M6
        "active_hours": F.countDistinct("tap_hour_utc"),          # M10
    }


def peak_hour_share(fact: DataFrame, keys=("station_id",)) -> DataFrame:
    h = X.hour_of_day("tap_hour_utc")
    return fact.groupBy(*keys).agg(
        X.r6(X.safe_div(F.sum(F.when(h.isin(*C.PEAK_HOURS), F.col("total_taps")).otherwise(0)),
                        F.sum("total_taps"))).alias("peak_hour_share"))


def revenue_per_tap(revenue: DataFrame, keys=("station_id",)) -> DataFrame:
    """M7 and the average-fare measure of M13: ratios of sums, not means of
    ratios."""
    return revenue.groupBy(*keys).agg(
        X.money_out(F.sum(X.money("gross_fare_revenue_cad"))).alias("fare_revenue"),
        F.sum("paid_tap_count").alias("paid_taps"),
        F.sum("paying_riders").alias("paying_rider_hours"),
        X.r6(X.safe_div(F.sum(X.money("gross_fare_revenue_cad")), F.sum("paid_tap_count"))).alias("revenue_per_tap"),
        X.r6(X.safe_div(F.sum(X.money("gross_fare_revenue_cad")), F.sum("paying_riders"))).alias("revenue_per_rider"))


# --- slice roll-ups (A17, A18) ---------------------------------------------------------
def slice_rollup(revenue: DataFrame, dims=("line_id", "station_id", "fare_class")) -> DataFrame:
    return revenue.rollup(*dims).agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        X.money_out(F.sum(X.money("gross_fare_revenue_cad"))).alias("fare_revenue"),
        F.sum("paid_tap_count").alias("paid_taps"))


def slice_cube(revenue: DataFrame, dims=("line_id", "fare_class")) -> DataFrame:
    return revenue.cube(*dims).agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        X.money_out(F.sum(X.money("gross_fare_revenue_cad"))).alias("fare_revenue"),
        F.sum("paid_tap_count").alias("paid_taps"))


GRAINS = ("hour", "day", "week", "month", "quarter")


def grain_rollup(fact: DataFrame, grains=GRAINS) -> DataFrame:
    """Totals at several time grains in one pass: each row is expanded to one
    (grain, period) per grain, then a single aggregation (as GROUPING SETS)."""
    g = F.explode(F.array(*[F.struct(F.lit(x).alias("grain"), F.date_trunc(x, "tap_hour_utc").alias("period_start"))
                            for x in grains])).alias("_g")
    return (fact.select(g, "total_taps", "unique_riders", "total_fare_cad")
            .select("_g.grain", "_g.period_start", "total_taps", "unique_riders", "total_fare_cad")
            .groupBy("grain", "period_start")
            .agg(F.sum("total_taps").alias("total_taps"),
                 F.sum("unique_riders").alias("ridership"),
                 X.money_out(F.sum(X.money("total_fare_cad"))).alias("total_fare_cad")))


# --- top-N and shares (O4, A20, A21) ----------------------------------------------------
def top_stations(fact: DataFrame, n: int = 3, by: str = "line_id") -> DataFrame:
    """Busiest ``n`` stations per line by tap volume (ties: smaller id)."""
    per = fact.groupBy(by, "station_id").agg(F.sum("total_taps").alias("taps"))
    w = Window.partitionBy(by).orderBy(F.desc("taps"), "station_id")  # one row per station
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def fare_table(spark) -> DataFrame:
    """The 5-row fare-by-class lookup."""
    return spark.createDataFrame(list(C.FARE_BY_CLASS), "fare_class string, list_fare_cad double")


def fare_mix(silver: DataFrame) -> DataFrame:
    """Observed fare-class share against the expected distribution (A21),
    with the class's list fare (F17) next to the observed average fare."""
    spark = silver.sparkSession
    expected = spark.createDataFrame(list(C.FARE_CLASS_DISTRIBUTION), "fare_class string, expected_share double")
    per = silver.groupBy("fare_class").agg(F.count(F.lit(1)).alias("taps"),
                                           F.sum(X.money("fare_amount_cad")).alias("_fare"))
    obs = per.select("fare_class", "taps", "_fare",
                     (F.col("taps") / F.sum("taps").over(Window.partitionBy())).alias("observed_share"))  # 5 rows
    j = (obs.join(expected, "fare_class", "full")
            .join(fare_table(spark), "fare_class", "left"))        # 5-row inline tables
    return j.select("fare_class", F.coalesce("taps", F.lit(0)).cast("bigint").alias("taps"),
                    X.r6(F.coalesce("observed_share", F.lit(0.0))).alias("observed_share"),
                    X.r6("expected_share").alias("expected_share"),
                    X.r6(F.coalesce("observed_share", F.lit(0.0)) - F.col("expected_share")).alias("share_gap"),
                    F.col("list_fare_cad"),
                    X.r6(X.safe_div("_fare", "taps")).alias("avg_fare_cad"))


# --- time intelligence on daily aggregates (W4, W5, W6, M3, M4, M12) --------------
def daily_totals(daily_rows: DataFrame) -> DataFrame:
    """Binding B rows -> one row per service date."""
    return daily_rows.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("taps"),
        F.sum("fare_amount_cad").alias("revenue"),
        F.countDistinct("card_token").alias("riders"))


def to_date_running(daily: DataFrame, value: str) -> DataFrame:
    """Month-, quarter- and year-to-date running sums."""
    d = F.col("service_date")
    out = daily.withColumn("_y", F.year(d)).withColumn("_q", F.quarter(d)).withColumn("_m", F.month(d))
    run = (Window.unboundedPreceding, Window.currentRow)
    w_m = Window.partitionBy("_y", "_m").orderBy(d).rowsBetween(*run)
    w_q = Window.partitionBy("_y", "_q").orderBy(d).rowsBetween(*run)
    w_y = Window.partitionBy("_y").orderBy(d).rowsBetween(*run)   # at most 366 rows
    def fmt(c):
        return F.round(c.cast("double"), 2)
    return out.select("service_date", fmt(F.col(value)).alias("value"),
                      fmt(F.sum(value).over(w_m)).alias("mtd"),
                      fmt(F.sum(value).over(w_q)).alias("qtd"),
                      fmt(F.sum(value).over(w_y)).alias("ytd"))


def prior_year(daily: DataFrame, value: str) -> DataFrame:
    """Value one year earlier by an equi-join on ``add_months(date, -12)``
    (one prior row per current row, also around 29 February) (W5, M3)."""
    cur = daily.select("service_date", F.col(value).alias("value"),
                       F.add_months("service_date", -12).alias("_prior_date"))
    prev = daily.select(F.col("service_date").alias("_prior_date"), F.col(value).alias("prior_year_value"))
    j = cur.join(prev, "_prior_date", "left")
    return j.select("service_date", F.round(F.col("value").cast("double"), 2).alias("value"),
                    F.round(F.col("prior_year_value").cast("double"), 2).alias("prior_year_value"),
                    X.r6(F.try_divide((F.col("value") - F.col("prior_year_value")).cast("double"),
                                      F.nullif(F.col("prior_year_value"), F.lit(0)).cast("double")) * 100)
                    .alias("yoy_pct"))


def prior_period(daily: DataFrame, value: str) -> DataFrame:
    """Monthly totals on a gap-free month spine, with the previous month and
    the % change (W6).  The spine covers min..max month of the data."""
    m = daily.groupBy(F.trunc("service_date", "month").alias("month_start")).agg(F.sum(value).alias("value"))
    spine = m.agg(F.min("month_start").alias("a"), F.max("month_start").alias("b")) \
             .select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    s = spine.join(m, "month_start", "left").withColumn("value", F.coalesce("value", F.lit(0)))
    w = Window.orderBy("month_start")  # one row per month: small, single partition is fine
    s = s.withColumn("prior_value", F.lag("value").over(w))
    return s.select("month_start", F.round(F.col("value").cast("double"), 2).alias("value"),
                    F.round(F.col("prior_value").cast("double"), 2).alias("prior_value"),
                    X.r6(F.try_divide((F.col("value") - F.col("prior_value")).cast("double"),
                                      F.nullif(F.col("prior_value"), F.lit(0)).cast("double")) * 100)
                    .alias("pct_change"))


def measure_variants(daily: DataFrame, measure_cols) -> DataFrame:
    """Any daily measures -> long (service_date, measure, variant, value) with
    the eight variants current / mtd / qtd / ytd / prior_year / pct_yoy /
    prior_period / pct_prior_period (M12); the prior period of a day is the same
    day one month earlier.  All measures share the windows and the joins."""
    long = daily.select("service_date", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(28,2)").alias("v")) for m in measure_cols])))
    d = F.col("service_date")
    run = (Window.unboundedPreceding, Window.currentRow)

    def to_date(*keys):
        return F.sum("v").over(Window.partitionBy("measure", *keys).orderBy(d).rowsBetween(*run)).cast("double")

    r = long.select("service_date", "measure", F.col("v").cast("double").alias("current"),
                    to_date(F.year(d), F.month(d)).alias("mtd"), to_date(F.year(d), F.quarter(d)).alias("qtd"),
                    to_date(F.year(d)).alias("ytd"), F.add_months(d, -12).alias("_year"),
                    F.add_months(d, -1).alias("_month"))

    def before(name, key):
        return long.select("measure", d.alias(key), F.col("v").cast("double").alias(name))

    j = (r.join(before("prior_year", "_year"), ["measure", "_year"], "left")
         .join(before("prior_period", "_month"), ["measure", "_month"], "left"))
    for pct, base in (("pct_yoy", "prior_year"), ("pct_prior_period", "prior_period")):
        j = j.withColumn(pct, (F.col("current") - F.col(base)) / F.nullif(F.col(base), F.lit(0.0)) * 100)
    names = ("current", "mtd", "qtd", "ytd", "prior_year", "pct_yoy", "prior_period", "pct_prior_period")
    return (j.select("service_date", "measure", F.inline(F.array(*[
        F.struct(F.lit(n).alias("variant"), F.round(n, 2).alias("value")) for n in names]))))


# --- event-day uplift measures (M8, M9) ----------------------------------------------
def event_day_uplift_pct(fact: DataFrame, uplift: DataFrame, event_days: DataFrame) -> DataFrame:
    """M8: mean event-day daily taps over mean non-event-day daily taps, minus
    1, in %; M9: mean uplift multiplier x 100.  Per station."""
    daily = (fact.withColumn("service_date", F.to_date("tap_hour_utc"))
             .groupBy("station_id", "service_date").agg(F.sum("total_taps").alias("_t"))
             .join(event_days, "service_date", "left")
             .withColumn("is_event_day", F.coalesce("is_event_day", F.lit(False))))
    m8 = daily.groupBy("station_id").agg(
        F.avg(F.when(F.col("is_event_day"), F.col("_t"))).alias("_e"),
        F.avg(F.when(~F.col("is_event_day"), F.col("_t"))).alias("_n"))
    m9 = uplift.groupBy("station_id").agg(X.r6(F.avg("uplift_multiplier") * 100).alias("uplift_multiplier_pct"))
    return m8.join(m9, "station_id", "left").select(
        "station_id",
        X.r6((F.try_divide(F.col("_e"), F.nullif(F.col("_n"), F.lit(0.0))) - 1) * 100).alias("event_day_uplift_pct"),
        "uplift_multiplier_pct")
