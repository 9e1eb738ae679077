"""Pipeline health metrics.

The lag percentile is exact without holding a bin's rows in one buffer:
lags (whole seconds) are first counted per (bin, lag) - a map-side combined
aggregate whose size is bounded by the distinct lags of a bin - and the
interpolated percentile is read off the cumulative counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X


def lag_seconds(event_ts: str, ingest_ts: str):
    return F.floor((F.unix_micros(F.col(ingest_ts)) - F.unix_micros(F.col(event_ts))) / F.lit(1_000_000)).cast("bigint")


def lag_percentile(df: DataFrame, q: float = 0.95, bin_minutes: int = 5,
                   event_ts: str = "tap_timestamp_utc", ingest_ts: str = "ingest_timestamp_utc",
                   alert_seconds: int = C.LAG_ALERT_SECONDS) -> DataFrame:
    """Per ``bin_minutes`` bin of arrival time: rows and the linearly
    interpolated ``q`` quantile of arrival lag (SQL ``percentile_cont``)."""
    b = F.window(ingest_ts, f"{bin_minutes} minutes").start.alias("bin_start")
    hist = df.select(b, lag_seconds(event_ts, ingest_ts).alias("lag")).groupBy("bin_start", "lag").count()
    w = Window.partitionBy("bin_start").orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.withColumn("_cum", F.sum("count").over(w)) \
            .withColumn("_n", F.sum("count").over(Window.partitionBy("bin_start")))
    pos = F.lit(q) * (F.col("_n") - 1)
    h = h.withColumn("_lo", F.floor(pos)).withColumn("_hi", F.ceil(pos)).withColumn("_frac", pos - F.floor(pos))
    per = h.groupBy("bin_start").agg(
        F.first("_n").alias("taps"), F.first("_frac").alias("_frac"),
        F.min(F.when(F.col("_cum") > F.col("_lo"), F.col("lag"))).alias("_vlo"),
        F.min(F.when(F.col("_cum") > F.col("_hi"), F.col("lag"))).alias("_vhi"))
    p = F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))
    return per.select("bin_start", F.col("taps").cast("bigint").alias("taps"),
                      X.r6(p).alias("p95_lag_seconds"), (p > alert_seconds).alias("lag_alert"))


#: Size of a lag sketch, and the largest rank error of its quantiles (twice the 99 % error of that size).
LAG_K = 200
LAG_RANK_ERROR = 2 * 2.296 / LAG_K ** 0.9723


def lag_sketches(df: DataFrame, bin_minutes: int = 5, event_ts: str = "tap_timestamp_utc",
                 ingest_ts: str = "ingest_timestamp_utc", k: int = LAG_K) -> DataFrame:
    """(bin_start, taps, lags): a mergeable quantile sketch of the arrival lags
    of each bin, of bounded size whatever the number of taps."""
    b = F.window(ingest_ts, f"{bin_minutes} minutes").start.alias("bin_start")
    return (df.select(b, lag_seconds(event_ts, ingest_ts).alias("lag")).groupBy("bin_start")
            .agg(F.count("lag").alias("taps"), F.kll_sketch_agg_bigint("lag", F.lit(k)).alias("lags")))


def lag_from_sketches(sketches: DataFrame, q: float = 0.95, alert_seconds: int = C.LAG_ALERT_SECONDS) -> DataFrame:
    """Bins with the ``q`` quantile of lag from any number of sketches per bin;
    its rank is off by at most ``LAG_RANK_ERROR``."""
    per = sketches.groupBy("bin_start").agg(F.sum("taps").alias("taps"), F.kll_merge_agg_bigint("lags").alias("lags"))
    p = F.kll_sketch_get_quantile_bigint("lags", F.lit(q))
    return per.where("taps > 0").select("bin_start", "taps", p.alias("lag_seconds"), (p > alert_seconds).alias("lag_alert"))


def rate_per_minute(df: DataFrame, group: str, ts: str = "tap_timestamp_utc") -> DataFrame:
    """Taps per second over 1-minute tumbling windows, per group."""
    return (df.groupBy(F.window(ts, "1 minute").start.alias("minute_start"), group)
            .agg(F.count(F.lit(1)).alias("taps"))
            .withColumn("taps_per_second", X.r6(F.col("taps") / F.lit(60.0))))


def late_rows(df: DataFrame, event_ts: str = "tap_timestamp_utc", arrival_ts: str = "ingest_timestamp_utc",
              delay_hours: int = 2, bin_minutes: int = 60) -> DataFrame:
    """Late-row accounting (T7): a row is late when its event time is behind
    the watermark in force when it arrived - the newest event time of all
    earlier arrival bins minus the allowed delay.  Bins are aggregated
    first, so the running maximum runs over one row per bin."""
    b = F.window(arrival_ts, f"{bin_minutes} minutes").start
    per_bin = df.groupBy(b.alias("arrival_bin")).agg(F.max(event_ts).alias("_mx"))
    w = Window.orderBy("arrival_bin").rowsBetween(Window.unboundedPreceding, -1)   # one row per bin
    marks = per_bin.select("arrival_bin", (F.max("_mx").over(w) - F.expr(f"INTERVAL {delay_hours} HOURS"))
                           .alias("watermark"))
    j = df.select(b.alias("arrival_bin"), F.col(event_ts).alias("_e")).join(marks, "arrival_bin")  # AQE-sized
    late = F.coalesce(F.col("_e") < F.col("watermark"), F.lit(False))
    return (j.groupBy(F.to_date("arrival_bin").alias("arrival_date"))
            .agg(F.count(F.lit(1)).alias("arrivals"), F.count_if(late).alias("late_rows")))
