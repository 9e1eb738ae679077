"""Gold facts: hourly ridership, hourly fare revenue, hourly pre-aggregate,
daily distinct riders.

All are single hash aggregations.  Exact distinct counts are planned by
Catalyst as a two-level aggregate (keys + card, then keys), each with a
map-side partial step, so a busy station-hour is spread over card hashes
before its final merge.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions import columns as X

RIDERSHIP_KEYS = ("date_key", "tap_hour_utc", "station_id", "line_id", "zone")
REVENUE_KEYS = RIDERSHIP_KEYS + ("fare_class",)


def fact_ridership_hourly(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy(*RIDERSHIP_KEYS).agg(
        F.sum(F.when(F.col("tap_type") == "TAP_ON", 1).otherwise(0)).cast("bigint").alias("tap_on_count"),
        F.sum(F.when(F.col("tap_type") == "TAP_OFF", 1).otherwise(0)).cast("bigint").alias("tap_off_count"),
        F.count(F.lit(1)).alias("total_taps"),
        F.countDistinct("card_token").alias("unique_riders"),
        F.sum(X.money("fare_amount_cad")).alias("_fare"),
    )
    return agg.select(
        *RIDERSHIP_KEYS, "tap_on_count", "tap_off_count", "total_taps", "unique_riders",
        X.money_out("_fare").alias("total_fare_cad"),
        X.r6(X.zero_guard_ratio("total_taps", "unique_riders")).alias("taps_per_rider"),
    )


def fact_fare_revenue(silver: DataFrame) -> DataFrame:
    """Revenue is recognised on tap-on only."""
    agg = (silver.filter(F.col("tap_type") == "TAP_ON")
           .groupBy(*REVENUE_KEYS)
           .agg(F.sum(X.money("fare_amount_cad")).alias("_rev"),
                F.count(F.lit(1)).alias("paid_tap_count"),
                F.countDistinct("card_token").alias("paying_riders")))
    return agg.select(
        *REVENUE_KEYS,
        X.money_out("_rev").alias("gross_fare_revenue_cad"),
        "paid_tap_count", "paying_riders",
        X.r6(X.safe_div("_rev", "paid_tap_count")).alias("avg_fare_per_tap_cad"),
        X.r6(X.safe_div("_rev", "paying_riders")).alias("revenue_per_rider_cad"),
    )


def hourly_preagg(silver: DataFrame, with_approx: bool = True) -> DataFrame:
    """Four-key hourly pre-aggregate (A14).  The HLL column is not exact and
    is left out of oracle-checked outputs (``with_approx=False``)."""
    aggs = [F.count(F.lit(1)).alias("tap_count"),
            X.money_out(F.sum(X.money("fare_amount_cad"))).alias("revenue_cad")]
    if with_approx:
        aggs.append(F.approx_count_distinct("card_token", 0.05).alias("unique_riders_approx"))
    return silver.groupBy("tap_hour_utc", "station_id", "fare_class", "tap_type").agg(*aggs)


def rider_sketches(silver: DataFrame) -> DataFrame:
    """Mergeable distinct-rider sketches per hour and station (A8): they can be
    stored with the hourly fact and rolled up without the taps."""
    return silver.groupBy("tap_hour_utc", "station_id").agg(
        F.count(F.lit(1)).alias("tap_count"), F.hll_sketch_agg("card_token", F.lit(14)).alias("riders_sketch"))


def merge_sketches(sketches: DataFrame, *keys) -> DataFrame:
    """Distinct riders of coarser groups from stored sketches."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("riders_sketch")).alias("unique_riders_approx"))


#: Slices of a sketch table; None: all riders together.
SLICES = ("station_id", "line_id", "zone", None)


def slice_sketches(taps: DataFrame, hour=None, keys=("station_id", "line_id", "zone")) -> DataFrame:
    """Taps and rider sketches per hour and slice: the table from which riders
    at any coarser grain follow without the taps (A8, A17, A18)."""
    hour = F.col("tap_hour_utc") if hour is None else hour
    return taps.groupBy(hour.alias("tap_hour_utc"), *keys).agg(
        F.count(F.lit(1)).alias("taps"), F.hll_sketch_agg("card_token", F.lit(14)).alias("riders_sketch"))


def union_sketches(sketches: DataFrame, *keys) -> DataFrame:
    """Sketches of coarser groups; ``keys`` are names or columns."""
    return sketches.groupBy(*keys).agg(F.sum("taps").alias("taps"),
                                       F.hll_union_agg("riders_sketch").alias("riders_sketch"))


def _cells(grains, slices):
    """One struct per grain and slice that a row belongs to."""
    return F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "tap_hour_utc").alias("period_start"),
                 F.lit(s or "all").alias("slice"), (F.col(s).cast("string") if s else F.lit("all")).alias("slice_value"))
        for g in grains for s in slices]))


def _sliced(sketches: DataFrame, grains, slices) -> DataFrame:
    cells = sketches.select(_cells(grains, slices).alias("_c"), "taps", "riders_sketch").select("_c.*", "taps", "riders_sketch")
    return union_sketches(cells, "grain", "period_start", "slice", "slice_value")


#: Grains of rider counts.
RIDER_GRAINS = ("hour", "day", "week", "month", "quarter")
#: Taps of one task while exact riders are counted: each gives a row per grain and slice.
TAPS_PER_TASK = 50_000


def riders_at_any_grain(sketches: DataFrame, grains=RIDER_GRAINS, slices=SLICES) -> DataFrame:
    """(grain, period_start, slice, slice_value, taps, unique_riders_approx)
    from stored hourly sketches alone, weeks beginning on Monday.  Hours are
    united to days first, and only days are dealt to the coarser grains, so a
    stored sketch is copied once per slice and not once per grain and slice."""
    known = [s for s in slices if s]
    days = union_sketches(sketches, F.date_trunc("day", "tap_hour_utc").alias("tap_hour_utc"), *known)
    parts = [_sliced(sketches, ["hour"], slices)] if "hour" in grains else []
    parts.append(_sliced(days, [g for g in grains if g != "hour"], slices))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("grain", "period_start", "slice", "slice_value", "taps",
                      F.hll_sketch_estimate("riders_sketch").alias("unique_riders_approx"))


def exact_riders_at_any_grain(taps: DataFrame, grains=RIDER_GRAINS, slices=SLICES) -> DataFrame:
    """(grain, period_start, slice, slice_value, riders): exact distinct riders
    from the taps.  Riders are dealt to tasks of a bounded size, so all cells of
    a rider meet in one task: repeats go there, and only counts are exchanged.
    A rider's taps at one station and hour count once beforehand, which bounds
    the rows of any one rider."""
    known = [s for s in slices if s]
    once = taps.select("tap_hour_utc", *known, "card_token").distinct()
    tasks = max(1, math.ceil(taps.count() / TAPS_PER_TASK))
    cells = once.repartition(tasks, "card_token").select(_cells(grains, slices).alias("_c"), "card_token")
    return (cells.select("_c.*", "card_token").groupBy("grain", "period_start", "slice", "slice_value")
            .agg(F.countDistinct("card_token").alias("riders")))


def distinct_riders_daily(silver: DataFrame) -> DataFrame:
    """Additive-safe daily distinct riders per station."""
    return (silver.withColumn("service_date", F.to_date("tap_hour_utc"))
            .groupBy("station_id", "service_date")
            .agg(F.countDistinct("card_token").alias("distinct_riders_daily"),
                 F.count(F.lit(1)).alias("total_taps")))
