"""Core chain: bronze -> silver -> gold facts -> marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.operators import gold, marts, silver
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.sources import binding as B
from railyard.sources import bronze as BR


def silver_of(spark, sf_dir):
    return silver.build_silver(B.bronze_taps(spark, sf_dir), B.stations(spark, sf_dir))


def facts_of(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    return gold.fact_ridership_hourly(s), gold.fact_fare_revenue(s)


_BRONZE_COLS = ("tap_id, card_token, station_id, zone, fare_class, CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad, "
                "tap_type, tap_timestamp_utc, device_id, schema_version, ingest_timestamp_utc")


@register("bronze_passthrough", compose("bronze", f"SELECT {_BRONZE_COLS} FROM bronze"), "S11 P1 P10")
def q_bronze_passthrough(spark, sf_dir):
    b = B.bronze_taps(spark, sf_dir)
    return BR.bronze_view(b).withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("bronze_json_decode", compose("bronze", f"SELECT {_BRONZE_COLS} FROM bronze"), "S6 S7 F24")
def q_bronze_json_decode(spark, sf_dir):
    """Taps encoded as JSON wire messages and decoded back (ingest stamp is a
    clock column and left out)."""
    msgs = BR.encode_messages(B.bronze_taps(spark, sf_dir))
    d = BR.decode_messages(msgs).drop("_ingest_ts")
    return d.select(*B.BRONZE_COLUMNS).withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("bronze_rescue", compose("bronze", BR.RESCUE_ORACLE), "S4 Q16")
def q_bronze_rescue(spark, sf_dir):
    msgs = BR.drifted_messages(B.bronze_taps(spark, sf_dir, with_k=True))
    r = BR.decode_with_rescue(msgs)
    return BR.rescue_summary(r)


@register("bronze_partition_layout", compose("bronze", """
SELECT strftime(tap_timestamp_utc, '%Y-%m-%d') AS dt, CAST(strftime(tap_timestamp_utc, '%H') AS INTEGER) AS hour,
       COUNT(*) AS rows, COUNT(DISTINCT tap_id) AS taps
FROM bronze GROUP BY 1, 2"""), "S8 S12 S18 F23 D13")
def q_bronze_partition_layout(spark, sf_dir):
    path = BR.write_bronze(B.bronze_taps(spark, sf_dir))
    back = BR.read_bronze(spark, path)
    return back.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("rows"),
                                         F.countDistinct("tap_id").alias("taps"))


@register("silver_dedup", compose("dedup", f"SELECT {_BRONZE_COLS} FROM dedup"), "W1 O1 P3")
def q_silver_dedup(spark, sf_dir):
    kept, _ = silver.split(B.bronze_taps(spark, sf_dir), B.stations(spark, sf_dir))
    d = silver.latest_per_key(kept)
    return d.select(*B.BRONZE_COLUMNS).withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("silver_conformed", compose("silver", """
SELECT * REPLACE (CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad) FROM silver"""), "J1 F1 F2 P4 P5 Q7")
def q_silver_conformed(spark, sf_dir):
    return silver_of(spark, sf_dir).withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("silver_quarantine", compose("tagged_dq", """
SELECT tap_id, station_id, tap_type, ingest_timestamp_utc, array_to_string(reasons, ',') AS reasons
FROM tagged_dq WHERE len(reasons) > 0"""), "Q6 Q8 D12")
def q_silver_quarantine(spark, sf_dir):
    return silver.quarantine(B.bronze_taps(spark, sf_dir, with_violations=True), B.stations(spark, sf_dir))


@register("fact_ridership_hourly", compose("fact_rh", "SELECT * FROM fact_rh"), "A1 A3 A5 A6 A9 F13")
def q_fact_ridership_hourly(spark, sf_dir):
    return gold.fact_ridership_hourly(silver_of(spark, sf_dir))


@register("fact_fare_revenue", compose("fact_fr", "SELECT * FROM fact_fr"), "A2 A5 A6 A9 A10 P2")
def q_fact_fare_revenue(spark, sf_dir):
    return gold.fact_fare_revenue(silver_of(spark, sf_dir))


@register("hourly_preagg", compose("silver", """
SELECT tap_hour_utc, station_id, fare_class, tap_type, COUNT(*) AS tap_count,
       ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE), 2) AS revenue_cad
FROM silver GROUP BY 1, 2, 3, 4"""), "A14")
def q_hourly_preagg(spark, sf_dir):
    return gold.hourly_preagg(silver_of(spark, sf_dir), with_approx=False)


@register("hourly_preagg_approx", compose("silver", """
SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date, COUNT(DISTINCT card_token) AS riders, TRUE AS within_bound
FROM silver GROUP BY 1, 2"""), "A8 A14")
def q_hourly_preagg_approx(spark, sf_dir):
    """Hourly rider sketches merged to days: each estimate lies within 5 % (or
    one rider) of the exact count."""
    s = silver_of(spark, sf_dir)
    est = gold.merge_sketches(gold.rider_sketches(s).withColumn("service_date", F.to_date("tap_hour_utc")),
                              "station_id", "service_date")
    exact = gold.distinct_riders_daily(s).select("station_id", "service_date",
                                                 F.col("distinct_riders_daily").alias("riders"))
    near = F.abs(F.col("unique_riders_approx") - F.col("riders")) <= F.greatest(F.lit(1.0), F.col("riders") * 0.05)
    return (exact.join(est, ["station_id", "service_date"])
            .select("station_id", "service_date", "riders", near.alias("within_bound")))


@register("distinct_riders_daily", compose("silver", """
SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date,
       COUNT(DISTINCT card_token) AS distinct_riders_daily, COUNT(*) AS total_taps
FROM silver GROUP BY 1, 2"""), "A6 D5")
def q_distinct_riders_daily(spark, sf_dir):
    return gold.distinct_riders_daily(silver_of(spark, sf_dir))


@register("uplift_static", compose("uplift_static", "SELECT * FROM uplift_static"), "W2 J3 J5 A11 F3 F4 F20 P11")
def q_uplift_static(spark, sf_dir):
    fact, _ = facts_of(spark, sf_dir)
    return marts.uplift_static(fact)


@register("uplift_trailing", compose("uplift_trailing", "SELECT * FROM uplift_trailing"), "W3 J6 N7 D3")
def q_uplift_trailing(spark, sf_dir):
    fact, _ = facts_of(spark, sf_dir)
    return marts.uplift_trailing(fact, B.event_calendar(spark))


@register("station_kpis", compose("station_kpis", "SELECT * FROM station_kpis"), "A4 A7 A12 J4 P7 F9 F12 F19 D1 D2")
def q_station_kpis(spark, sf_dir):
    r, v = facts_of(spark, sf_dir)
    return marts.station_kpis(r, v)


@register("line_performance", compose("fact_rh", "fact_fr", "lines", """
SELECT r.line_id, l.line_name, r.service_date, r.total_taps, r.tap_on_count, r.rider_hours, r.active_stations,
       ROUND(CAST(coalesce(v.rev, 0) AS DOUBLE), 2) AS gross_fare_revenue_cad,
       CAST(coalesce(v.paid_tap_count, 0) AS BIGINT) AS paid_tap_count,
       ROUND(CAST(v.rev AS DOUBLE) / NULLIF(v.paid_tap_count, 0), 6) AS avg_fare_per_tap_cad
FROM (SELECT line_id, CAST(tap_hour_utc AS DATE) AS service_date,
             CAST(SUM(total_taps) AS BIGINT) AS total_taps, CAST(SUM(tap_on_count) AS BIGINT) AS tap_on_count,
             CAST(SUM(unique_riders) AS BIGINT) AS rider_hours, COUNT(DISTINCT station_id) AS active_stations
      FROM fact_rh GROUP BY 1, 2) r
LEFT JOIN (SELECT line_id, CAST(tap_hour_utc AS DATE) AS service_date,
                  SUM(CAST(gross_fare_revenue_cad AS DECIMAL(18,2))) AS rev,
                  SUM(paid_tap_count) AS paid_tap_count
           FROM fact_fr GROUP BY 1, 2) v USING (line_id, service_date)
LEFT JOIN lines l USING (line_id)"""), "A19 J10")
def q_line_performance(spark, sf_dir):
    r, v = facts_of(spark, sf_dir)
    return marts.line_performance(r, v, B.lines(spark, sf_dir))
