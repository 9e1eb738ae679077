"""Binding of the driver's test tables to the tap model.

No tap data ships with the test tables, so taps, stations and lines are views
over ``events``, ``nation`` and ``region`` (binding A, hourly taps) and a
daily long history over ``orders``, ``customer`` and ``nation`` (binding B).
The SQL oracle in ``railyard.plans.oracle`` spells the same expressions.

Everything is one scan per source table: re-ingested copies and rule
violations are generated with ``explode`` over a per-row variant array
instead of re-reading the events table once per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import constants as C
from railyard.functions import columns as X
from railyard.sources.tables import read_table

BRONZE_COLUMNS = ("tap_id", "card_token", "station_id", "zone", "fare_class",
                  "fare_amount_cad", "tap_type", "tap_timestamp_utc", "device_id",
                  "schema_version", "ingest_timestamp_utc")


def fare_class_of(event_type) -> F.Column:
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for et, fc in C.EVENT_TYPE_TO_FARE_CLASS:
        expr = F.when(col == et, F.lit(fc)) if expr is None else expr.when(col == et, F.lit(fc))
    return expr


# --- dimensions -----------------------------------------------------------------
def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: nation rows; coordinates derived from the key."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(
        F.col("n_nationkey").alias("station_id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("line_id"),
        F.col("n_regionkey").alias("zone"),
        F.expr("CAST(43 + (n_nationkey % 5) * 0.1 AS DOUBLE)").alias("lat"),
        F.expr("CAST(-79 - (n_nationkey div 5) * 0.1 AS DOUBLE)").alias("lon"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").alias("line_id"), F.col("r_name").alias("line_name"))


# --- binding A: hourly taps -------------------------------------------------------
def bronze_taps(spark: SparkSession, sf_dir: str, with_violations: bool = False,
                with_k: bool = False) -> DataFrame:
    """Bronze tap rows bound from ``events``.

    variant 0: the tap itself; 1: re-ingested copy (k < 10, fare + 1, ingest
    one hour later); 2: bad tap type (k = 99); 3: unknown station (k = 98).
    Variants 2 and 3 are only present ``with_violations``.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k = X.json_int("props", "$.k")
    ev = ev.withColumn("k", k)
    variants = [F.lit(0), F.when(F.col("k") < C.DUPLICATE_K_BELOW, F.lit(1))]
    if with_violations:
        variants += [F.when(F.col("k") == C.VIOLATION_BAD_TAP_TYPE_K, F.lit(2)),
                     F.when(F.col("k") == C.VIOLATION_UNKNOWN_STATION_K, F.lit(3))]
    v = F.col("variant")
    base_station = (F.col("k") % C.N_STATIONS_BOUND).cast("int")
    taps = (ev.withColumn("variant", F.explode(F.array_compact(F.array(*variants))))
            .select(
                F.col("event_id").alias("tap_id"),
                F.col("user_id").alias("card_token"),
                F.when(v == 3, F.lit(C.UNKNOWN_STATION_ID)).otherwise(base_station).alias("station_id"),
                fare_class_of("event_type").alias("fare_class"),
                F.when(v == 1, X.money("value") + F.lit(1)).otherwise(X.money("value"))
                 .cast("decimal(18,2)").alias("fare_amount_cad"),
                F.when(v == 2, F.lit("TAP_X"))
                 .when(F.col("k") % 2 == 0, F.lit("TAP_ON")).otherwise(F.lit("TAP_OFF")).alias("tap_type"),
                F.col("ts").cast("timestamp").alias("tap_timestamp_utc"),
                F.concat(F.lit("reader-"), base_station.cast("string"), F.lit("-"),
                         (F.col("event_id") % 4 + 1).cast("string")).alias("device_id"),
                F.lit("v1").alias("schema_version"),
                F.when(v == 1, F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 HOUR"))
                 .otherwise(F.col("ts").cast("timestamp")).alias("ingest_timestamp_utc"),
                F.col("k"),
            ))
    zones = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    taps = taps.join(zones, taps.station_id == zones.n_nationkey, "left").withColumnRenamed("n_regionkey", "zone")
    cols = list(BRONZE_COLUMNS) + (["k"] if with_k else [])
    return taps.select(*cols)


def faulty_taps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taps with planted faults, one kind per value of k: station ids missing
    (87), odd devices (88), odd schema versions (89), event times missing (90),
    negative fares (91), cards missing (92), tap ids missing (93), besides the
    bad tap types (99) and unknown stations (98)."""
    b = bronze_taps(spark, sf_dir, with_violations=True, with_k=True)
    k = F.col("k")

    def but(n, column, other=None):
        return F.when(k == n, F.lit(None) if other is None else other).otherwise(F.col(column)).alias(column)

    return b.select(but(93, "tap_id"), but(92, "card_token"), but(87, "station_id"), "zone", "fare_class",
                    but(91, "fare_amount_cad", -F.col("fare_amount_cad") - 1).cast("decimal(18,2)").alias("fare_amount_cad"),
                    "tap_type", but(90, "tap_timestamp_utc"), but(88, "device_id", F.concat(F.lit("door-"), F.col("device_id"))),
                    but(89, "schema_version", F.lit("version 2")), "ingest_timestamp_utc")


def faulty_fact(fact: DataFrame) -> DataFrame:
    """The hourly fact with faults at a few stations: rows twice (5), totals
    that do not add up (6), more riders than taps (8), negative counts and
    fares (9), keys missing (10)."""
    st = F.col("station_id")

    def at(n, column, other):
        return F.when(st == n, other).otherwise(F.col(column))

    twice = fact.withColumn("_copies", F.explode(F.when(st == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    change = {"total_taps": F.when(st == 6, F.col("total_taps") + 1).when(st == 9, -F.col("total_taps"))
              .otherwise(F.col("total_taps")),
              "unique_riders": F.when(st == 8, F.col("total_taps") + 1).when(st == 9, F.lit(-1)).otherwise(F.col("unique_riders")),
              "tap_on_count": at(9, "tap_on_count", -F.col("tap_on_count") - 1),
              "tap_off_count": at(9, "tap_off_count", -F.col("tap_off_count") - 1),
              "total_fare_cad": at(9, "total_fare_cad", -F.col("total_fare_cad") - 1),
              "taps_per_rider": at(9, "taps_per_rider", F.lit(-1.0)),
              "date_key": at(10, "date_key", F.lit(None)), "line_id": at(10, "line_id", F.lit(None)),
              "tap_hour_utc": at(10, "tap_hour_utc", F.lit(None)),
              "station_id": F.when(st == 11, F.lit(None)).otherwise(st)}
    return twice.select(*[(change[c] if c in change else F.col(c)).alias(c) for c in fact.columns])


def faulty_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations off the map (3: latitude, 4: longitude) and with a name that is no id (5)."""
    st = stations(spark, sf_dir)
    k = F.col("station_id")
    return (st.withColumn("lat", F.when(k == 3, F.lit(91.5)).otherwise(F.col("lat")))
            .withColumn("lon", F.when(k == 4, F.lit(-200.0)).otherwise(F.col("lon")))
            .withColumn("name", F.when(k == 5, F.lit("no id!")).otherwise(F.col("name"))))


# --- binding B: daily long history ---------------------------------------------------
def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order as a daily 'tap': station = customer nation,
    line = its region, fare class = order priority."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").join(n, F.col("c_nationkey") == n.n_nationkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("tap_id"),
        F.col("o_custkey").alias("card_token"),
        F.col("c_nationkey").alias("station_id"),
        F.col("n_regionkey").alias("line_id"),
        F.col("o_orderpriority").alias("fare_class"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        X.money("o_totalprice").alias("fare_amount_cad"),
    )


def od_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origin-destination trips: each line item travels from its customer's
    station (nation) to its supplier's station.  Plain equi-joins; Spark
    picks shuffle or broadcast per side size (AQE)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey))
    return j.select(F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("destination"))


def orders_as_of() -> F.Column:
    return F.lit(C.ORDERS_AS_OF).cast("date")


# --- small inline tables -----------------------------------------------------------
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("start_ts", T.TimestampType(), False),
    T.StructField("end_ts", T.TimestampType(), False),
    T.StructField("station_ids", T.ArrayType(T.IntegerType()), False),
    T.StructField("uplift_multiplier", T.DoubleType(), False),
])


def event_calendar(spark: SparkSession) -> DataFrame:
    """The event calendar (three events, E2 and E3 overlap at station 7)."""
    rows = [(e, s, t, list(ids), m) for e, s, t, ids, m in C.EVENT_CALENDAR]
    df = spark.createDataFrame(rows, "event_id string, start_s string, end_s string, station_ids array<int>, uplift_multiplier double")
    return df.select("event_id",
                     F.to_timestamp("start_s").alias("start_ts"),
                     F.to_timestamp("end_s").alias("end_ts"),
                     "station_ids", "uplift_multiplier")


def user_scopes(spark: SparkSession) -> DataFrame:
    rows = [(u, r, kind, (val if kind == "line" else None), (list(val) if kind == "stations" else None))
            for u, r, kind, val in C.USER_SCOPES]
    return spark.createDataFrame(rows, "user_principal_name string, role string, scope string, scope_line int, scope_stations array<int>")
