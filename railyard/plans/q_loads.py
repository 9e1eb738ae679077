"""Incremental loads (L1-L8): each query replays arrivals in batches and
returns the resulting table, which must equal a full rebuild."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X
from railyard.operators import gold, loads as L, marts, silver
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.sources import binding as B
from railyard.session import scratch_path
from railyard.sources import bronze as BR
from railyard.sources.tables import read_table

# Arrival boundaries on ingest time: three loads.
BOUNDARIES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00", None)
KPI_AS_OF = "2024-01-30"


def incremental_silver(spark, sf_dir, boundaries=BOUNDARIES) -> str:
    """Load silver in arrival batches: high-water mark, batch silver, upsert."""
    table = L.new_table_name("railyard_silver")
    bronze = B.bronze_taps(spark, sf_dir)
    st = B.stations(spark, sf_dir)
    for b in boundaries:
        src = L.incremental_source(bronze, L.high_water_mark(spark, table, "ingest_timestamp_utc"),
                                   "ingest_timestamp_utc")
        if b is not None:
            src = src.filter(F.col("ingest_timestamp_utc") < F.lit(b).cast("timestamp"))
        # every copy of a tap carries its event time, so a tap never changes its date
        L.upsert(spark, table, silver.build_silver(src, st), "tap_id", "date_key",
                 order=silver.DEDUP_ORDER, stable_partition=True)
    return table


@register("silver_incremental_upsert", compose("silver", """
SELECT * REPLACE (CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad) FROM silver"""), "L1 L2 U2 A13 D7 D8")
def q_silver_incremental_upsert(spark, sf_dir):
    t = incremental_silver(spark, sf_dir)
    return spark.table(t).select(*silver.SILVER_COLUMNS).withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("reconcile_full_vs_incremental", compose("silver", """
SELECT COUNT(*) AS rows_full, COUNT(*) AS rows_incremental, CAST(0 AS BIGINT) AS only_in_full,
       CAST(0 AS BIGINT) AS only_in_incremental, 'match' AS status FROM silver"""), "L6 U3")
def q_reconcile(spark, sf_dir):
    t = incremental_silver(spark, sf_dir)
    full = silver.build_silver(B.bronze_taps(spark, sf_dir), B.stations(spark, sf_dir))
    return L.reconcile(full, spark.table(t).select(*silver.SILVER_COLUMNS), "date_key")


@register("reconcile_drift", """
SELECT CAST(o_custkey % 7 AS INTEGER) AS partition, COUNT(*) AS rows_full,
       COUNT(*) - COUNT(*) FILTER (WHERE o_custkey % 7 = 5 AND o_orderkey = lost) AS rows_incremental,
       o_custkey % 7 IN (3, 5) AS differs,
       CASE WHEN o_custkey % 7 IN (3, 5) THEN 1 ELSE 0 END::BIGINT AS only_in_full,
       CASE WHEN o_custkey % 7 = 3 THEN 1 ELSE 0 END::BIGINT AS only_in_incremental
FROM orders, (SELECT MIN(o_orderkey) AS lost FROM orders WHERE o_custkey % 7 = 5) GROUP BY ALL""", "L6 U3")
def q_reconcile_drift(spark, sf_dir):
    """One changed row in partition 3 and one lost row in partition 5 are found;
    the rows of all other partitions are never compared."""
    v = _versions(spark, sf_dir).drop("version")
    t = L.new_table_name("railyard_drift")
    keys = {p: v.filter(F.col("part") == p).agg(F.min("o_orderkey")).first()[0] for p in (3, 5)}
    L.create_table(v.withColumn("price", F.when(F.col("o_orderkey") == keys[3], F.col("price") + 0.25)
                                .otherwise(F.col("price"))).filter(F.col("o_orderkey") != keys[5]), t, "part")
    parts, rows = L.drift(v, spark.table(t).select(*v.columns), "part")
    per = rows.groupBy("part").agg(F.sum(F.greatest(F.col("_nf") - F.col("_ni"), F.lit(0))).alias("only_in_full"),
                                   F.sum(F.greatest(F.col("_ni") - F.col("_nf"), F.lit(0))).alias("only_in_incremental"))
    return (parts.join(per, F.col("partition") == F.col("part"), "left")
            .select("partition", "rows_full", "rows_incremental", "differs",
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("only_in_full", "only_in_incremental")]))


@register("partition_overwrite", compose("fact_rh", "SELECT * FROM fact_rh"), "L5 S18 D16")
def q_partition_overwrite(spark, sf_dir):
    """Fact built from the first arrivals, then only the date partitions the
    late arrivals touch are recomputed and overwritten."""
    bronze = B.bronze_taps(spark, sf_dir)
    st = B.stations(spark, sf_dir)
    cut = F.lit(BOUNDARIES[1]).cast("timestamp")
    table = L.new_table_name("railyard_fact")
    early = silver.build_silver(bronze.filter(F.col("ingest_timestamp_utc") < cut), st)
    L.create_table(gold.fact_ridership_hourly(early), table, "date_key")
    # dates of late arrivals: one value per date; bronze is cut to them before silver is built
    touched = [r[0] for r in bronze.filter(F.col("ingest_timestamp_utc") >= cut)
               .select(X.date_key("tap_timestamp_utc").alias("date_key")).distinct().collect()]
    late_days = (bronze.withColumn("_d", X.date_key("tap_timestamp_utc"))
                 .filter(L.in_partitions("_d", touched)).drop("_d"))
    fresh = gold.fact_ridership_hourly(silver.build_silver(late_days, st))
    L.overwrite_partitions(spark, table, fresh, "date_key", touched)
    return spark.table(table).select(*gold.RIDERSHIP_KEYS, "tap_on_count", "tap_off_count", "total_taps",
                                     "unique_riders", "total_fare_cad", "taps_per_rider")


@register("kpis_trailing_window", compose("station_kpis", "SELECT * FROM station_kpis"), "L3 L4 F10")
def q_kpis_trailing_window(spark, sf_dir):
    """KPI mart built once, then its trailing 7 days recomputed from new data
    and upserted on (station_id, service_date)."""
    bronze = B.bronze_taps(spark, sf_dir)
    st = B.stations(spark, sf_dir)
    table = L.new_table_name("railyard_kpis")
    early = silver.build_silver(bronze.filter(F.col("ingest_timestamp_utc") < F.lit("2024-01-25").cast("timestamp")), st)
    L.upsert(spark, table, marts.station_kpis(gold.fact_ridership_hourly(early), gold.fact_fare_revenue(early)),
             ["station_id", "service_date"], "service_date")
    since = L.trailing_since(F.lit(KPI_AS_OF).cast("date"), C.KPI_TRAILING_DAYS)
    # a tap keeps its event time, so the trailing window can be cut out of bronze before silver is built
    full = silver.build_silver(bronze.filter(F.col("tap_timestamp_utc") >= since.cast("timestamp")), st)
    recent = marts.station_kpis(gold.fact_ridership_hourly(full), gold.fact_fare_revenue(full), since=since)
    L.upsert(spark, table, recent, ["station_id", "service_date"], "service_date")
    cols = ["station_id", "service_date", "daily_taps", "peak_hour_taps", "avg_hour_taps", "active_hours",
            "fare_revenue_cents", "fare_revenue_dollars", "concession_taps", "youth_taps", "senior_taps",
            "employee_taps", "concession_share", "daily_volume_band"]
    return spark.table(table).select(*cols)


def _line_daily(fact):
    return (fact.withColumn("service_date", F.to_date("tap_hour_utc"))
            .groupBy("line_id", "service_date")
            .agg(F.sum("total_taps").alias("total_taps"),
                 X.money_out(F.sum(X.money("total_fare_cad"))).alias("total_fare_cad")))


@register("rolling_refresh", compose("fact_rh", """
SELECT line_id, CAST(tap_hour_utc AS DATE) AS service_date, CAST(SUM(total_taps) AS BIGINT) AS total_taps,
       ROUND(CAST(SUM(CAST(total_fare_cad AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_fare_cad
FROM fact_rh GROUP BY 1, 2"""), "L8")
def q_rolling_refresh(spark, sf_dir):
    bronze = B.bronze_taps(spark, sf_dir)
    st = B.stations(spark, sf_dir)
    early = silver.build_silver(bronze.filter(F.col("ingest_timestamp_utc") < F.lit("2024-01-25").cast("timestamp")), st)
    stored_path = BR.write_table(_line_daily(gold.fact_ridership_hourly(early)), scratch_path(spark, "line-daily"))
    stored = spark.read.parquet(stored_path)
    since = L.trailing_since(F.lit(KPI_AS_OF).cast("date"), C.KPI_TRAILING_DAYS)
    recent = bronze.filter(F.col("tap_timestamp_utc") >= since.cast("timestamp"))
    fresh = _line_daily(gold.fact_ridership_hourly(silver.build_silver(recent, st)))
    return L.rolling_refresh(stored, fresh, "service_date", since)


@register("replay_rebuild", compose("fact_rh", "SELECT * FROM fact_rh"), "L7 S8")
def q_replay_rebuild(spark, sf_dir):
    """Silver and gold rebuilt from the immutable, partitioned bronze files."""
    path = BR.write_bronze(B.bronze_taps(spark, sf_dir))
    replay = BR.read_bronze(spark, path).select(*B.BRONZE_COLUMNS)
    return gold.fact_ridership_hourly(silver.build_silver(replay, B.stations(spark, sf_dir)))


# --- upsert semantics over orders ----------------------------------------------------
def _versions(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return o.select("o_orderkey", (F.col("o_orderkey") % 3).cast("int").alias("version"),
                    (F.col("o_custkey") % 7).cast("int").alias("part"), F.col("o_totalprice").alias("price"))


@register("upsert_out_of_order", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 < 2 THEN 1 ELSE CAST(o_orderkey % 3 AS INTEGER) END AS version,
       CAST(o_custkey % 7 AS INTEGER) AS part,
       CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 < 2 THEN o_totalprice + 1 ELSE o_totalprice END AS price
FROM orders""", "L2 T8 D8")
def q_upsert_out_of_order(spark, sf_dir):
    """Version 1 of the even orders arrives after versions 0, 1 and 2: it
    replaces 0 and (higher price) 1, never 2."""
    t = L.new_table_name("railyard_versions")
    v = _versions(spark, sf_dir)
    L.upsert(spark, t, v, "o_orderkey", "part", order=("version", "price"))
    late = v.filter("o_orderkey % 2 = 0").withColumn("version", F.lit(1)).withColumn("price", F.col("price") + 1)
    L.upsert(spark, t, late, "o_orderkey", "part", order=("version", "price"), stable_partition=True)
    return spark.table(t).select("o_orderkey", "version", "part", "price")


@register("upsert_null_partition", """
SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 7 AS INTEGER) END AS part,
       CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 2 ELSE o_totalprice END AS price
FROM orders""", "L2 D7")
def q_upsert_null_partition(spark, sf_dir):
    """Rows live in a NULL partition, and a fifth of all keys moves into it."""
    t = L.new_table_name("railyard_null_part")
    v = _versions(spark, sf_dir).drop("version").withColumn("part", F.expr("nullif(part, 0)"))
    L.upsert(spark, t, v, "o_orderkey", "part")
    moved = v.filter("o_orderkey % 5 = 0").withColumn("part", F.lit(None).cast("int")).withColumn(
        "price", F.col("price") + 2)
    L.upsert(spark, t, moved, "o_orderkey", "part")
    return spark.table(t).select("o_orderkey", "part", "price")


@register("upsert_new_column", """
SELECT o_orderkey, CAST(o_custkey % 7 AS INTEGER) AS part, o_totalprice AS price,
       CASE WHEN o_orderkey % 4 = 0 THEN 'checked' END AS note
FROM orders""", "L2 S5")
def q_upsert_new_column(spark, sf_dir):
    """A batch brings a column that the table lacks."""
    t = L.new_table_name("railyard_new_col")
    v = _versions(spark, sf_dir).drop("version")
    L.upsert(spark, t, v, "o_orderkey", "part")
    L.upsert(spark, t, v.filter("o_orderkey % 4 = 0").withColumn("note", F.lit("checked")), "o_orderkey", "part")
    return spark.table(t).select("o_orderkey", "part", "price", "note")


@register("upsert_widened_column", """
SELECT o_orderkey, CAST(o_custkey % 7 AS INTEGER) AS part,
       CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE trunc(o_totalprice) END AS price,
       CASE WHEN o_orderkey % 4 = 0 THEN 5000000000 + o_orderkey ELSE o_orderkey % 100 END AS points
FROM orders""", "L2 S5")
def q_upsert_widened_column(spark, sf_dir):
    """A batch brings doubles for an int column and longs for an int column:
    the columns grow, no digit is lost, and rows stored before stay."""
    t = L.new_table_name("railyard_wide")
    v = _versions(spark, sf_dir).drop("version")
    L.upsert(spark, t, v.select("o_orderkey", "part", F.col("price").cast("int").alias("price"),
                                (F.col("o_orderkey") % 100).cast("int").alias("points")), "o_orderkey", "part")
    L.upsert(spark, t, v.filter("o_orderkey % 4 = 0").withColumn("points", F.col("o_orderkey") + F.lit(5000000000)),
             "o_orderkey", "part")
    return spark.table(t).select("o_orderkey", "part", "price", "points")


@register("upsert_text_partition", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'it''s moved: 50% a/b' ELSE
         CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'kind=' || o_orderpriority || ' ''q'' a:b/c' END END AS part,
       CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS price
FROM orders""", "L2 D7")
def q_upsert_text_partition(spark, sf_dir):
    """Partition values with quotes, colons, slashes, percent and equals signs;
    one partition loses all its rows to a new one."""
    t = L.new_table_name("railyard_text_part")
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
    name = F.concat(F.lit("kind="), "o_orderpriority", F.lit(" 'q' a:b/c"))
    part = F.when(F.col("o_custkey") % 11 != 0, name)
    L.upsert(spark, t, o.select("o_orderkey", part.alias("part"), F.col("o_totalprice").alias("price")),
             "o_orderkey", "part")
    moved = o.filter("o_orderpriority = '5-LOW'").select("o_orderkey", F.lit("it's moved: 50% a/b").alias("part"),
                                                         (F.col("o_totalprice") + 1).alias("price"))
    L.upsert(spark, t, moved, "o_orderkey", "part")
    return spark.table(t).select("o_orderkey", "part", "price")


@register("upsert_key_index", """
SELECT o_orderkey,
       CAST(CASE WHEN o_orderkey % 97 = 0 THEN o_custkey % 40 + 40 WHEN o_orderkey % 89 = 0 THEN 90
                 ELSE o_custkey % 40 END AS INTEGER) AS part,
       CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1
            ELSE o_totalprice END AS price
FROM orders""", "L2 U2")
def q_upsert_key_index(spark, sf_dir):
    """Keys move between 40 and more partitions in two batches, some of them
    twice; the key index names the partitions to read."""
    t = L.new_table_name("railyard_indexed")
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    o = o.select("o_orderkey", (F.col("o_custkey") % 40).cast("int").alias("part"), F.col("o_totalprice").alias("price"))
    L.upsert(spark, t, o.select("o_orderkey", "part", "price"), "o_orderkey", "part")
    L.upsert(spark, t, o.filter("o_orderkey % 89 = 0").select("o_orderkey", F.lit(90).alias("part"),
                                                              (F.col("price") + 1).alias("price")), "o_orderkey", "part")
    L.upsert(spark, t, o.filter("o_orderkey % 97 = 0").select("o_orderkey", (F.col("part") + 40).alias("part"),
                                                              (F.col("price") + 2).alias("price")), "o_orderkey", "part")
    return spark.table(t).select("o_orderkey", "part", "price")

