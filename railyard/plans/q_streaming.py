"""Streaming queries (T1-T9) and health metrics.

Each streaming key lands the bound taps as files in arrival order, drains
them with an ``availableNow`` query, and returns the sink read as a batch
DataFrame; the oracle is the batch equivalent.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.operators import gold, observability as O, silver
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.plans.q_core import silver_of
from railyard.sources import binding as B
from railyard.sources import bronze as BR
from railyard.sources import contracts as CT
from railyard.sources import drift as D
from railyard.session import scratch_path
from railyard.streaming import keyed as K
from railyard.streaming import taps as S

_INVARIANT = ("tap_id", "card_token", "station_id", "fare_class", "tap_type", "tap_timestamp_utc")


@register("stream_bronze_ingest", compose("bronze", """
SELECT tap_id, card_token, station_id, zone, fare_class, CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad,
       tap_type, tap_timestamp_utc, device_id, schema_version, ingest_timestamp_utc, true AS has_lineage
FROM bronze"""), "S1 S2 S3 S9 S17 T4 T5")
def q_stream_bronze_ingest(spark, sf_dir):
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir))
    sink, _ = S.ingest_to_bronze(spark, landing)
    out = spark.read.parquet(sink)
    return out.select(*B.BRONZE_COLUMNS,
                      (F.col("_source_file").isNotNull() & F.col("_ingest_ts").isNotNull()).alias("has_lineage")) \
              .withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("stream_dedup", compose("bronze", f"""
SELECT DISTINCT {', '.join(_INVARIANT)} FROM bronze"""), "T1 T2 T7")
def q_stream_dedup(spark, sf_dir):
    """First arrival wins; only columns equal on every copy of a tap are
    returned, so the result does not depend on micro-batch boundaries."""
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir))
    sink, _ = S.stream_dedup(spark, landing)
    return spark.read.parquet(sink).select(*_INVARIANT)


@register("stream_hourly", compose("bronze", """
SELECT date_trunc('hour', tap_timestamp_utc) AS tap_hour_utc, station_id, fare_class, tap_type, COUNT(*) AS tap_count
FROM (SELECT DISTINCT tap_id, station_id, fare_class, tap_type, tap_timestamp_utc FROM bronze)
GROUP BY 1, 2, 3, 4"""), "T3 A8 A14")
def q_stream_hourly(spark, sf_dir):
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir))
    dedup, _ = S.stream_dedup(spark, landing)
    sink, _ = S.stream_hourly(spark, dedup, with_approx=False)
    return S.latest_windows(spark, sink)


@register("stream_quality_gate", compose("tagged_dq", """
SELECT tap_id, station_id, tap_type, ingest_timestamp_utc, array_to_string(reasons, ',') AS reasons
FROM tagged_dq WHERE len(reasons) > 0"""), "T6 Q6 Q8")
def q_stream_quality_gate(spark, sf_dir):
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir, with_violations=True))
    _, bad, _ = S.stream_quality_gate(spark, landing, B.stations(spark, sf_dir))
    return spark.read.parquet(bad).select("tap_id", "station_id", "tap_type", "ingest_timestamp_utc", "reasons")


@register("stream_upsert", compose("silver", """
SELECT * REPLACE (CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad) FROM silver"""), "T8 L2 D6")
def q_stream_upsert(spark, sf_dir):
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir))
    table, _ = S.stream_upsert(spark, landing, B.stations(spark, sf_dir))
    return spark.table(table).select(*silver.SILVER_COLUMNS) \
                .withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("lag_p95", compose("bronze", """
SELECT bin_start, taps, ROUND(p, 6) AS p95_lag_seconds, p > 300 AS lag_alert FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, ingest_timestamp_utc) AS bin_start, COUNT(*) AS taps,
         quantile_cont(CAST(floor((epoch_us(ingest_timestamp_utc) - epoch_us(tap_timestamp_utc)) / 1000000) AS BIGINT), 0.95) AS p
  FROM bronze GROUP BY 1)"""), "A15 T9 D20")
def q_lag_p95(spark, sf_dir):
    return O.lag_percentile(B.bronze_taps(spark, sf_dir))


@register("tap_rate_per_minute", compose("silver", """
SELECT time_bucket(INTERVAL 1 MINUTE, tap_timestamp_utc) AS minute_start, line_id, COUNT(*) AS taps,
       ROUND(COUNT(*) / 60.0, 6) AS taps_per_second
FROM silver GROUP BY 1, 2"""), "A16")
def q_tap_rate_per_minute(spark, sf_dir):
    return O.rate_per_minute(silver_of(spark, sf_dir), "line_id")


@register("late_row_accounting", compose("bronze", """
SELECT CAST(b.arrival_bin AS DATE) AS arrival_date, COUNT(*) AS arrivals,
       CAST(count_if(coalesce(b.e < m.watermark, false)) AS BIGINT) AS late_rows
FROM (SELECT time_bucket(INTERVAL 60 MINUTE, ingest_timestamp_utc) AS arrival_bin, tap_timestamp_utc AS e FROM (SELECT tap_timestamp_utc, CASE WHEN k = 95 THEN ingest_timestamp_utc + INTERVAL 1 DAY
                                   ELSE ingest_timestamp_utc END AS ingest_timestamp_utc FROM bronze)) b
JOIN (SELECT arrival_bin, max(mx) OVER (ORDER BY arrival_bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - INTERVAL 2 HOUR AS watermark
      FROM (SELECT time_bucket(INTERVAL 60 MINUTE, ingest_timestamp_utc) AS arrival_bin, max(tap_timestamp_utc) AS mx
            FROM (SELECT tap_timestamp_utc, CASE WHEN k = 95 THEN ingest_timestamp_utc + INTERVAL 1 DAY
                                   ELSE ingest_timestamp_utc END AS ingest_timestamp_utc FROM bronze) GROUP BY 1)) m USING (arrival_bin)
GROUP BY 1"""), "T7 T2")
def q_late_row_accounting(spark, sf_dir):
    """One tap in a hundred (k = 95) arrives a day after it was made."""
    b = B.bronze_taps(spark, sf_dir, with_k=True)
    return O.late_rows(b.withColumn("ingest_timestamp_utc", F.when(
        F.col("k") == 95, F.col("ingest_timestamp_utc") + F.expr("INTERVAL 1 DAY")).otherwise(
        F.col("ingest_timestamp_utc"))))


@register("stream_json_ingest", compose("bronze", """
SELECT tap_id, card_token, station_id, zone, fare_class, CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad,
       tap_type, tap_timestamp_utc, device_id, schema_version, ingest_timestamp_utc FROM bronze"""), "S6 S7 S1 F24")
def q_stream_json_ingest(spark, sf_dir):
    """Taps as JSON wire messages, decoded by a stream (the Kafka variant uses
    the same decode on the topic's ``value``)."""
    msgs = S.land_messages(B.bronze_taps(spark, sf_dir))
    sink, _ = S.ingest_messages(spark, msgs)
    return spark.read.parquet(sink).select(*B.BRONZE_COLUMNS) \
                .withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("stream_late_rows", compose("bronze", """
SELECT tap_id, k = 95 AND tap_timestamp_utc < (SELECT MAX(tap_timestamp_utc) FROM bronze WHERE k <> 95) - INTERVAL 2 HOUR
       AS is_late FROM bronze"""), "T1 T7 S10")
def q_stream_late_rows(spark, sf_dir):
    """A slice of the taps arrives after all others: what a watermarked
    operator would drop is in the side table, nothing is lost."""
    taps = B.bronze_taps(spark, sf_dir, with_k=True)
    path = S.land_by_arrival(taps.filter("k <> 95").select(*B.BRONZE_COLUMNS))
    S.land_by_arrival(taps.filter("k = 95").select(*B.BRONZE_COLUMNS), path, files=1)
    good, late, _ = S.stream_late_rows(spark, path, files_per_trigger=1)
    read = spark.read.schema(S.BRONZE_SCHEMA)
    return (read.parquet(good).select("tap_id", F.lit(False).alias("is_late"))
            .unionByName(read.parquet(late).select("tap_id", F.lit(True).alias("is_late"))))


@register("stream_json_rescue", compose("bronze", """
SELECT CAST(tap_id AS VARCHAR) AS tap_id, 'L' || CAST(zone AS VARCHAR) AS line, CAST(station_id AS VARCHAR) AS station_id,
       CASE WHEN k % 2 = 0 THEN date_trunc('second', tap_timestamp_utc) ELSE tap_timestamp_utc END AS tap_timestamp_utc,
       CASE WHEN k = 97 THEN 'extra' ELSE 'ok' END AS kind
FROM bronze WHERE k NOT IN (94, 96)
UNION ALL SELECT NULL, NULL, NULL, NULL, 'text kept' FROM bronze WHERE k = 96
UNION ALL SELECT CAST(tap_id AS VARCHAR), 'L' || CAST(zone AS VARCHAR), CAST(station_id AS VARCHAR), NULL, 'text kept'
FROM bronze WHERE k = 94"""), "S4 S6 S7 S11")
def q_stream_json_rescue(spark, sf_dir):
    """Twelve-field messages with string ids through a stream: whole-second
    and microsecond times, an extra key (k = 97), a time that is none (k = 94)
    and text that is no JSON (k = 96); nothing is lost."""
    b = B.bronze_taps(spark, sf_dir, with_k=True)
    iso = F.when(F.col("k") == 94, F.lit("yesterday")).when(
        F.col("k") % 2 == 0, F.date_format("tap_timestamp_utc", "yyyy-MM-dd'T'HH:mm:ssXXX")).otherwise(
        F.date_format("tap_timestamp_utc", BR.ISO_FORMAT))
    body = F.to_json(F.struct(
        F.col("tap_id").cast("string").alias("tap_id"), F.col("card_token").cast("string").alias("card_token"),
        F.col("station_id").cast("string").alias("station_id"),
        F.concat(F.lit("L"), F.col("zone").cast("string")).alias("line"), "zone", "fare_class",
        F.col("fare_amount_cad").cast("double").alias("fare_amount_cad"), "tap_type",
        iso.alias("tap_timestamp_utc"), "device_id", "schema_version",
        F.when(F.col("k") == 97, F.lit("P")).alias("promo_code")))
    value = F.when(F.col("k") == 96, F.concat(F.lit("#"), body)).otherwise(body)
    sink, _ = S.ingest_messages(spark, S.land_messages(b.select(value.alias("value"))),
                                schema=CT.wire_schema(CT.BRONZE_TAPS))
    kind = (F.when(F.col("_rescued_data").isNull(), F.lit("ok"))
            .when(F.col("_rescued_data") == F.lit('{"promo_code":"P"}'), F.lit("extra"))
            .when(F.length("_rescued_data") > 40, F.lit("text kept")))
    return spark.read.parquet(sink).select("tap_id", "line", "station_id", "tap_timestamp_utc", kind.alias("kind"))


@register("stream_arrivals", compose("bronze", """
SELECT tap_id, ingest_timestamp_utc > tap_timestamp_utc AS is_copy,
       CASE WHEN ingest_timestamp_utc > tap_timestamp_utc THEN 'duplicate'
            WHEN k = 95 AND tap_timestamp_utc < (SELECT max(ingest_timestamp_utc) FROM bronze WHERE k <> 95) - INTERVAL 2 HOUR
            THEN 'late' ELSE 'kept' END AS verdict
FROM bronze"""), "T1 T7 S9 T2")
def q_stream_arrivals(spark, sf_dir):
    """Every arrival has one verdict from one stateful operator; a slice of the
    taps (k = 95) arrives 40 days later, in a second run on the same checkpoint."""
    taps = B.bronze_taps(spark, sf_dir, with_k=True)
    path = S.land_by_arrival(taps.filter("k <> 95").select(*B.BRONZE_COLUMNS))
    copy = F.col("ingest_timestamp_utc") == F.col("tap_timestamp_utc") + F.expr("INTERVAL 1 HOUR")
    row = (F.col("tap_id") * 2 + F.when(copy, 1).otherwise(0)).alias("row")

    def run(sink=None):
        stream = S.read_stream(spark, path, 4).select("tap_id", "tap_timestamp_utc", "ingest_timestamp_utc", row)
        return K.stream_arrivals(spark, stream, "row", sink)[0]

    sink = run()
    later = taps.filter("k = 95").withColumn("ingest_timestamp_utc", F.expr("ingest_timestamp_utc + INTERVAL 40 DAYS"))
    S.land_by_arrival(later.select(*B.BRONZE_COLUMNS), path, files=1)
    run(sink)
    out = spark.read.schema(K.VERDICTS).parquet(sink).filter("verdict <> 'closed'")
    return out.select(F.expr("row DIV 2").alias("tap_id"), (F.col("row") % 2 == 1).alias("is_copy"), "verdict")


def _drifting(spark, sf_dir, without=()):
    """Twelve-field messages where k = 92 has a fraction in ``zone``, 93 a word
    in ``zone``, 94 a time that is none, 96 no JSON and 97 an extra key."""
    b = B.bronze_taps(spark, sf_dir, with_k=True).filter(~F.col("k").isin(*without, -1))
    k = F.col("k")

    def text(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    zone = F.when(k == 92, F.concat("zone", F.lit(".25"))).when(k == 93, F.lit('"east"')).otherwise(F.col("zone").cast("string"))
    time = F.when(k == 94, F.lit("yesterday")).otherwise(F.date_format("tap_timestamp_utc", BR.ISO_FORMAT))
    parts = {"tap_id": text(F.col("tap_id").cast("string")), "card_token": text(F.col("card_token").cast("string")),
             "station_id": text(F.col("station_id").cast("string")),
             "line": text(F.concat(F.lit("L"), F.col("zone").cast("string"))), "zone": zone, "fare_class": text(F.col("fare_class")),
             "fare_amount_cad": F.col("fare_amount_cad").cast("string"), "tap_type": text(F.col("tap_type")),
             "tap_timestamp_utc": text(time), "device_id": text(F.col("device_id")),
             "schema_version": text(F.col("schema_version"))}
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in parts.items()])
    body = F.concat(F.lit("{"), body, F.when(k == 97, F.lit(',"promo_code":"P"')).otherwise(F.lit("")), F.lit("}"))
    return b.select(F.when(k == 96, F.concat(F.lit("#"), body)).otherwise(body).alias("value"))


@register("json_field_rescue", compose("bronze", """
SELECT CASE WHEN k <> 96 THEN CAST(tap_id AS VARCHAR) END AS tap_id,
       CASE WHEN k NOT IN (92, 93, 96) THEN zone END AS zone,
       CASE WHEN k NOT IN (94, 96) THEN tap_timestamp_utc END AS tap_timestamp_utc,
       CASE WHEN k <> 96 THEN CAST(fare_amount_cad AS DOUBLE) END AS fare_amount_cad,
       CASE WHEN k = 96 THEN 0 WHEN k IN (92, 93, 94) THEN 10 ELSE 11 END AS fields_kept,
       CASE k WHEN 92 THEN '{"zone":' || zone || '.25}' WHEN 93 THEN '{"zone":"east"}'
              WHEN 94 THEN '{"tap_timestamp_utc":"yesterday"}' WHEN 97 THEN '{"promo_code":"P"}'
              WHEN 96 THEN 'whole text' END AS rescued
FROM bronze"""), "S4 S11 Q16")
def q_json_field_rescue(spark, sf_dir):
    """One bad field is rescued alone, the other ten stay."""
    schema = CT.wire_schema(CT.BRONZE_TAPS)
    out = D.decode_fields(_drifting(spark, sf_dir), schema)
    kept = sum(F.when(F.col(f.name).isNotNull(), 1).otherwise(0) for f in schema.fields)
    text = F.when(F.col("_rescued_data").startswith("#"), F.lit("whole text")).otherwise(F.col("_rescued_data"))
    return out.select("tap_id", "zone", "tap_timestamp_utc", "fare_amount_cad", kept.cast("int").alias("fields_kept"),
                      text.alias("rescued"))


@register("json_drift_report", compose("bronze", """
SELECT field, agreed, CASE WHEN field = 'fare_amount_cad' THEN 'number' ELSE seen END AS seen,
       (SELECT COUNT(*) FROM bronze WHERE k <> 96 AND (field <> 'promo_code' OR k = 97)) AS messages, status
FROM (VALUES ('tap_id', 'string', 'STRING', 'as agreed'), ('card_token', 'string', 'STRING', 'as agreed'),
  ('station_id', 'string', 'STRING', 'as agreed'), ('line', 'string', 'STRING', 'as agreed'),
  ('zone', 'int', 'VARIANT', 'mixed'), ('fare_class', 'string', 'STRING', 'as agreed'),
  ('fare_amount_cad', 'double', '', 'as agreed'), ('tap_type', 'string', 'STRING', 'as agreed'),
  ('tap_timestamp_utc', 'timestamp', 'STRING', 'as agreed'), ('device_id', 'string', 'STRING', 'as agreed'),
  ('schema_version', 'string', 'STRING', 'as agreed'), ('promo_code', NULL, 'STRING', 'new')
) t(field, agreed, seen, status)"""), "S5 Q9")
def q_json_drift_report(spark, sf_dir):
    """Types seen per field: a new key, and a field with values of two kinds."""
    r = D.drift_report(_drifting(spark, sf_dir), CT.wire_schema(CT.BRONZE_TAPS))
    number = F.col("seen").rlike("^(DECIMAL|DOUBLE|BIGINT)") & (F.col("field") == "fare_amount_cad")
    return r.withColumn("seen", F.when(number, F.lit("number")).otherwise(F.col("seen")))


@register("json_evolved", compose("bronze", """
SELECT CAST(tap_id AS VARCHAR) AS tap_id, CAST(zone AS DOUBLE) + CASE WHEN k = 92 THEN 0.25 ELSE 0 END AS zone,
       CASE WHEN k = 97 THEN 'P' END AS promo_code, true AS whole
FROM bronze WHERE k NOT IN (93, 94, 96)"""), "S5 Q9")
def q_json_evolved(spark, sf_dir):
    """The schema that the report leads to: ``zone`` grew to a decimal and
    ``promo_code`` is a column, so nothing is left to rescue."""
    msgs = _drifting(spark, sf_dir, without=(93, 94, 96))
    schema = CT.wire_schema(CT.BRONZE_TAPS)
    out = D.decode_fields(msgs, D.evolve(schema, D.drift_report(msgs, schema)))
    return out.select("tap_id", F.col("zone").cast("double").alias("zone"), "promo_code",
                      F.col("_rescued_data").isNull().alias("whole"))


_SPREAD = "to_seconds(CAST(k * 37 + tap_id % 60 AS INTEGER))"


@register("stream_lag_sketch", compose("bronze", f"""
SELECT date_trunc('day', tap_timestamp_utc + {_SPREAD}) AS bin_start, COUNT(*) AS taps, true AS within_bound
FROM bronze GROUP BY 1"""), "A15 T9")
def q_stream_lag_sketch(spark, sf_dir):
    """Daily p95 of arrival lag from the sketches of a stream's micro-batches:
    the exact ranks of each estimate lie within the stated error of 0.95."""
    late = F.expr("tap_timestamp_utc + make_interval(0, 0, 0, 0, 0, 0, k * 37 + tap_id % 60)")
    taps = (B.bronze_taps(spark, sf_dir, with_k=True).withColumn("ingest_timestamp_utc", late)
            .select(*B.BRONZE_COLUMNS))
    landing = S.land_by_arrival(taps)
    sink, _ = S.stream_sketches(spark, landing, lambda batch: O.lag_sketches(batch, 1440), files_per_trigger=2)
    estimate = O.lag_from_sketches(spark.read.parquet(sink).drop("_batch_id"))
    arrived = spark.read.schema(S.BRONZE_SCHEMA).parquet(landing)
    exact = arrived.select(F.window("ingest_timestamp_utc", "1440 minutes").start.alias("bin_start"),
                           O.lag_seconds("tap_timestamp_utc", "ingest_timestamp_utc").alias("lag"))
    ranks = exact.join(estimate.select("bin_start", "lag_seconds"), "bin_start").groupBy("bin_start").agg(
        F.count("*").alias("n"), F.count_if(F.col("lag") <= F.col("lag_seconds")).alias("upto"),
        F.count_if(F.col("lag") < F.col("lag_seconds")).alias("below"))
    e = F.lit(O.LAG_RANK_ERROR) + 1 / F.col("n")  # a quantile is one of the values
    near = (F.col("upto") / F.col("n") >= 0.95 - e) & (F.col("below") / F.col("n") <= 0.95 + e)
    return estimate.join(ranks, "bin_start").select("bin_start", "taps", near.alias("within_bound"))


@register("stream_riders", compose("bronze", """
SELECT date_trunc('day', tap_timestamp_utc) AS period_start, station_id, COUNT(*) AS taps,
       COUNT(DISTINCT card_token) AS riders, true AS within_bound FROM bronze GROUP BY 1, 2"""), "T3 A8 A14")
def q_stream_riders(spark, sf_dir):
    """Daily riders of each station from the hourly sketches that a stream
    wrote; an estimate is within 5 % of the exact number, or one rider."""
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir))
    hour = F.date_trunc("hour", "tap_timestamp_utc")
    sink, _ = S.stream_sketches(spark, landing, lambda batch: gold.slice_sketches(batch, hour, ("station_id", "zone")))
    got = gold.riders_at_any_grain(spark.read.parquet(sink).drop("_batch_id"), ("day",), ("station_id",))
    day = F.date_trunc("day", "tap_timestamp_utc").alias("period_start")
    exact = (spark.read.schema(S.BRONZE_SCHEMA).parquet(landing).groupBy(day, "station_id")
             .agg(F.countDistinct("card_token").alias("riders")))
    near = F.abs(F.col("unique_riders_approx") - F.col("riders")) <= F.greatest(F.lit(1.0), F.col("riders") * 0.05)
    return (got.select("period_start", F.col("slice_value").cast("int").alias("station_id"), "taps", "unique_riders_approx")
            .join(exact, ["period_start", "station_id"])
            .select("period_start", "station_id", "taps", "riders", near.alias("within_bound")))


@register("riders_any_grain", compose("silver", """
SELECT g.grain, date_trunc(g.grain, tap_hour_utc) AS period_start, s.slice,
       CASE s.slice WHEN 'station_id' THEN CAST(station_id AS VARCHAR) WHEN 'line_id' THEN CAST(line_id AS VARCHAR)
                    WHEN 'zone' THEN CAST(zone AS VARCHAR) ELSE 'all' END AS slice_value,
       COUNT(*) AS taps, COUNT(DISTINCT card_token) AS riders, true AS within_bound
FROM silver, (VALUES ('hour'), ('day'), ('week'), ('month'), ('quarter')) g(grain),
     (VALUES ('station_id'), ('line_id'), ('zone'), ('all')) s(slice) GROUP BY ALL"""), "A8 A17 A18")
def q_riders_any_grain(spark, sf_dir):
    """Riders from hour to quarter for station, line, zone and all, from stored
    sketches alone; exact counts beside them check the 5 % bound."""
    s = silver_of(spark, sf_dir).select("tap_hour_utc", "station_id", "line_id", "zone", "card_token")
    s = spark.read.schema(s.schema).parquet(BR.write_table(s, scratch_path(spark, "rider-taps")))
    path = BR.write_table(gold.slice_sketches(s), scratch_path(spark, "rider-sketches"))
    got = gold.riders_at_any_grain(spark.read.parquet(path))
    keys = ["grain", "period_start", "slice", "slice_value"]
    exact = gold.exact_riders_at_any_grain(s)
    near = F.abs(F.col("unique_riders_approx") - F.col("riders")) <= F.greatest(F.lit(1.0), F.col("riders") * 0.05)
    return got.join(exact, keys).select(*keys, "taps", "riders", near.alias("within_bound"))


@register("stream_gate_metrics", compose("tagged_dq", """
SELECT COUNT(*) AS rows_in, count_if(len(reasons) = 0)::BIGINT AS kept, count_if(len(reasons) > 0)::BIGINT AS quarantined,
       count_if(list_contains(reasons, 'bad_tap_type'))::BIGINT AS bad_tap_type,
       count_if(list_contains(reasons, 'unknown_station'))::BIGINT AS unknown_station,
       true AS every_batch_adds_up, count_if(len(reasons) = 0)::BIGINT AS written
FROM tagged_dq"""), "Q15 Q7 T6")
def q_stream_gate_metrics(spark, sf_dir):
    """Metrics that the stream's micro-batches reported, added up, beside the rows it wrote."""
    landing = S.land_by_arrival(B.bronze_taps(spark, sf_dir, with_violations=True))
    sink, q = S.stream_observed_gate(spark, landing, B.stations(spark, sf_dir))
    seen = S.observed(q)
    names = ("rows_in", "kept", "quarantined", "bad_tap_type", "unknown_station")
    rows = spark.createDataFrame([tuple(m[n] for n in names) for m in seen], ", ".join(f"{n} bigint" for n in names))
    fits = F.col("rows_in") == F.col("kept") + F.col("quarantined")
    return rows.agg(*[F.sum(n).alias(n) for n in names], F.bool_and(fits).alias("every_batch_adds_up"),
                    F.lit(spark.read.parquet(sink).count()).cast("bigint").alias("written"))
