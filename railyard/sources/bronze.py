"""Bronze sources and sinks.

* wire format: taps as JSON messages (``value``), decoded with ``from_json``
  against the contract schema; the ingest time is stamped on arrival.
* rescue: malformed messages and keys outside the contract are kept in
  ``_rescued_data`` instead of being lost (PERMISSIVE parsing plus a key
  comparison against the contract).
* sink: Parquet, zstd, partitioned by each row's own ``dt``/``hour`` (D13).
  Rows are spread over a few tasks per hour so one hot hour is written in
  parallel instead of by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.session import scratch_path

# Contract of a tap message on the wire.
WIRE_SCHEMA = T.StructType([
    T.StructField("tap_id", T.LongType()),
    T.StructField("card_token", T.LongType()),
    T.StructField("station_id", T.IntegerType()),
    T.StructField("zone", T.IntegerType()),
    T.StructField("fare_class", T.StringType()),
    T.StructField("fare_amount_cad", T.DecimalType(18, 2)),
    T.StructField("tap_type", T.StringType()),
    T.StructField("tap_timestamp_utc", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("schema_version", T.StringType()),
    T.StructField("ingest_timestamp_utc", T.StringType()),
])
TIME_FIELDS = ("tap_timestamp_utc", "ingest_timestamp_utc")
CONTRACT_KEYS = tuple(f.name for f in WIRE_SCHEMA.fields)
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def bronze_view(bronze: DataFrame) -> DataFrame:
    """Bronze passthrough: the contract projection."""
    return bronze.select(*CONTRACT_KEYS)


# --- JSON wire format (S6, S7, F24) -------------------------------------------------
def encode_messages(bronze: DataFrame) -> DataFrame:
    """Taps as JSON text with ISO-8601 timestamps carrying an offset."""
    s = F.struct(*[
        F.date_format(c, ISO_FORMAT).alias(c) if c in ("tap_timestamp_utc", "ingest_timestamp_utc") else F.col(c)
        for c in CONTRACT_KEYS])
    return bronze.select(F.col("station_id").cast("string").alias("key"), F.to_json(s).alias("value"))


def _event_time(name: str):
    """ISO-8601 text with any number of fraction digits and any offset; NULL
    when it is no time (never an error)."""
    return F.try_to_timestamp(F.col(name))


def decode_messages(msgs: DataFrame, schema: T.StructType = WIRE_SCHEMA) -> DataFrame:
    """Contract fields typed, arrival stamped; whatever the contract cannot
    hold is kept in ``_rescued_data``."""
    return decode_with_rescue(msgs, schema).drop("rescue_reason").withColumn("_ingest_ts", F.current_timestamp())


def drifted_messages(bronze_with_k: DataFrame) -> DataFrame:
    """Wire messages with drift, for the rescue path: k = 97 carries an extra
    key ``promo_code``; k = 96 is not valid JSON."""
    m = bronze_with_k.select(
        F.col("k"),
        F.to_json(F.struct(*[
            F.date_format(c, ISO_FORMAT).alias(c) if c in ("tap_timestamp_utc", "ingest_timestamp_utc")
            else F.col(c) for c in CONTRACT_KEYS])).alias("value"),
        F.col("tap_id"))
    value = (F.when(F.col("k") == 97,
                    F.concat(F.expr("substring(value, 1, length(value) - 1)"),
                             F.lit(',"promo_code":"P'), F.col("tap_id").cast("string"), F.lit('"}')))
             .when(F.col("k") == 96, F.concat(F.lit("#"), F.col("value")))
             .otherwise(F.col("value")))
    return m.select(value.alias("value"))


def decode_with_rescue(msgs: DataFrame, schema: T.StructType = WIRE_SCHEMA) -> DataFrame:
    """PERMISSIVE decode: contract fields typed; malformed text, keys outside
    the contract and times that cannot be read land in ``_rescued_data`` (S4)."""
    times = [f.name for f in schema.fields if f.name in TIME_FIELDS]
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    v = F.col("value").cast("string")
    parsed = msgs.select(
        v.alias("_raw"),
        F.from_json(v, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("m"))
    as_map = F.from_json(F.col("_raw"), T.MapType(T.StringType(), T.StringType()))
    contract = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = F.map_filter(as_map, lambda k, _: ~F.array_contains(contract, k))
    malformed = F.col("_corrupt").isNotNull() | F.col("_empty")
    bad_time = F.lit(False)
    for t in times:
        bad_time = bad_time | (F.col(t).isNotNull() & _event_time(t).isNull())
    out = parsed.select("_raw", extra.alias("_extra"), F.col("m").isNull().alias("_empty"), "m.*")
    rescued = (F.when(malformed, F.col("_raw")).when(bad_time, F.col("_raw"))
               .when(F.size("_extra") > 0, F.to_json("_extra")))
    reason = (F.when(malformed, F.lit("malformed")).when(bad_time, F.lit("bad_time"))
              .when(F.size("_extra") > 0, F.lit("extra_keys")).otherwise(F.lit("ok")))
    return out.select(*[_event_time(f.name).alias(f.name) if f.name in times else F.col(f.name)
                        for f in schema.fields],
                      rescued.alias("_rescued_data"), reason.alias("rescue_reason"))


def rescue_summary(rescued: DataFrame) -> DataFrame:
    return rescued.groupBy("rescue_reason").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("tap_id").alias("decoded_taps"),
        F.count("_rescued_data").alias("rescued_rows"))


RESCUE_ORACLE = """
SELECT CASE WHEN k = 96 THEN 'malformed' WHEN k = 97 THEN 'extra_keys' ELSE 'ok' END AS rescue_reason,
       COUNT(*) AS rows,
       COUNT(CASE WHEN k = 96 THEN NULL ELSE tap_id END) AS decoded_taps,
       COUNT(CASE WHEN k IN (96, 97) THEN 1 END) AS rescued_rows
FROM bronze GROUP BY 1"""


# --- partitioned Parquet sink (S8, S12, S18, D13) -----------------------------------
def with_partition_columns(df: DataFrame, ts: str = "tap_timestamp_utc") -> DataFrame:
    return df.withColumn("dt", F.date_format(ts, "yyyy-MM-dd")).withColumn("hour", F.hour(ts))


def write_bronze(bronze: DataFrame, path: str | None = None, mode: str = "overwrite") -> str:
    """Write taps under ``dt=YYYY-MM-DD/hour=H`` by each row's own event time."""
    path = path or scratch_path(bronze.sparkSession, "bronze")
    # AQE merges quiet hours and splits hot ones by size
    (with_partition_columns(bronze).hint("rebalance", "dt", "hour")
       .write.mode(mode).partitionBy("dt", "hour")
       .option("compression", "zstd").option("maxRecordsPerFile", 5_000_000)
       .parquet(path))
    return path


def read_bronze(spark: SparkSession, path: str, since_dt: str | None = None) -> DataFrame:
    """Read the partitioned bronze table; a ``since_dt`` bound becomes a
    partition filter (pruned at planning time)."""
    df = spark.read.option("basePath", path).parquet(path)
    df = df.withColumn("dt", F.col("dt").cast("string"))
    if since_dt is not None:
        df = df.filter(F.col("dt") >= since_dt)
    return df


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> str:
    """Full-refresh materialisation."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# --- physical clustering on write (O5) ------------------------------------------------
def write_clustered(df: DataFrame, path: str, cluster_by=("date_key", "station_id"),
                    partitions: int | None = None) -> str:
    """Range-partition on the clustering keys and sort inside each file, so
    Parquet min/max statistics let readers skip files (no Z-order needed)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
       .write.mode("overwrite").option("compression", "zstd").parquet(path))
    return path


def _rank(col: str, cuts: list):
    """How many of the ascending ``cuts`` are at or below the value, by binary
    search as one expression; NULL ranks first."""
    def search(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(col) >= F.lit(cuts[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def zorder_key(df: DataFrame, cols, bits: int = 6):
    """Interleaved bits of the columns' range ranks: rows near each other in
    every column get near keys.  Ranks come from approximate quantiles (numbers,
    dates or times), ``2 ** bits - 1`` values per column on the driver."""
    at = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.percentile_approx(c, at, 10_000).alias(f"_q{i}") for i, c in enumerate(cols)]).first()
    key = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        rank = _rank(c, sorted(set(found[i] or []))).cast("bigint")
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(1), b * len(cols) + i))
    return key


def write_zordered(df: DataFrame, path: str, cluster_by, partitions: int | None = None, bits: int = 6) -> str:
    """Files clustered on several columns at once (O5): min/max statistics let
    readers skip files by any of them, not only by the first."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn("_z", zorder_key(df, cluster_by, bits)).repartitionByRange(n, "_z")
       .sortWithinPartitions("_z").drop("_z")
       .write.mode("overwrite").option("compression", "zstd").parquet(path))
    return path
