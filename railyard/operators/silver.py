"""Silver: quality gate with quarantine, latest-wins dedup, dimension conform.

Order of work (decision D12): every bronze row is tagged with its rule
violations first; violating rows go to quarantine with their reasons, the
rest are deduplicated on ``tap_id`` (latest ingest wins, ties broken on all
remaining columns, D8) and conformed with ``line_id``, ``date_key`` and
``tap_hour_utc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X

SILVER_COLUMNS = ("tap_id", "card_token", "station_id", "line_id", "zone", "fare_class",
                  "fare_amount_cad", "tap_type", "tap_timestamp_utc", "device_id",
                  "schema_version", "date_key", "tap_hour_utc", "ingest_timestamp_utc")

# Latest ingest first; the rest only break ties deterministically.
DEDUP_ORDER = ("ingest_timestamp_utc", "fare_amount_cad", "tap_timestamp_utc", "card_token",
               "station_id", "fare_class", "tap_type", "device_id", "zone", "schema_version")


def tag_violations(bronze: DataFrame, stations: DataFrame) -> DataFrame:
    """Add ``line_id`` (from the station dimension) and ``_reasons``.

    Reasons: ``tap_id_null``, ``event_time_null``, ``bad_tap_type`` and ``unknown_station``; an
    empty array means the row passes.  NULL rule results count as failures.
    """
    dim = stations.select("station_id", "line_id", F.lit(True).alias("_known"))
    j = bronze.join(dim, "station_id", "left")
    reasons = F.array_compact(F.array(
        F.when(F.col("tap_id").isNull(), F.lit("tap_id_null")),
        F.when(F.col("tap_timestamp_utc").isNull(), F.lit("event_time_null")),
        F.when(~F.coalesce(F.col("tap_type").isin(*C.TAP_TYPES), F.lit(False)), F.lit("bad_tap_type")),
        F.when(F.col("_known").isNull(), F.lit("unknown_station")),
    ))
    return j.withColumn("_reasons", reasons).drop("_known")


def fail_on_bad_fare_class(df: DataFrame) -> DataFrame:
    """expect_or_fail: a fare class outside the enum aborts the job."""
    ok = F.coalesce(F.col("fare_class").isin(*C.FARE_CLASSES), F.lit(False))
    return df.withColumn("fare_class", F.when(ok, F.col("fare_class")).otherwise(
        F.raise_error(F.concat(F.lit("expectation valid_fare_class failed for tap "),
                               F.col("tap_id").cast("string")))))


def split(bronze: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = tag_violations(bronze, stations)
    kept = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    quarantine = tagged.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
    return kept, quarantine


def latest_per_key(df: DataFrame, key: str = "tap_id", order=DEDUP_ORDER) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` (all descending).

    ``row_number() = 1`` lets Catalyst insert a partial window-group limit
    before the shuffle, so a hot key is cut to one row per map task before
    it is exchanged."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order if c in df.columns])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def conform(deduped: DataFrame) -> DataFrame:
    return (deduped
            .withColumn("date_key", X.date_key("tap_timestamp_utc"))
            .withColumn("tap_hour_utc", X.hour_trunc("tap_timestamp_utc"))
            .select(*SILVER_COLUMNS))


def build_silver(bronze: DataFrame, stations: DataFrame, enforce_fare_class: bool = True) -> DataFrame:
    kept, _ = split(bronze, stations)
    if enforce_fare_class:
        kept = fail_on_bad_fare_class(kept)
    return conform(latest_per_key(kept))


def observed_tags(bronze: DataFrame, stations: DataFrame, name: str = "silver_load"):
    """Tagged rows carrying run metrics (Q15): rows in, kept, quarantined.
    The metrics are filled by the first action that writes the frame, in the
    same pass - no second scan."""
    from pyspark.sql import Observation
    obs = Observation(name)
    tagged = tag_violations(bronze, stations).observe(
        obs, F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.size("_reasons") == 0).alias("rows_kept"),
        F.count_if(F.size("_reasons") > 0).alias("rows_quarantined"))
    return tagged, obs


def quarantine(bronze: DataFrame, stations: DataFrame) -> DataFrame:
    _, bad = split(bronze, stations)
    return bad.select("tap_id", "station_id", "tap_type", "ingest_timestamp_utc",
                      F.array_join("reasons", ",").alias("reasons"))
