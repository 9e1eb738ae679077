"""Reference-data scans (S13-S16) and additive schema evolution.

Networks are one directory level (``<root>/<network>/stations.csv``); each
network's files are read with a declared schema and tagged with a literal
``network`` column, then unioned by name.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATIONS_CSV_SCHEMA = ("station_id string, name string, line string, latitude double, longitude double, "
                       "ridership_prior double")
EVENTS_CSV_SCHEMA = ("event_id string, name string, venue_name string, venue_latitude double, "
                     "venue_longitude double, start_iso string, end_iso string, expected_attendance int")
CALENDAR_JSON_SCHEMA = ("name string, start string, `end` string, station_ids array<string>, "
                        "uplift_multiplier double")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other trouble (rights, network) raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load_stations(spark: SparkSession, root: str, network: str) -> DataFrame:
    """Stations of one network; a missing file or zero rows is an error."""
    path = os.path.join(root, network, "stations.csv")
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.schema(STATIONS_CSV_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)
    if df.limit(1).count() == 0:
        raise ValueError(f"no stations in {path}")
    return df.withColumn("network", F.lit(network))


def load_events(spark: SparkSession, root: str, network: str) -> DataFrame:
    """Events of one network; a missing file gives an empty frame of the same
    schema."""
    path = os.path.join(root, network, "events.csv")
    raw = (spark.read.schema(EVENTS_CSV_SCHEMA).option("header", True).csv(path) if _exists(spark, path)
           else spark.createDataFrame([], EVENTS_CSV_SCHEMA))
    return (raw.withColumn("start_ts", F.to_timestamp("start_iso"))
            .withColumn("end_ts", F.to_timestamp("end_iso")).withColumn("network", F.lit(network)))


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    """JSON-array event calendar (times without zone are UTC, D23); a missing
    file gives an empty frame of the same schema.  ``event_id`` is a hash of
    name and start, so the calendar can feed the event join."""
    raw = (spark.read.schema(CALENDAR_JSON_SCHEMA).option("multiLine", True).json(path) if _exists(spark, path)
           else spark.createDataFrame([], CALENDAR_JSON_SCHEMA))
    return (raw.withColumn("start_ts", F.to_timestamp("start")).withColumn("end_ts", F.to_timestamp("end"))
            .withColumn("event_id", F.xxhash64("name", "start")))


def load_networks(spark: SparkSession, root: str, networks) -> DataFrame:
    """Stations of several networks in one scan; each network's folder must
    hold stations."""
    paths = {n: os.path.join(root, n, "stations.csv") for n in networks}
    for n, path in paths.items():
        if not _exists(spark, path):
            raise FileNotFoundError(path)
    df = (spark.read.schema(STATIONS_CSV_SCHEMA).option("header", True).option("mode", "FAILFAST")
          .csv(list(paths.values())))
    df = df.withColumn("network", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/stations\.csv(?:/|$)", 1))
    found = {r[0] for r in df.select("network").distinct().collect()}  # one value per network
    if set(networks) - found:
        raise ValueError(f"no stations in {sorted(set(networks) - found)}")
    return df


def write_network_stations(stations: DataFrame, root: str, network_col: str = "network") -> None:
    """Seed writer for the reference layout (one CSV directory per network):
    one write partitioned by network, then the folders take their names."""
    spark = stations.sparkSession
    parts = root.rstrip("/") + "-parts"
    (stations.withColumn("_network", F.col(network_col)).drop(network_col).repartition("_network")
     .write.mode("overwrite").partitionBy("_network").option("header", True).csv(parts))
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.listStatus(hadoop.Path(parts)):
        name = s.getPath().getName()
        if name.startswith("_network="):
            home = hadoop.Path(f"{root}/{name[9:]}")
            fs.mkdirs(home)
            to = hadoop.Path(home, "stations.csv")
            fs.delete(to, True)
            fs.rename(s.getPath(), to)
    fs.delete(hadoop.Path(parts), True)


def renormalise_priors(stations: DataFrame) -> DataFrame:
    """prior / sum(prior) per network."""
    tot = stations.groupBy("network").agg(F.sum("ridership_prior").alias("_t"))
    return stations.join(tot, "network").withColumn(
        "prior_normalised", F.col("ridership_prior") / F.col("_t")).drop("_t")


# --- S5 ----------------------------------------------------------------------------------
def append_evolving(df: DataFrame, path: str) -> None:
    """Append with new columns allowed; readers merge schemas."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)

