"""Session helpers.

The tap model is UTC throughout, so every job pins the session time zone to
UTC.  Lineage cuts go to the shared folder named by ``spark.checkpoint.dir``;
a folder of our own is only set when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "railyard", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, size
    ``spark.sql.shuffle.partitions`` to the data (about 128 MB per partition)
    and leave AQE on so it coalesces small ones."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings every railyard job relies on (UTC calendar maths)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local session, whose
    executors share the driver's disk, gets a scratch folder when it is unset;
    any other master raises."""
    global _scratch
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _scratch = d = _scratch or tempfile.mkdtemp(prefix="railyard-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


_scratch: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged writes."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "railyard-stage", f"{name}-{os.getpid()}-{next(_counter)}")


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
