"""Staged tables in the folder that all executors share.

``stage`` cuts lineage by writing Parquet under ``spark.checkpoint.dir`` and
reading it back, so a lost executor costs a re-read and no recomputation;
``discard`` removes a staged table that nothing reads any more.
"""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from railyard.session import checkpoint_dir


def reach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it.
    Where executors have no such path, ship the package (``--py-files``)."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return spark


class Stage:
    """The staged tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = reach(spark)
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/railyard-{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.made = 0

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.base}/{self.made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def settle(self) -> None:
        """Let go of the shuffle files of finished steps: Spark's cleaner removes
        them once the driver has collected the plans that wrote them, which may
        otherwise be long after the next large shuffle."""
        gc.collect()
        self.spark._jvm.System.gc()

    def discard(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self.paths.pop(id(df), None)
            if path:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
