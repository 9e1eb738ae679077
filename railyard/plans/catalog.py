"""Registered queries: name -> (Spark builder, oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables; load and stream queries do their writes while building it.  Timestamps leave as ``timestamp_ntz`` (UTC wall clock) so
results compare independent of the reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.session import ensure_session


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None, ops: str = ""):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session(spark)
            return finalize(fn(spark, sf_dir))
        build.__name__ = f"q_{name}"
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, sql, ops)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}


def _load():
    # importing the modules fills REGISTRY
    from railyard.plans import (q_core, q_dims, q_quality, q_semantic, q_geo,  # noqa: F401
                                q_loads, q_streaming, q_sources)
