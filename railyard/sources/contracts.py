"""Data contracts as data, and the schemas that follow from them.

A contract is a list of ``Field``; ``violations`` checks a frame against one
in a single aggregate pass, whatever the number of fields.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import constants as C


class Field(NamedTuple):
    name: str
    type: str
    required: bool = True
    enum: tuple = ()
    min: float | None = None
    unique: bool = False


# The tap contract and the hourly-fact contract.
BRONZE_TAPS = (
    Field("tap_id", "string", unique=True),
    Field("card_token", "string"),
    Field("station_id", "string"),
    Field("line", "string"),
    Field("zone", "int"),
    Field("fare_class", "string", enum=C.FARE_CLASSES),
    Field("fare_amount_cad", "double", min=0),
    Field("tap_type", "string", enum=C.TAP_TYPES),
    Field("tap_timestamp_utc", "timestamp"),
    Field("device_id", "string"),
    Field("schema_version", "string"),
    Field("ingest_timestamp_utc", "timestamp"),
)
GOLD_RIDERSHIP_HOURLY = (
    Field("date_key", "int"),
    Field("tap_hour_utc", "timestamp"),
    Field("station_id", "string"),
    Field("line_id", "string"),
    Field("zone", "int"),
    Field("tap_on_count", "int", min=0),
    Field("tap_off_count", "int", min=0),
    Field("total_taps", "int", min=0),
    Field("unique_riders", "int", min=0),
    Field("total_fare_cad", "double", min=0),
    Field("taps_per_rider", "double", required=False, min=0),
)


def schema_of(contract) -> T.StructType:
    return T._parse_datatype_string(", ".join(f"{f.name} {f.type}" for f in contract))


def wire_schema(contract) -> T.StructType:
    """Message schema: times travel as text."""
    return T.StructType([T.StructField(f.name, T.StringType() if f.type == "timestamp" else
                                       schema_of([f]).fields[0].dataType) for f in contract])


def violations(df: DataFrame, contract, name: str) -> DataFrame:
    """(contract, column_name, rule, failed_rows, total_rows, status) of every
    required / enum / min / unique rule.  Unique keys cost one extra shuffle;
    all other rules share one pass."""
    rules = []
    for f in contract:
        if f.name not in df.columns:
            if f.required:
                rules.append((f.name, "missing", F.count(F.lit(1))))
            continue
        c = F.col(f.name)
        if f.required:
            rules.append((f.name, "required", F.count_if(c.isNull())))
        if f.enum:
            rules.append((f.name, "enum", F.count_if(c.isNotNull() & ~c.isin(*f.enum))))
        if f.min is not None:
            rules.append((f.name, "min", F.count_if(c < f.min)))
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[r[2].alias(f"r{i}") for i, r in enumerate(rules)])
    cells = F.array(*[F.struct(F.lit(r[0]).alias("column_name"), F.lit(r[1]).alias("rule"),
                               F.col(f"r{i}").alias("failed_rows")) for i, r in enumerate(rules)])
    out = row.select(F.col("_n").alias("total_rows"), F.inline(cells))
    for f in contract:
        if f.unique and f.name in df.columns:
            per = df.groupBy(f.name).agg(F.count(F.lit(1)).alias("n"))
            out = out.unionByName(per.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.lit(f.name).alias("column_name"),
                F.lit("unique").alias("rule"),
                F.coalesce(F.sum(F.when((F.col("n") > 1) & F.col(f.name).isNotNull(), F.col("n"))), F.lit(0))
                .alias("failed_rows")).select("total_rows", "column_name", "rule", "failed_rows"))
    return out.select(F.lit(name).alias("contract"), "column_name", "rule",
                      F.col("failed_rows").cast("bigint").alias("failed_rows"),
                      F.col("total_rows").cast("bigint").alias("total_rows"),
                      F.when(F.col("failed_rows") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))
