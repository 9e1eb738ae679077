"""Bloom filters of a table's keys, one set per partition, beside the table.

An upsert whose keys may live in any partition asks which partitions may hold
the batch's keys.  A partition's filter is a number (a power of two, by its row
count) of 4 KB bitmaps; a key belongs to one bitmap by its hash and sets
``BITS`` bits there.  The filters are a catalog table of their own,
``<table>__keys``, partitioned like the table, built and probed with built-in
functions only; nothing but the partition values found goes to the driver.

A filter never misses a key, so a false positive costs reading one partition's
key column and never a row.  A partition without a filter counts as one that
may hold any key.  Filters are dropped before their partition is rewritten and
written after it, so a writer that fails in between leaves no wrong filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a bitmap of ``bitmap_construct_agg``, bits set per key, keys meant for a bitmap: one of 10^5 keys that a
#: partition does not hold passes its filter.
WIDTH, BITS, KEYS_PER_BITMAP = 32768, 12, 1365
#: Keys of one task while filters are built: a key gives ``BITS`` rows there, which are sorted by bitmap.
KEYS_PER_TASK = 100_000


def index_name(table: str) -> str:
    return f"{table}__keys"


def _hash(keys) -> Column:
    return F.xxhash64(*keys)


def _positions(h: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(h, F.lit(i)), F.lit(WIDTH)) for i in range(BITS)])


def _bucket(h: Column, slots: Column) -> Column:
    return h.bitwiseAND(slots - 1)


def filters(rows: DataFrame, keys, partition_col: str) -> DataFrame:
    """(slots, bucket, bits, partition_col): the filters of the partitions in
    ``rows``.  Keys are dealt out by bitmap, not by partition, to as many tasks
    as their number asks for, and only there give a row per bit, so a task holds
    the same whatever the size of the table or of one partition."""
    part = F.col(partition_col)
    tasks = max(1, math.ceil(rows.count() / KEYS_PER_TASK))
    hashed = rows.select(part, _hash([F.col(k) for k in keys]).alias("_h")).distinct()
    need = F.ceil(F.log2(F.greatest(F.col("_n") / KEYS_PER_BITMAP, F.lit(1.0))))
    sized = (hashed.groupBy(partition_col).agg(F.count("*").alias("_n"))
             .select(part.alias("_part"), F.pow(F.lit(2), need).cast("bigint").alias("slots")))
    # one row per partition value; without the broadcast all keys of a partition could meet in one task
    return (hashed.join(F.broadcast(sized), part.eqNullSafe(F.col("_part")))
            .select(partition_col, "slots", _bucket(F.col("_h"), F.col("slots")).alias("bucket"), "_h")
            .repartition(tasks, partition_col, "slots", "bucket")
            .select(partition_col, "slots", "bucket", F.explode(_positions(F.col("_h"))).alias("_p"))
            .groupBy(partition_col, "slots", "bucket").agg(F.bitmap_construct_agg("_p").alias("bits"))
            .select("slots", "bucket", "bits", partition_col))


def _bit_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def candidates(index: DataFrame, batch: DataFrame, keys, partition_col: str) -> DataFrame:
    """Partition values whose filters may hold a key of ``batch`` (columns ``keys``)."""
    probe = batch.select(_hash([F.col(k) for k in keys]).alias("_h")).distinct()
    # every key meets the bitmap of its bucket, per size in use (a few powers of two): an equi-join after a fan-out
    sizes = [r[0] for r in index.select("slots").distinct().collect()]
    if not sizes:
        return index.select(partition_col).limit(0)
    probe = probe.select("_h", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("_slots"))
    probe = probe.withColumn("_bucket", _bucket(F.col("_h"), F.col("_slots")))
    met = index.join(probe, (F.col("slots") == F.col("_slots")) & (F.col("bucket") == F.col("_bucket")))
    return (met.where(F.forall(_positions(F.col("_h")), lambda p: _bit_set(F.col("bits"), p)))
            .select(partition_col).distinct())


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(index_name(table))
