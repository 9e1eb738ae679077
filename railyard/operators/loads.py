"""Incremental materialisation without a table format.

Tables are Parquet tables in the session catalog, partitioned on a date key.
An upsert (delete+insert on a key, decision D7) rewrites exactly the
partitions it touches:

1. before anything is written, column types are compared (``plan_types``): a
   narrower batch column is cast, a wider one widens the table's column (the
   files stay, Parquet reads them as the wider type), and a pair of types that
   no type holds without loss raises.  Columns the table lacks are added (old
   rows: NULL), columns the batch lacks are NULL.  The batch is staged once under
   the shared checkpoint folder; without ``order`` a key that it repeats raises;
2. touched partitions = partitions of the batch, plus, unless a key is known to
   keep its partition (``stable_partition``, implied when the partition column
   is part of the key), partitions where the batch's keys live today.  Which
   these may be is asked of the table's key index (``key_index``), and only the
   key column of those partitions is read.  A NULL partition value is a
   partition like any other;
3. with ``order``, the greatest of the stored and the new rows of a key wins,
   so an older version that arrives later changes nothing; without it the batch
   wins.  New content = rows of touched partitions whose key is not in the
   batch + winners, staged to a fresh path (the target is read while being
   replaced);
4. the staged rows are inserted with dynamic partition overwrite, so
   untouched partitions are never rewritten;
5. touched partitions left with no rows are cleared and dropped, at the place
   the catalog names, and the staged tables are removed.

An error up to step 3 leaves the table's rows as they were; one after it is
mended by running the same upsert again.  The only values brought to the driver
are partition values (one per touched date), which turn the target read into a
static partition filter.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators import key_index
from railyard.session import scratch_path

EPOCH = "1970-01-01 00:00:00"


def new_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(df: DataFrame, name: str, partition_col: str, path: str | None = None) -> None:
    """Partitioned Parquet table registered in the catalog, its files in the
    shared checkpoint folder (never a machine-local warehouse)."""
    path = path or scratch_path(df.sparkSession, f"table-{name}")
    (df.write.mode("overwrite").format("parquet").option("compression", "zstd")
       .option("path", path).partitionBy(partition_col).saveAsTable(name))


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Dynamic partition overwrite for our own writes only: the session's
    setting is restored afterwards (``insertInto`` ignores a per-write
    option)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


# --- L1 ------------------------------------------------------------------------------
def high_water_mark(spark: SparkSession, table: str, col: str):
    """Max of ``col`` in the target, the epoch when absent or empty.  The value
    travels as text, so no Python time zone touches it."""
    v = None
    if table_exists(spark, table):
        v = spark.table(table).agg(F.date_format(F.max(col), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return F.lit(v or EPOCH).cast("timestamp")


def incremental_source(source: DataFrame, hwm: Column, col: str, inclusive: bool = False) -> DataFrame:
    """Rows strictly above the mark (D8: ``inclusive`` re-reads the boundary;
    safe because the upsert is idempotent)."""
    return source.filter(F.col(col) >= hwm) if inclusive else source.filter(F.col(col) > hwm)


# --- L2 / L3 -------------------------------------------------------------------------
def _stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _remove(spark: SparkSession, path: str, keep_folder: bool = False) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where):
        fs.delete(where, True)
    if keep_folder:
        fs.mkdirs(where)


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]


def _same(a: DataFrame, b: DataFrame, keys):
    """Null-safe equality of the keys (still an equi-join)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b["_key_" + k])
    return cond


#: Decimal digits of the integer types; all but the largest fit a double exactly.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _lossless(a: T.DataType, b: T.DataType) -> bool:
    """Whether every value of ``a`` is a value of ``b``."""
    if a == b:
        return True
    if isinstance(b, T.DecimalType):
        if isinstance(a, T.DecimalType):
            return b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale
        return type(a) in _DIGITS and b.precision - b.scale >= _DIGITS[type(a)]
    if type(a) in _DIGITS:
        return (type(b) in _DIGITS and _DIGITS[type(a)] <= _DIGITS[type(b)]
                or isinstance(b, T.DoubleType) and not isinstance(a, T.LongType)
                or isinstance(b, T.FloatType) and isinstance(a, (T.ByteType, T.ShortType)))
    return (isinstance(a, T.FloatType) and isinstance(b, T.DoubleType)
            or isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, if there is one."""
    for c in (a, b, T.DoubleType()):
        if _lossless(a, c) and _lossless(b, c):
            return c
    whole = [t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS.get(type(t)) for t in (a, b)]
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
    if None in whole or max(whole) + scale > 38:
        return None
    return T.DecimalType(max(whole) + scale, scale)


def plan_types(target: T.StructType, batch: T.StructType, fixed=()) -> dict[str, T.DataType]:
    """Column -> wider type that the table needs to hold ``batch``; raises when
    no type holds both without loss, or a column in ``fixed`` would change."""
    new = {f.name.lower(): f.dataType for f in batch.fields}
    wider = {}
    for f in target.fields:
        kind = new.get(f.name.lower(), f.dataType)
        both = common_type(f.dataType, kind)
        if both is None or (both != f.dataType and f.name in fixed):
            raise ValueError(f"column {f.name}: {kind.simpleString()} does not fit "
                             f"{f.dataType.simpleString()} without loss")
        if both != f.dataType:
            wider[f.name] = both
    return wider


def widen_columns(spark: SparkSession, table: str, wider: dict[str, T.DataType], partition_col: str) -> None:
    """Declare columns of ``table`` with wider types.  Its files are left alone:
    the table's definition is replaced and its partitions are found again."""
    if not wider:
        return
    where, schema = _location(spark, table), spark.table(table).schema
    columns = ", ".join(f"`{f.name}` {wider.get(f.name, f.dataType).simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE {table}")  # the files are external and stay
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (compression 'zstd') "
              f"PARTITIONED BY (`{partition_col}`) LOCATION {_literal(where)}")
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Additive schema evolution: columns of ``df`` that the table lacks."""
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ("
                  + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")


def _literal(value) -> str:
    """A partition value as SQL."""
    if isinstance(value, str) or hasattr(value, "isoformat"):
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    return str(value)


def partition_values(spark: SparkSession, table: str, partition_col: str) -> set:
    """Values of the table's partitions, from the catalog: no file is opened."""
    names = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    texts = [(None if n == "__HIVE_DEFAULT_PARTITION__" else unquote(n),) for n in names]
    kind = spark.table(table).schema[partition_col].dataType.simpleString()
    return {r[0] for r in spark.createDataFrame(texts, "v string").select(F.col("v").cast(kind)).collect()}


def in_partitions(col: str, values) -> Column:
    """Static partition filter that also knows the NULL partition."""
    cond = F.col(col).isin([v for v in values if v is not None])
    return cond | F.col(col).isNull() if None in values else cond


def clear_partitions(spark: SparkSession, table: str, partition_col: str, values) -> None:
    """Remove the files of emptied partitions and drop them."""
    for v in values:
        if v is None:
            _remove(spark, f"{_location(spark, table)}/{partition_col}=__HIVE_DEFAULT_PARTITION__", keep_folder=True)
            continue
        spec = f"PARTITION (`{partition_col}` = {_literal(v)})"
        where = (spark.sql(f"DESCRIBE FORMATTED {table} {spec}").filter("col_name = 'Location'").first()["data_type"])
        _remove(spark, where, keep_folder=True)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    if values:
        spark.sql(f"REFRESH TABLE {table}")


def forget_keys(spark: SparkSession, table: str, partition_col: str, values) -> None:
    """Drop the key filters of partitions that are about to change: until new
    ones are written, an upsert reads the keys of these partitions."""
    if key_index.exists(spark, table):
        held = partition_values(spark, key_index.index_name(table), partition_col)
        clear_partitions(spark, key_index.index_name(table), partition_col, held & set(values))


def index_keys(spark: SparkSession, table: str, rows: DataFrame, keys, partition_col: str) -> None:
    """Write the key filters of the partitions in ``rows`` (all of their rows)."""
    made = key_index.filters(rows, keys, partition_col)
    if key_index.exists(spark, table):
        with dynamic_overwrite(spark):
            made.write.insertInto(key_index.index_name(table), overwrite=True)
    else:
        create_table(made, key_index.index_name(table), partition_col)


def partitions_of_keys(spark: SparkSession, table: str, batch_keys: DataFrame, keys, partition_col: str) -> set:
    """Partition values where keys of the batch (columns ``_key_...``) live today.
    Partitions without a filter are read once and get theirs."""
    named = batch_keys.select(*[F.col("_key_" + k).alias(k) for k in keys])
    all_values = partition_values(spark, table, partition_col)
    if key_index.exists(spark, table):
        index = spark.table(key_index.index_name(table))
        may = {r[0] for r in key_index.candidates(index, named, keys, partition_col).collect()}
        unknown = all_values - partition_values(spark, key_index.index_name(table), partition_col)
    else:
        may, unknown = set(), all_values
    if unknown:
        index_keys(spark, table, candidate_rows(spark, table, partition_col, unknown), keys, partition_col)
    look = candidate_rows(spark, table, partition_col, (may & all_values) | unknown)
    return {r[0] for r in look.join(batch_keys, _same(look, batch_keys, keys), "left_semi")
            .select(partition_col).distinct().collect()}


def candidate_rows(spark: SparkSession, table: str, partition_col: str, values) -> DataFrame:
    """The rows of the partitions ``values``, by a static partition filter."""
    return spark.table(table).filter(in_partitions(partition_col, values))


#: Rows of one task while the winners of a batch are sought: they are sorted by key there.
ROWS_PER_TASK = 250_000


def _winners(rows: DataFrame, keys, order, expected: int) -> DataFrame:
    """The greatest row of each key by ``order``.  Some ``expected`` rows are
    dealt to tasks of a bounded size, in which each key is cut to one row before
    the keys meet; the rows of one key from different tasks may part there, so
    no key makes a task large."""
    tasks = max(1, math.ceil(expected / ROWS_PER_TASK))
    if tasks > rows.sparkSession.sparkContext.defaultParallelism:  # as scanned, rows are in that many tasks
        rows = rows.repartition(tasks, *keys, F.spark_partition_id())
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order if c in rows.columns])
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(spark: SparkSession, table: str, batch: DataFrame, keys, partition_col: str,
           order=None, stable_partition: bool = False, staged: bool = False) -> dict:
    """Keyed merge of ``batch`` into ``table`` (see module doc).  Without
    ``order`` a key that the batch repeats raises.  A batch that is ``staged``
    reads files that stay as they are meanwhile, and is not copied.  Returns counters."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    moving = not (stable_partition or partition_col in keys)
    exists = table_exists(spark, table)
    wider = plan_types(spark.table(table).schema, batch.schema, fixed=(partition_col,)) if exists else {}
    staged_batch, batch_path = (batch, None) if staged else _stage(batch, f"{table}-batch")
    try:
        if not order and staged_batch.groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"the batch for {table} repeats a key; give an order to choose by")
        if not exists:
            create_table(_winners(staged_batch, keys, order, staged_batch.count()) if order else staged_batch, table, partition_col)
            if moving:
                index_keys(spark, table, spark.table(table), keys, partition_col)
            return {"created": True, "dropped_partitions": 0}
        widen_columns(spark, table, wider, partition_col)
        add_columns(spark, table, staged_batch)
        return _merge(spark, table, staged_batch, keys, partition_col, order, moving)
    finally:
        if batch_path:
            _remove(spark, batch_path)


def _merge(spark: SparkSession, table: str, staged_batch: DataFrame, keys, partition_col: str, order, moving) -> dict:
    target = spark.table(table)
    cols = target.columns
    rows = staged_batch.select(*[(F.col(f.name) if f.name in staged_batch.columns else F.lit(None)).cast(f.dataType)
                                 .alias(f.name) for f in target.schema.fields])
    batch_keys = staged_batch.select(*[F.col(k).alias("_key_" + k) for k in keys]).distinct()
    # partition values (one per date) are metadata: on the driver they make the reads below static
    touched = {r[0] for r in rows.select(partition_col).distinct().collect()}
    if moving:
        touched |= partitions_of_keys(spark, table, batch_keys, keys, partition_col)
    old = candidate_rows(spark, table, partition_col, touched)
    new = old.join(batch_keys, _same(old, batch_keys, keys), "left_anti")
    if order:
        stored = old.join(batch_keys, _same(old, batch_keys, keys), "left_semi")
        rows = _winners(stored.unionByName(rows), keys, order, 2 * staged_batch.count())
    staged, path = _stage(new.unionByName(rows), f"{table}-stage")
    kept = {r[0] for r in staged.select(partition_col).distinct().collect()}
    emptied = touched - kept
    forget_keys(spark, table, partition_col, touched)
    with dynamic_overwrite(spark):
        staged.select(*cols).write.insertInto(table, overwrite=True)
    had = emptied & partition_values(spark, table, partition_col) if emptied else set()
    clear_partitions(spark, table, partition_col, had)
    if moving:
        index_keys(spark, table, staged, keys, partition_col)
    _remove(spark, path)
    return {"created": False, "dropped_partitions": len(had)}


# --- L4 -------------------------------------------------------------------------------
def trailing_since(as_of: Column, days: int) -> Column:
    return F.date_sub(as_of, days)


# --- L5 ---------------------------------------------------------------------------------
def overwrite_partitions(spark: SparkSession, table: str, df: DataFrame, partition_col: str | None = None,
                         touched=None) -> None:
    """Replace the partitions present in ``df`` (insert_overwrite).  With
    ``touched`` (partition values), those that have no rows in ``df`` any more
    are cleared as well."""
    if key_index.exists(spark, table):
        forget_keys(spark, table, partition_col,
                    {r[0] for r in df.select(partition_col).distinct().collect()} | set(touched or ()))
    with dynamic_overwrite(spark):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    if touched is not None:
        kept = {r[0] for r in df.select(partition_col).distinct().collect()}
        emptied = set(touched) - kept
        had = emptied & partition_values(spark, table, partition_col) if emptied else set()
        clear_partitions(spark, table, partition_col, had)


# --- L6 ---------------------------------------------------------------------------------
def digests(df: DataFrame, partition_col: str, cols) -> DataFrame:
    """(partition, rows, low, high, mixed): an order-free digest of each
    partition's rows: their number, the sums of the two halves of one row hash
    and the xor of another, combined on the map side to one row per partition."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    first, second = F.xxhash64(*cols, nulls), F.xxhash64(F.lit(1), nulls, *cols)
    return df.groupBy(F.col(partition_col).alias("_part")).agg(
        F.count("*").alias("_rows"), F.sum(first.bitwiseAND(0xFFFFFFFF)).alias("_low"),
        F.sum(F.shiftrightunsigned(first, 32)).alias("_high"), F.bit_xor(second).alias("_mixed"))


def differing_partitions(full: DataFrame, incremental: DataFrame, partition_col: str) -> DataFrame:
    """One row per partition of either side: (partition, rows_full,
    rows_incremental, differs)."""
    cols = full.columns
    a, b = (digests(x, partition_col, cols) for x in (full, incremental))
    same = F.lit(True)
    for c in ("_rows", "_low", "_high", "_mixed"):
        same = same & F.col("a." + c).eqNullSafe(F.col("b." + c))
    both = a.alias("a").join(b.alias("b"), F.col("a._part").eqNullSafe(F.col("b._part")), "full")
    return both.select(F.coalesce("a._part", "b._part").alias("partition"),
                       F.coalesce("a._rows", F.lit(0)).alias("rows_full"),
                       F.coalesce("b._rows", F.lit(0)).alias("rows_incremental"), (~same).alias("differs"))


def differing_rows(full: DataFrame, incremental: DataFrame) -> DataFrame:
    """Each distinct row that the sides hold in different numbers, with both
    numbers ``_nf`` and ``_ni`` (one shuffle)."""
    cols = full.columns
    tagged = (full.select(*cols, F.lit(1).alias("_f"), F.lit(0).alias("_i"))
              .unionByName(incremental.select(*cols, F.lit(0).alias("_f"), F.lit(1).alias("_i"))))
    return (tagged.groupBy(*cols).agg(F.sum("_f").alias("_nf"), F.sum("_i").alias("_ni"))
            .filter("_nf <> _ni"))


def drift(full: DataFrame, incremental: DataFrame, partition_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The partitions of both sides with a mark where their digests differ, and
    the differing rows of just those partitions, read by a static partition
    filter (None: nothing differs).  The partitions' values, one per date, go
    to the driver."""
    parts = differing_partitions(full, incremental, partition_col)
    found = parts.collect()
    spark = full.sparkSession
    parts = spark.createDataFrame([tuple(r) for r in found], parts.schema)
    bad = {r["partition"] for r in found if r["differs"]}
    if not bad:
        return parts, None
    where = in_partitions(partition_col, bad)
    return parts, differing_rows(full.filter(where), incremental.filter(where))


def reconcile(full: DataFrame, incremental: DataFrame, partition_col: str | None = None) -> DataFrame:
    """One summary row: sizes and the multiset differences both ways.  With
    ``partition_col`` the partitions' digests are compared first and only rows of
    differing partitions meet; without it all rows do."""
    if partition_col is None:
        sizes = full.agg(F.count("*").alias("rows_full"), F.lit(None).cast("bigint").alias("rows_incremental"))
        sizes = sizes.unionByName(incremental.agg(F.lit(None).cast("bigint").alias("rows_full"),
                                                  F.count("*").alias("rows_incremental")))
        rows = differing_rows(full, incremental)
    else:
        sizes, rows = drift(full, incremental, partition_col)
    zero = F.lit(0).cast("bigint")
    counts = sizes.select("rows_full", "rows_incremental", zero.alias("only_in_full"), zero.alias("only_in_incremental"))
    if rows is not None:
        counts = counts.unionByName(rows.agg(
            zero.alias("rows_full"), zero.alias("rows_incremental"),
            F.sum(F.greatest(F.col("_nf") - F.col("_ni"), zero)).alias("only_in_full"),
            F.sum(F.greatest(F.col("_ni") - F.col("_nf"), zero)).alias("only_in_incremental")))
    out = counts.agg(*[F.coalesce(F.sum(c), zero).cast("bigint").alias(c) for c in counts.columns])
    return out.withColumn("status", F.when((F.col("only_in_full") == 0) & (F.col("only_in_incremental") == 0),
                                           F.lit("match")).otherwise(F.lit("drift")))


# --- L8 ----------------------------------------------------------------------------------
def rolling_refresh(stored: DataFrame, fresh: DataFrame, date_col: str, since: Column) -> DataFrame:
    """Recent window from ``fresh``, the long tail from ``stored``."""
    return stored.filter(F.col(date_col) < since).unionByName(fresh.filter(F.col(date_col) >= since))
