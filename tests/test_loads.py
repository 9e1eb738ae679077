"""Upsert (delete+insert), partition overwrite, reconciliation: metamorphic
checks - k batches equal one full refresh, re-running changes nothing, a key
that changes date leaves no stale row and no empty partition behind."""
import os

from pyspark.sql import functions as F

from railyard.operators import loads as L

SCHEMA = "tap_id long, v string, date_key int"


def _table_rows(spark, t):
    return sorted(tuple(r) for r in spark.table(t).select("tap_id", "v", "date_key").collect())


def test_upsert_key_moves_date_and_empties_partition(spark):
    t = L.new_table_name("t_upsert")
    L.upsert(spark, t, spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], SCHEMA), "tap_id", "date_key")
    # key 3 moves from date 2 to date 3: partition 2 becomes empty
    stats = L.upsert(spark, t, spark.createDataFrame([(3, "c2", 3), (1, "a2", 1)], SCHEMA), "tap_id", "date_key")
    assert _table_rows(spark, t) == [(1, "a2", 1), (2, "b", 1), (3, "c2", 3)]
    assert stats["dropped_partitions"] == 1
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect())
    assert parts == ["date_key=1", "date_key=3"]
    # no orphan data left where the emptied partition was
    loc = spark.sql(f"DESCRIBE FORMATTED {t}").filter("col_name = 'Location'").first()["data_type"]
    p2 = os.path.join(loc.replace("file:", ""), "date_key=2")
    assert not os.path.exists(p2) or not [f for f in os.listdir(p2) if f.endswith(".parquet")]
    assert spark.read.parquet(loc).count() == 3


def test_upsert_is_idempotent(spark):
    t = L.new_table_name("t_idem")
    batch = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    L.upsert(spark, t, batch, "tap_id", "date_key")
    before = _table_rows(spark, t)
    L.upsert(spark, t, batch, "tap_id", "date_key")
    assert _table_rows(spark, t) == before


def test_untouched_partitions_not_rewritten(spark):
    t = L.new_table_name("t_untouched")
    L.upsert(spark, t, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), "tap_id", "date_key")
    loc = spark.sql(f"DESCRIBE FORMATTED {t}").filter("col_name = 'Location'").first()["data_type"]
    p2 = os.path.join(loc.replace("file:", ""), "date_key=2")
    files_before = sorted(os.listdir(p2))
    L.upsert(spark, t, spark.createDataFrame([(1, "a2", 1)], SCHEMA), "tap_id", "date_key")
    assert sorted(os.listdir(p2)) == files_before


def test_k_batches_equal_full_refresh(spark):
    from tests.conftest import SMOKE
    from railyard.plans.q_loads import incremental_silver
    from railyard.operators import silver
    from railyard.sources import binding as B
    t = incremental_silver(spark, SMOKE)
    full = silver.build_silver(B.bronze_taps(spark, SMOKE), B.stations(spark, SMOKE))
    r = L.reconcile(full, spark.table(t).select(*silver.SILVER_COLUMNS)).first()
    assert r.status == "match" and r.rows_full == r.rows_incremental


def test_high_water_mark_strict_and_inclusive(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00")], "id int, s string") \
              .withColumn("ts", F.to_timestamp("s"))
    hwm = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert [r.id for r in L.incremental_source(df, hwm, "ts").collect()] == [2]
    assert sorted(r.id for r in L.incremental_source(df, hwm, "ts", inclusive=True).collect()) == [1, 2]


def test_session_overwrite_mode_untouched(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        t = L.new_table_name("t_mode")
        L.upsert(spark, t, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), "tap_id", "date_key")
        L.upsert(spark, t, spark.createDataFrame([(1, "a2", 1)], SCHEMA), "tap_id", "date_key")
        assert _table_rows(spark, t) == [(1, "a2", 1), (2, "b", 2)]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)


def test_upsert_null_partition_and_keys(spark):
    t = L.new_table_name("t_null")
    L.upsert(spark, t, spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", 3)], SCHEMA), "tap_id", "date_key")
    L.upsert(spark, t, spark.createDataFrame([(4, "d", None)], SCHEMA), "tap_id", "date_key")
    assert {r[0] for r in _table(spark, t)} == {1, 2, 3, 4}
    # both leave the NULL partition: it is empty, not stale
    L.upsert(spark, t, spark.createDataFrame([(1, "a", 1), (2, "b", 1), (4, "d", 1)], SCHEMA), "tap_id", "date_key")
    assert sorted(_table(spark, t)) == [(1, "a", 1), (2, "b", 1), (3, "c", 3), (4, "d", 1)]


def _table(spark, t):
    return [tuple(r) for r in spark.table(t).select("tap_id", "v", "date_key").collect()]


def test_upsert_removes_its_staging(spark):
    from railyard.session import checkpoint_dir
    t = L.new_table_name("t_clean")
    b = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    L.upsert(spark, t, b, "tap_id", "date_key")
    L.upsert(spark, t, b, "tap_id", "date_key")
    left = [f for f in os.listdir(os.path.join(checkpoint_dir(spark), "railyard-stage")) if f.startswith(t)]
    assert left == []


def test_shared_folder_is_required_off_local():
    import pytest

    from railyard.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())


def test_winners_of_a_large_batch_are_sought_in_bounded_tasks(spark, monkeypatch):
    """A batch is dealt to tasks by its rows before its keys are cut to one row; rows of one key may part there."""
    import contextlib
    import io

    from pyspark.sql import functions as F
    monkeypatch.setattr(L, "ROWS_PER_TASK", 10, raising=False)
    plans, real = [], L.create_table

    def spy(df, *args):
        if "version" in df.columns:
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain()
            plans.append(buf.getvalue())
        return real(df, *args)

    monkeypatch.setattr(L, "create_table", spy)
    t = L.new_table_name("t_winners")
    rows = spark.range(2000).selectExpr("IF(id < 900, 0, id % 300) AS id", "CAST(id AS INT) AS version", "0 AS part")
    L.upsert(spark, t, rows, "id", "part", order=("version",))
    L.upsert(spark, t, rows.withColumn("version", F.col("version") - F.when(F.col("id") % 2 == 0, 5).otherwise(-5)),
             "id", "part", order=("version",), stable_partition=True)
    assert "REPARTITION_BY_NUM" in plans[0]
    newest = {k: max(i for i in range(2000) if (0 if i < 900 else i % 300) == k) + (5 if k % 2 else 0) for k in range(300)}
    assert {r["id"]: r["version"] for r in spark.table(t).collect()} == newest
    assert spark.table(t).count() == 300
