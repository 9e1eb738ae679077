"""Streams: restart from checkpoint adds nothing, late rows are accounted."""
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.sources import binding as B
from railyard.streaming import taps as S
from tests.conftest import SMOKE


def test_restart_resumes_from_checkpoint(spark):
    landing = S.land_by_arrival(B.bronze_taps(spark, SMOKE))
    sink, _ = S.ingest_to_bronze(spark, landing)
    n1 = spark.read.parquet(sink).count()
    sink2, _ = S.ingest_to_bronze(spark, landing, sink=sink)     # same checkpoint
    assert sink2 == sink and spark.read.parquet(sink).count() == n1


def test_late_rows_counted(spark):
    """Rows arriving behind the watermark are counted by the batch accounting;
    the streaming progress metric is read without failing."""
    from railyard.operators import observability as O
    bronze = B.bronze_taps(spark, SMOKE)
    shifted = bronze.withColumn("ingest_timestamp_utc",
                                F.when(F.to_date("tap_timestamp_utc") < "2024-01-03",
                                       F.lit("2024-01-31 00:00:00").cast("timestamp"))
                                 .otherwise(F.col("ingest_timestamp_utc")))
    out = {r.arrival_date.isoformat(): r.late_rows for r in O.late_rows(shifted).collect()}
    early = bronze.filter(F.to_date("tap_timestamp_utc") < "2024-01-03").count()
    assert out["2024-01-31"] >= early > 0
    assert sum(v for k, v in out.items() if k != "2024-01-31") == 0
    # one row far behind the others arrives in a last file: a windowed aggregate drops and reports it
    landing = S.land_by_arrival(bronze)
    old = bronze.limit(1).withColumn("tap_timestamp_utc", F.lit("2023-12-01 00:00:00").cast("timestamp"))
    S.land_by_arrival(old, landing, files=1)
    _, q = S.stream_hourly(spark, landing, with_approx=False, output_mode="append", files_per_trigger=1)
    assert S.dropped_by_watermark(q) == 1
    # the side table keeps it
    good, late, _ = S.stream_late_rows(spark, landing, files_per_trigger=1)
    assert spark.read.parquet(late).count() == 1
    assert spark.read.parquet(good).count() == bronze.count()


def test_stream_dedup_equals_batch_distinct(spark):
    landing = S.land_by_arrival(B.bronze_taps(spark, SMOKE))
    sink, q = S.stream_dedup(spark, landing)
    out = spark.read.parquet(sink)
    assert out.count() == out.select("tap_id").distinct().count() == B.bronze_taps(spark, SMOKE).select("tap_id").distinct().count()
    assert S.dropped_by_watermark(q) == 0


def test_timed_trigger_then_resume(spark):
    """Timer-driven micro-batches; a later availableNow run on the same
    checkpoint picks up whatever the timed run had not reached."""
    landing = S.land_by_arrival(B.bronze_taps(spark, SMOKE))
    sink, q = S.ingest_to_bronze(spark, landing, every="1 second", timeout_s=8)
    assert not q.isActive
    S.ingest_to_bronze(spark, landing, sink=sink)
    assert spark.read.parquet(sink).count() == B.bronze_taps(spark, SMOKE).count()


def test_gate_replay_writes_once(spark):
    """A batch replayed after a failure (same batch id) overwrites itself."""
    landing = S.land_by_arrival(B.bronze_taps(spark, SMOKE, with_violations=True))
    st = B.stations(spark, SMOKE)
    good, bad, _ = S.stream_quality_gate(spark, landing, st)
    n = spark.read.parquet(good).count(), spark.read.parquet(bad).count()
    root = good.rsplit("/", 1)[0]
    # a new checkpoint starts at batch 0 again, as a lost one would
    import shutil
    shutil.copytree(root, root + "-replay")
    S.stream_quality_gate(spark, landing, st, sink=root + "-replay")
    assert (spark.read.parquet(root + "-replay/kept").count(),
            spark.read.parquet(root + "-replay/quarantine").count()) == n


SAMPLE_TAP = {"tap_id": "00000000-0000-0000-0000-000000000001", "card_token": "card-0000001", "station_id": "UNION",
              "line": "Lakeshore West", "zone": 1, "fare_class": "ADULT", "fare_amount_cad": 6.05, "tap_type": "TAP_ON",
              "tap_timestamp_utc": "2026-06-12T20:15:00+00:00", "device_id": "reader-UNION-1", "schema_version": "v1"}


def test_contract_tap_batch_and_stream(spark):
    import json

    from railyard.sources import bronze as BR, contracts as CT
    schema = CT.wire_schema(CT.BRONZE_TAPS)
    msgs = spark.createDataFrame([(json.dumps(SAMPLE_TAP),), ("{broken",)], "value string")
    sink, _ = S.ingest_messages(spark, S.land_messages(msgs), schema=schema)
    for got in (BR.decode_messages(msgs, schema).collect(), spark.read.parquet(sink).collect()):
        ok = next(r for r in got if r.tap_id)
        assert (ok.station_id, ok.line, ok.zone, ok.fare_amount_cad) == ("UNION", "Lakeshore West", 1, 6.05)
        assert ok.tap_timestamp_utc.isoformat() == "2026-06-12T20:15:00" and ok._rescued_data is None
        assert next(r for r in got if not r.tap_id)._rescued_data == "{broken"


def test_late_rows_read_each_batch_once(spark):
    """A batch without late rows is one pass, a restart goes on from the newest mark, null times are in time, and a side may be empty."""
    import datetime as dt

    def land(path, first, hours):
        rows = [(first + i, None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for i, h in enumerate(hours)]
        df = spark.createDataFrame(rows, "tap_id long, tap_timestamp_utc timestamp")
        df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(dt.datetime(2024, 1, 1)).alias(f.name)
                         if f.name == "ingest_timestamp_utc" else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in S.BRONZE_SCHEMA.fields])
        return S.land_by_arrival(df, path, files=1)

    def ids(path):
        return sorted(r[0] for r in spark.read.schema(S.BRONZE_SCHEMA).parquet(path).select("tap_id").collect())

    path = land(None, 0, [0, 10, None])
    sink = S.scratch_path(spark, "late-test")
    good, late, q = S.stream_late_rows(spark, path, sink, files_per_trigger=1)
    assert ids(good) == [0, 1, 2] and ids(late) == []
    land(path, 10, [None])
    land(path, 20, [7, 8, 30])
    land(path, 30, [27, 28, 5])
    good, late, q = S.stream_late_rows(spark, path, sink, files_per_trigger=1)
    assert ids(good) == [0, 1, 2, 10, 21, 22, 31] and ids(late) == [20, 30, 32]
    # the source's rows: once for a batch, and again for one with late rows
    assert [p.numInputRows for p in q.recentProgress] == [1, 6, 6]


def test_stream_upsert_rewrites_no_more_than_arrives(spark, monkeypatch):
    """Many batches for one date: the merges write a few times the rows that arrived, the newest version of a tap wins
    in whatever order versions come, nothing stays set aside, and a run that fails keeps the batches before."""
    import datetime as dt
    import os

    import pytest

    from railyard.operators import loads as L
    from railyard.session import checkpoint_dir

    def land(path, versions, fare_class="adult"):
        rows = [(i, 1, 1, 1, fare_class, "TAP_ON", dt.datetime(2024, 1, 1), "reader-1-1", f"v{v}",
                 dt.datetime(2024, 1, 1) + dt.timedelta(hours=v)) for i, v in versions]
        df = spark.createDataFrame(rows, "tap_id long, card_token long, station_id int, zone int, fare_class string, tap_type string,"
                                   "tap_timestamp_utc timestamp, device_id string, schema_version string, ingest_timestamp_utc timestamp")
        df = df.withColumn("fare_amount_cad", F.lit(1).cast("decimal(18,2)"))
        return S.land_by_arrival(df.select(*[F.col(f.name).cast(f.dataType) for f in S.BRONZE_SCHEMA.fields]), path, files=1)

    def stored(table):
        return {r.tap_id: r.schema_version for r in spark.table(table).collect()}, spark.table(table).count()

    written, real = [], L._stage

    def spy(df, name):
        staged, path = real(df, name)
        if name.endswith("-stage"):
            written.append(staged.count())
        return staged, path

    monkeypatch.setattr(L, "_stage", spy)
    stations = spark.createDataFrame([(1, 1)], "station_id int, line_id int")
    good = C.FARE_CLASSES[0]
    path = land(None, [(i, 1) for i in range(20)], good)
    for n in range(1, 8):  # each brings 19 new taps and a version of tap 0; of these the second is the newest
        land(path, [(20 * n + i, 1) for i in range(1, 20)] + [(0, 9 - n)], good)
    newest = {n: "v1" for n in range(160) if n % 20 or not n} | {0: "v8"}
    for rows_per_task, most in ((5, 3 * 160), (L.ROWS_PER_TASK, 160)):
        monkeypatch.setattr(L, "ROWS_PER_TASK", rows_per_task)
        written.clear()
        table, _ = S.stream_upsert(spark, path, stations, files_per_trigger=1)
        assert stored(table) == (newest, 153)
        assert 0 < sum(written) <= most
        left = os.listdir(os.path.join(checkpoint_dir(spark), "railyard-stage"))
        assert [f for f in left if f.startswith(table)] == []
    # batch 9 ends the query: the batches before it are in the table
    land(path, [(500, 1)], "no such class")
    table = L.new_table_name("t_stream")
    with pytest.raises(Exception, match="valid_fare_class"):
        S.stream_upsert(spark, path, stations, table, files_per_trigger=1)
    assert stored(table)[1] == 153
