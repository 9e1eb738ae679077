"""Keyed state: batches, verdicts, restarts; field-wise decoding of messages."""
import json
import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.sources import drift as D
from railyard.streaming import keyed as K
from railyard.streaming import taps as S


def test_batches_close_by_rows_or_time():
    rnd = random.Random(3)
    for limit, span in ((5, 100), (3, 10), (1, 50), (500, 40)):
        arrived = np.sort(np.array([rnd.randrange(1000) for _ in range(200)]))
        # one by one, the plain way
        want, closed, batch, rows, opened = [], [], 0, 0, 0
        for a in arrived:
            if rows and (rows >= limit or a - opened >= span):
                closed.append((batch, rows))
                batch, rows = batch + 1, 0
            opened = opened if rows else a
            want.append(batch)
            rows += 1
        if rows >= limit:
            closed.append((batch, rows))
            batch, rows = batch + 1, 0
        got = K.number_batches(arrived, 0, 0, 0, limit, span)
        assert got[0].tolist() == want and got[1] == closed and got[2:4] == (batch, rows)
        # in two pieces, as two micro-batches
        cut = rnd.randrange(200)
        a = K.number_batches(arrived[:cut], 0, 0, 0, limit, span)
        b = K.number_batches(arrived[cut:], *a[2:], limit, span)
        assert a[0].tolist() + b[0].tolist() == want and a[1] + b[1] == closed


def test_first_of():
    assert K.first_of(np.array([3, 9]), np.array([9, 4, 4, 1, 3, 1])).tolist() == [False, True, False, True, False, False]
    assert K.first_of(np.zeros(0, int), np.array([2, 2])).tolist() == [True, False]


def test_every_row_has_one_verdict_after_a_restart(spark):
    """Duplicates within and across runs, forgotten ids, late rows, null ids and times."""
    rows = [  # tap, event minute, arrival minute, expected
        (1, 0, 0, "kept"), (1, 0, 1, "duplicate"), (2, 1, 1, "kept"), (None, 2, 2, "kept"), (None, 2, 3, "duplicate"),
        (3, None, 4, "kept"), (4, 290, 300, "kept"), (5, 299, 301, "kept")]
    second = [  # the watermark stands at minute 301
        (1, 0, 302, "late"), (2, 250, 303, "kept"), (4, 290, 304, "duplicate"), (6, 181, 305, "kept"),
        (7, 180, 306, "late"), (3, None, 307, "kept")]

    def frame(part, base):
        day = 1_700_000_000
        out = spark.createDataFrame([(t, None if e is None else day + e * 60, day + a * 60, base + i) for i, (t, e, a, _)
                                     in enumerate(part)], "tap_id bigint, e bigint, a bigint, row bigint")
        return out.select("tap_id", F.timestamp_seconds("e").alias("tap_timestamp_utc"),
                          F.timestamp_seconds("a").alias("ingest_timestamp_utc"), "row")

    from railyard.session import scratch_path
    path = scratch_path(spark, "arrivals-in")

    def run(sink=None):
        schema = "tap_id bigint, tap_timestamp_utc timestamp, ingest_timestamp_utc timestamp, row bigint"
        return K.stream_arrivals(spark, spark.readStream.schema(schema).parquet(path), "row", sink, shards=2, limit=2)[0]

    frame(rows, 0).coalesce(1).write.mode("append").parquet(path)
    sink = run()
    frame(second, 100).coalesce(1).write.mode("append").parquet(path)
    run(sink)
    run(sink)  # nothing new: nothing changes
    out = spark.read.schema(K.VERDICTS).parquet(sink).collect()
    got = {r.row: r.verdict for r in out if r.verdict != "closed"}
    assert got == {i: v for i, (*_, v) in enumerate(rows)} | {100 + i: v for i, (*_, v) in enumerate(second)}
    assert len([r for r in out if r.verdict != "closed"]) == len(got)
    sizes = {}
    for r in out:
        if r.verdict == "kept":
            sizes[r.shard, r.batch] = sizes.get((r.shard, r.batch), 0) + 1
    closed = {(r.shard, r.batch): r.rows for r in out if r.verdict == "closed"}
    assert max(sizes.values()) <= 2 and closed and all(sizes[k] == n for k, n in closed.items())
    assert all(k in closed or k[1] == max(b for s, b in sizes if s == k[0]) for k in sizes)  # only the last is open


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()),
                       T.StructField("big", T.LongType()), T.StructField("x", T.DoubleType()),
                       T.StructField("money", T.DecimalType(18, 2)), T.StructField("tap_timestamp_utc", T.StringType())])
GOOD = {"id": "a", "n": 3, "big": 2 ** 40, "x": 1.5, "money": 2.25, "tap_timestamp_utc": "2026-06-12T20:15:00+00:00"}


def test_one_bad_field_is_rescued_alone(spark):
    cases = [({}, None), ({"n": "3"}, "n"), ({"n": 3.5}, "n"), ({"n": 2 ** 40}, "n"), ({"n": True}, "n"),
             ({"money": 2.255}, "money"), ({"x": "1"}, "x"), ({"tap_timestamp_utc": "soon"}, "tap_timestamp_utc"),
             ({"tap_timestamp_utc": 5}, "tap_timestamp_utc"), ({"id": {"a": 1}}, "id"), ({"more": [1, 2]}, "more"),
             ({"n": None}, None), ({"id": 7}, None), ({"money": 3}, None), ({"n": 4.0}, None), ({"x": 4}, None)]
    msgs = [json.dumps(GOOD | change) for change, _ in cases] + ["[1]", "oops", None]
    out = D.decode_fields(spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i int, value string"), SCHEMA)
    got = out.collect()
    for (change, bad), r in zip(cases, got):
        rescued = json.loads(r._rescued_data) if r._rescued_data else {}
        assert set(rescued) == ({bad} if bad else set()), (change, r)
        for name in GOOD:
            if name != bad and (GOOD | change)[name] is not None:
                assert r[name] is not None, (change, name)
        if bad:
            assert rescued[bad] == change[bad] and (bad not in GOOD or r[bad] is None)
    assert [r._rescued_data for r in got[len(cases):]] == ["[1]", "oops", None]
    assert D.decode_fields(spark.createDataFrame([], "value string"), SCHEMA).count() == 0


def test_report_and_next_schema(spark):
    msgs = [GOOD, GOOD | {"n": 2.5, "new": "x"}, GOOD | {"n": 10 ** 7, "id": 3}, {"big": 5, "new": "y"}]
    df = spark.createDataFrame([(json.dumps(m),) for m in msgs] + [("bad",)], "value string")
    report = {r.field: r for r in D.drift_report(df, SCHEMA).collect()}
    assert {k: r.status for k, r in report.items()} == {
        "id": "mixed", "n": "wider", "big": "as agreed", "x": "as agreed", "money": "as agreed",
        "tap_timestamp_utc": "as agreed", "new": "new"}
    assert report["big"].messages == 4 and report["new"].agreed is None
    schema = D.evolve(SCHEMA, D.drift_report(df, SCHEMA))
    assert isinstance(schema["n"].dataType, T.DecimalType) and schema["new"].dataType == T.StringType()
    out = D.decode_fields(df, schema).collect()
    assert [None if r.n is None else float(r.n) for r in out] == [3.0, 2.5, 1e7, None, None]
    assert [r._rescued_data for r in out] == [None] * 4 + ["bad"]
