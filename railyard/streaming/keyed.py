"""Keyed state: one streaming operator that accounts for every tap.

``sort_arrivals`` gives every input row exactly one verdict:

* ``late``: the tap was made more than the allowed delay before the newest
  arrival of earlier micro-batches;
* ``duplicate``: a tap of the same id is known, and not yet forgotten;
* ``kept``: the first arrival.  Kept rows are numbered into batches that close
  at ``BATCH_ROWS`` rows or ``BATCH_SECONDS`` of arrival time, whichever comes
  first; a timer closes a batch that nothing follows, and each closing is a row
  of its own (``closed``, with the number of rows).

State is kept per shard, a hash of the tap id, so a busy day spreads evenly.
A shard's state is one sorted array of tap hashes with the event times that they
expire by (a tap is forgotten once another of its id would be late), and the
open batch; it is read and written once per shard and micro-batch, never per
row.  Both grow with the taps made within the delay, not with the stream.  The
state lives in RocksDB stores under the query's checkpoint, so a restart goes on
where the last run stopped.

Arrival stamps may be out of order by up to ``SLACK``; a row whose own arrival
stamp lies farther behind the newest one of earlier micro-batches would be
dropped by Spark and shows in ``taps.dropped_by_watermark`` (stamps are set on
arrival, so it cannot happen while files are taken in their order).

Tap ids are known by a 64-bit hash.  A null id is an id of its own, a null event
time is never late and its tap is forgotten like one made on arrival.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from railyard import constants as C
from railyard.session import scratch_path
from railyard.streaming import taps as S

BATCH_ROWS, BATCH_SECONDS = 500, 30
SHARDS = 32
SLACK, SLACK_MS = "1 minute", 60_000
DELAY_MS = int(pd.Timedelta(C.LATE_WATERMARK).total_seconds() * 1000)
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

VERDICTS = "shard int, tap bigint, row bigint, verdict string, batch bigint, rows bigint"


def first_of(known: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """Marks the first row of each tap that is not in the ascending ``known``."""
    first = np.zeros(len(taps), bool)
    first[np.unique(taps, return_index=True)[1]] = True
    if len(known):
        at = np.minimum(np.searchsorted(known, taps), len(known) - 1)
        first &= known[at] != taps
    return first


def number_batches(arrived: np.ndarray, batch: int, rows: int, opened: int, limit: int, span: int):
    """Batches of rows that arrive at ``arrived`` (ascending): (batch of each
    row, [(closed batch, rows)], open batch, its rows, when it opened)."""
    out, closed, i = np.empty(len(arrived), np.int64), [], 0
    while i < len(arrived):
        if rows and (rows >= limit or arrived[i] - opened >= span):
            closed.append((batch, rows))
            batch, rows = batch + 1, 0
        if not rows:
            opened = int(arrived[i])
        upto = min(i + limit - rows, int(np.searchsorted(arrived, opened + span, side="left")))
        out[i:upto] = batch
        rows, i = rows + upto - i, upto
    if rows >= limit:
        closed.append((batch, rows))
        batch, rows = batch + 1, 0
    return out, closed, batch, rows, opened


class Arrivals(StatefulProcessor):
    """Input (shard, tap, row, event_ms, arrived_ms), output ``VERDICTS``."""

    def __init__(self, delay_ms: int = DELAY_MS, limit: int = BATCH_ROWS, span_ms: int = BATCH_SECONDS * 1000):
        self.delay, self.limit, self.span = delay_ms, limit, span_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "taps binary, until binary")
        self.open = handle.getValueState("open", "batch bigint, rows bigint, opened bigint")

    def _out(self, shard, rows) -> pd.DataFrame:
        return pd.DataFrame({"shard": np.full(len(rows["verdict"]), shard, np.int32), **rows})

    def _closed(self, shard, closed) -> pd.DataFrame:
        n = len(closed)
        none = pd.array([None] * n, "Int64")
        return self._out(shard, {"tap": none, "row": none, "verdict": ["closed"] * n,
                                 "batch": pd.array([int(b) for b, _ in closed], "Int64"),
                                 "rows": pd.array([int(r) for _, r in closed], "Int64")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows)).sort_values(["arrived_ms", "row"], kind="stable")
        watermark = max(0, timerValues.getCurrentWatermarkInMs())
        newest = watermark + SLACK_MS if watermark else 0  # arrival of earlier micro-batches
        taps, arrived = df["tap"].to_numpy(np.int64), df["arrived_ms"].to_numpy(np.int64)
        event = df["event_ms"].fillna(df["arrived_ms"]).to_numpy(np.int64)
        late = df["event_ms"].notna().to_numpy() & (event < newest - self.delay)
        state = self.known.get()
        known, until = ((np.frombuffer(state[0], np.int64), np.frombuffer(state[1], np.int64)) if state else
                        (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        stay = until >= newest
        known, until = known[stay], until[stay]
        kept = np.zeros(len(taps), bool)
        kept[~late] = first_of(known, taps[~late])
        known, until = np.append(known, taps[kept]), np.append(until, event[kept] + self.delay)
        order = np.argsort(known, kind="stable")
        self.known.update((known[order].tobytes(), until[order].tobytes()))
        batch, n, opened = self.open.get() or (0, 0, 0)
        numbers = np.full(len(taps), -1, np.int64)
        numbers[kept], closed, batch, n, opened = number_batches(arrived[kept], batch, n, opened, self.limit, self.span)
        self.open.update((int(batch), int(n), int(opened)))
        if n:
            self.handle.registerTimer(int(max(opened + self.span, watermark + 1)))
        verdict = np.where(late, "late", np.where(kept, "kept", "duplicate"))
        yield self._out(key[0], {"tap": taps, "row": df["row"].to_numpy(np.int64), "verdict": verdict,
                                 "batch": pd.array([int(b) if k else None for b, k in zip(numbers, kept)], "Int64"),
                                 "rows": pd.array([None] * len(taps), "Int64")})
        if closed:
            yield self._closed(key[0], closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, n, opened = self.open.get() or (0, 0, 0)
        if n and opened + self.span <= expiredTimerInfo.getExpiryTimeInMs():
            self.open.update((batch + 1, 0, 0))
            yield self._closed(key[0], [(batch, n)])

    def close(self) -> None:
        pass


def _package_path(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.
    Where executors have no such path, ship the package (``--py-files``)."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])


def sort_arrivals(stream: DataFrame, row_col: str, shards: int = SHARDS, **limits) -> DataFrame:
    """Verdicts (``VERDICTS``) of a tap stream; ``row_col`` names a bigint that
    identifies the row.  The watermark follows the arrival clock."""
    clock = F.col("ingest_timestamp_utc")
    tap = F.xxhash64(F.col("tap_id"), F.col("tap_id").isNull())
    rows = (stream.withWatermark("ingest_timestamp_utc", SLACK)
            .select("ingest_timestamp_utc", F.pmod(tap, F.lit(shards)).cast("int").alias("shard"), tap.alias("tap"),
                    F.col(row_col).alias("row"), F.unix_millis("tap_timestamp_utc").alias("event_ms"),
                    F.unix_millis(clock).alias("arrived_ms")))
    return rows.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=Arrivals(**limits), outputStructType=VERDICTS, outputMode="Append", timeMode="EventTime")


def stream_arrivals(spark: SparkSession, stream: DataFrame, row_col: str, sink: str | None = None,
                    **limits) -> tuple[str, object]:
    """Verdicts of a stream in a Parquet sink, drained and checkpointed."""
    sink = sink or scratch_path(spark, "arrivals")
    _package_path(spark)
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        q = S._run(sort_arrivals(stream, row_col, **limits).writeStream.format("parquet").option("path", sink)
                   .outputMode("append"), sink + "-ckpt", spark=spark)
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)
    return sink, q
