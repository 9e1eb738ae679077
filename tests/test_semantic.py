"""Time intelligence on hand-made daily frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from railyard.operators import semantic as S


def _daily(spark, rows):
    return spark.createDataFrame(rows, "service_date date, taps long")


def test_prior_year_one_row_per_day_around_leap_day(spark):
    d = dt.date
    rows = [(d(2023, 2, 28), 10), (d(2024, 2, 28), 20), (d(2024, 2, 29), 30), (d(2025, 2, 28), 40)]
    out = {r.service_date: r.prior_year_value for r in S.prior_year(_daily(spark, rows), "taps").collect()}
    assert len(out) == 4
    assert out[d(2024, 2, 28)] == 10.0 and out[d(2024, 2, 29)] == 10.0   # 29 Feb looks back to 28 Feb
    assert out[d(2025, 2, 28)] == 20.0 and out[d(2023, 2, 28)] is None


def test_to_date_running_resets_per_period(spark):
    d = dt.date
    rows = [(d(2024, 3, 30), 1), (d(2024, 3, 31), 2), (d(2024, 4, 1), 4), (d(2025, 1, 1), 8)]
    r = {x.service_date: (x.mtd, x.qtd, x.ytd) for x in S.to_date_running(_daily(spark, rows), "taps").collect()}
    assert r[d(2024, 3, 31)] == (3.0, 3.0, 3.0)
    assert r[d(2024, 4, 1)] == (4.0, 4.0, 7.0)
    assert r[d(2025, 1, 1)] == (8.0, 8.0, 8.0)


def test_prior_period_fills_gaps(spark):
    d = dt.date
    rows = [(d(2024, 1, 5), 5), (d(2024, 3, 5), 7)]
    r = [(x.month_start, x.value, x.prior_value) for x in S.prior_period(_daily(spark, rows), "taps").orderBy("month_start").collect()]
    assert r == [(d(2024, 1, 1), 5.0, None), (d(2024, 2, 1), 0.0, 5.0), (d(2024, 3, 1), 7.0, 0.0)]


def test_kafka_source_is_gated(spark):
    from railyard.streaming import taps
    with pytest.raises(Exception, match="(?i)kafka"):
        taps.read_kafka_stream(spark, "localhost:9092", "taps")


def test_exact_riders_meet_by_rider(spark, monkeypatch):
    """Exact riders at every grain: the cells of a rider are never exchanged, and the counts are those of plain groups."""
    import contextlib
    import io

    from railyard.operators import gold
    monkeypatch.setattr(gold, "TAPS_PER_TASK", 100, raising=False)
    taps = spark.range(1500).selectExpr(
        "timestamp'2024-01-28 00:00:00' + make_interval(0, 0, 0, 0, CAST(id * 7 % 120 AS INT)) AS tap_hour_utc",
        "CAST(id % 6 AS INT) AS station_id", "CAST(id % 3 AS INT) AS line_id", "CAST(nullif(id % 3, 2) AS INT) AS zone",
        "nullif(id * 13 % 97, 5) AS card_token")
    got = gold.exact_riders_at_any_grain(taps)
    rows = {tuple(r)[:4]: r["riders"] for r in got.collect()}
    for grain in gold.RIDER_GRAINS:
        for s in gold.SLICES:
            value = F.col(s).cast("string") if s else F.lit("all")
            plain = taps.groupBy(F.date_trunc(grain, "tap_hour_utc"), value).agg(F.countDistinct("card_token")).collect()
            assert {(grain, r[0], s or "all", r[1]): r[2] for r in plain} == {
                k: n for k, n in rows.items() if k[0] == grain and k[2] == (s or "all")}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    above = buf.getvalue().split("Initial Plan")[-1].split("Generate explode")[0]
    assert not [line for line in above.splitlines() if "Exchange" in line and "card_token" in line]
