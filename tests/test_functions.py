"""Pure column functions: properties carried over from the reference tests."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from railyard.functions import columns as X

TIMES_SQ = (40.7580, -73.9855)
GRAND_CENTRAL = (40.7527, -73.9772)
UNION = (43.6453, -79.3806)


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_haversine_zero_symmetric_known_pair(spark):
    a, b = TIMES_SQ, GRAND_CENTRAL
    assert _one(spark, X.haversine_km(F.lit(a[0]), F.lit(a[1]), F.lit(a[0]), F.lit(a[1]))) == pytest.approx(0.0, abs=1e-9)
    ab = _one(spark, X.haversine_km(F.lit(a[0]), F.lit(a[1]), F.lit(b[0]), F.lit(b[1])))
    ba = _one(spark, X.haversine_km(F.lit(b[0]), F.lit(b[1]), F.lit(a[0]), F.lit(a[1])))
    assert ab == pytest.approx(ba)
    assert 0.8 <= ab <= 1.2


def test_haversine_triangle_inequality(spark):
    pts = [TIMES_SQ, GRAND_CENTRAL, UNION]
    d = {}
    for i, p in enumerate(pts):
        for j, q in enumerate(pts):
            d[i, j] = _one(spark, X.haversine_km(F.lit(p[0]), F.lit(p[1]), F.lit(q[0]), F.lit(q[1])))
    assert d[0, 2] <= d[0, 1] + d[1, 2] + 1e-9


def test_demand_curve_peaks_and_trough(spark):
    rows = spark.range(24).select(F.col("id").alias("h"), X.demand_curve(F.col("id")).alias("c")).collect()
    c = {r.h: r.c for r in rows}
    assert all(v > 0 for v in c.values())
    assert max(c, key=c.get) in (8, 17)
    # The coded curve bottoms out at hour 0 (0.0800 vs 0.0812 at 02:00); the
    # claim "trough at 2-4" does not hold for the formula itself, so the
    # property checked is "trough in the small hours".
    assert min(c, key=c.get) in (0, 1, 2, 3, 4)


def test_calendar_keys(spark):
    ts = F.lit("2024-01-07 15:42:00").cast("timestamp")   # a Sunday
    assert _one(spark, X.date_key(ts)) == 20240107
    assert _one(spark, X.dow_sunday0(ts)) == 0
    assert _one(spark, X.iso_dow(F.to_date(ts))) == 7
    assert _one(spark, X.is_weekend(F.to_date(ts))) is True
    assert _one(spark, X.hour_trunc(ts)) == dt.datetime(2024, 1, 7, 15, 0)


def test_volume_band_thresholds(spark):
    vals = [0, 499, 500, 4999, 5000, 20000, 50000]
    out = spark.createDataFrame([(v,) for v in vals], "t long").select(X.volume_band("t").alias("b")).collect()
    assert [r.b for r in out] == ["very_low", "very_low", "low", "low", "medium", "high", "very_high"]


def test_safe_division_and_zero_guard(spark):
    assert _one(spark, X.safe_div(F.lit(1), F.lit(0))) is None
    assert _one(spark, X.zero_guard_ratio(F.lit(3), F.lit(0))) == 0.0
    assert _one(spark, X.zero_guard_ratio(F.lit(3), F.lit(2))) == 1.5


def test_ord_sum_and_id_rules(spark):
    assert _one(spark, X.ord_sum(F.lit("UNION"))) == sum(map(ord, "UNION"))
    assert _one(spark, X.normalise_id(F.lit("  union "))) == "UNION"
    assert _one(spark, X.id_is_valid(F.lit("UNION"))) is True
    assert _one(spark, X.id_is_valid(F.lit("MIDDLE EAST"))) is False
    assert _one(spark, X.id_is_valid(F.lit("NATION_7"))) is True


def test_schema_version_pattern(spark):
    assert _one(spark, X.schema_version_ok(F.lit("v12"))) is True
    assert _one(spark, X.schema_version_ok(F.lit("1.0.0"))) is False
