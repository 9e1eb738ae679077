"""Silver: latest-wins dedup, quarantine reasons, expectations."""
import datetime as dt

import pytest

from railyard.operators import silver

T0 = dt.datetime(2024, 1, 1, 8, 0)
COLS = ("tap_id long, card_token long, station_id int, zone int, fare_class string, "
        "fare_amount_cad decimal(18,2), tap_type string, tap_timestamp_utc timestamp, device_id string, "
        "schema_version string, ingest_timestamp_utc timestamp")


def _tap(tap_id, station=1, tap_type="TAP_ON", fare="6.05", ingest=T0, fare_class="ADULT"):
    from decimal import Decimal
    return (tap_id, 7, station, 1, fare_class, Decimal(fare), tap_type, T0, "reader-1-1", "v1", ingest)


@pytest.fixture
def stations(spark):
    return spark.createDataFrame([(1, "A", 10, 1, 43.0, -79.0), (2, "B", 11, 1, 43.1, -79.1)],
                                 "station_id int, name string, line_id int, zone int, lat double, lon double")


def test_latest_ingest_wins(spark, stations):
    rows = [_tap(1, fare="1.00", ingest=T0), _tap(1, fare="2.00", ingest=T0 + dt.timedelta(hours=1)),
            _tap(2, fare="3.00")]
    out = silver.build_silver(spark.createDataFrame(rows, COLS), stations).orderBy("tap_id").collect()
    assert [(r.tap_id, float(r.fare_amount_cad)) for r in out] == [(1, 2.0), (2, 3.0)]
    assert out[0].line_id == 10 and out[0].date_key == 20240101


def test_ties_broken_deterministically(spark, stations):
    rows = [_tap(1, fare="1.00"), _tap(1, fare="5.00"), _tap(1, fare="3.00")]
    for _ in range(3):
        df = spark.createDataFrame(rows, COLS).repartition(3)
        assert float(silver.build_silver(df, stations).first().fare_amount_cad) == 5.0


def test_quarantine_reasons(spark, stations):
    rows = [_tap(1), _tap(2, tap_type="TAP_X"), _tap(3, station=99), _tap(None), _tap(4, station=99, tap_type=None)]
    q = {r.tap_id: r.reasons for r in silver.quarantine(spark.createDataFrame(rows, COLS), stations).collect()}
    assert q == {2: "bad_tap_type", 3: "unknown_station", None: "tap_id_null",
                 4: "bad_tap_type,unknown_station"}
    kept = silver.build_silver(spark.createDataFrame(rows, COLS), stations)
    assert [r.tap_id for r in kept.collect()] == [1]


def test_expect_or_fail_on_fare_class(spark, stations):
    df = spark.createDataFrame([_tap(1, fare_class="EMPLOYEE")], COLS)
    with pytest.raises(Exception, match="valid_fare_class"):
        silver.build_silver(df, stations).collect()


def test_observed_run_metrics(spark, stations):
    rows = [_tap(1), _tap(2, tap_type="TAP_X"), _tap(3, station=99), _tap(1, fare="9.00")]
    tagged, obs = silver.observed_tags(spark.createDataFrame(rows, COLS), stations)
    tagged.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows_in": 4, "rows_kept": 2, "rows_quarantined": 2}


def test_hourly_preagg_approx_close_to_exact(spark):
    from pyspark.sql import functions as F
    from railyard.operators import gold
    from railyard.plans.q_core import silver_of
    from tests.conftest import SF01
    s = silver_of(spark, SF01)
    approx = gold.hourly_preagg(s, with_approx=True)
    exact = s.groupBy("tap_hour_utc", "station_id", "fare_class", "tap_type").agg(
        F.countDistinct("card_token").alias("exact"))
    j = approx.join(exact, ["tap_hour_utc", "station_id", "fare_class", "tap_type"])
    worst = j.agg(F.max(F.abs(F.col("unique_riders_approx") - F.col("exact")) / F.col("exact"))).first()[0]
    assert j.count() == approx.count() and worst <= 0.15
