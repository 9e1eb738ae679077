"""Reference scans (S13-S16), contracts (Q9), JSON rescue (S4), P9 stamp."""
import json

import pytest
from pyspark.sql import functions as F

from railyard.operators import marts, quality as Q
from railyard.session import scratch_path
from railyard.sources import bronze as BR, reference as RF
from tests.conftest import SMOKE


def test_station_csv_required_events_optional(spark):
    root = scratch_path(spark, "ref")
    st = spark.createDataFrame([("A", "Alpha", "N-Q", 40.7, -73.9, 0.6, "nyc"), ("B", "Beta", "R", 40.8, -73.8, 0.6, "nyc")],
                               "station_id string, name string, line string, latitude double, longitude double, "
                               "ridership_prior double, network string")
    RF.write_network_stations(st, root)
    got = RF.renormalise_priors(RF.load_networks(spark, root, ["nyc"])).collect()
    assert len(got) == 2 and sum(r.prior_normalised for r in got) == pytest.approx(1.0)
    with pytest.raises(FileNotFoundError):
        RF.load_stations(spark, root, "nowhere")
    assert RF.load_events(spark, root, "nyc").count() == 0


def test_calendar_json_and_missing(spark, tmp_path):
    p = tmp_path / "cal.json"
    p.write_text(json.dumps([{"name": "E", "start": "2024-01-10T18:00:00", "end": "2024-01-10T23:00:00",
                              "station_ids": ["A", "B"], "uplift_multiplier": 2.5}]))
    cal = RF.load_calendar(spark, str(p)).collect()
    assert cal[0].station_ids == ["A", "B"] and cal[0].start_ts.hour == 18
    assert RF.load_calendar(spark, str(tmp_path / "none.json")).count() == 0


def test_contract_on_silver_schema(spark):
    from railyard.plans.q_core import silver_of
    s = silver_of(spark, SMOKE)
    contract = [("tap_id", "bigint", True), ("date_key", "int", True), ("tap_hour_utc", "timestamp", True),
                ("fare_amount_cad", "decimal(18,2)", True)]
    assert Q.contract_diff(s, contract) == []


def test_rescue_paths(spark):
    msgs = spark.createDataFrame([('{"tap_id": 1, "tap_type": "TAP_ON"}',), ('{"tap_id": 2, "extra": 5}',), ("#bad",)],
                                 "value string")
    r = {row.rescue_reason: row for row in BR.decode_with_rescue(msgs).collect()}
    assert r["ok"].tap_id == 1 and r["ok"]._rescued_data is None
    assert r["extra_keys"].tap_id == 2 and json.loads(r["extra_keys"]._rescued_data) == {"extra": "5"}
    assert r["malformed"].tap_id is None and r["malformed"]._rescued_data == "#bad"


def test_materialized_stamp_is_separate(spark):
    df = marts.stamp_materialized(spark.range(2))
    assert "_materialized_at" in df.columns and df.filter(F.col("_materialized_at").isNull()).count() == 0


def test_clustered_files_hold_disjoint_ranges(spark):
    from railyard.plans.q_core import silver_of
    path = BR.write_clustered(silver_of(spark, SMOKE), scratch_path(spark, "clu"), partitions=4)
    ranges = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
              .agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).orderBy("a").collect())
    for x, y in zip(ranges, ranges[1:]):
        assert x.b <= y.a
