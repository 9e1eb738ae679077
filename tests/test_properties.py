"""Property-based checks against brute-force Python on random tap sets:
silver keeps exactly the latest valid version of each tap, the hourly fact
equals a Python group-by, and shuffling the input changes nothing."""
import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from railyard.operators import gold, silver

SCHEMA = ("tap_id long, card_token long, station_id int, zone int, fare_class string, "
          "fare_amount_cad decimal(18,2), tap_type string, tap_timestamp_utc timestamp, device_id string, "
          "schema_version string, ingest_timestamp_utc timestamp")
T0 = dt.datetime(2024, 1, 1)

tap = st.tuples(
    st.integers(0, 15),                       # tap_id (collisions on purpose)
    st.integers(0, 5),                        # card
    st.integers(0, 3),                        # station (3 is unknown)
    st.sampled_from(["ADULT", "SENIOR", "CHILD"]),
    st.integers(0, 900),                      # fare cents
    st.sampled_from(["TAP_ON", "TAP_OFF", "TAP_X"]),
    st.integers(0, 72),                       # event hour offset
    st.integers(0, 5),                        # ingest delay (hours)
)


def _rows(taps):
    return [(t, c, s, 1, fc, Decimal(f) / 100, tt, T0 + dt.timedelta(hours=h, minutes=t),
             "reader-1-1", "v1", T0 + dt.timedelta(hours=h + d, minutes=t))
            for t, c, s, fc, f, tt, h, d in taps]


def _expected_silver(rows):
    valid = [r for r in rows if r[6] in ("TAP_ON", "TAP_OFF") and r[2] in (0, 1, 2)]
    best = {}
    for r in valid:
        key = (r[10], r[5], r[7], r[1], r[2], r[4], r[6], r[8], r[3], r[9])   # DEDUP_ORDER
        if r[0] not in best or key > best[r[0]][0]:
            best[r[0]] = (key, r)
    return {k: v[1] for k, v in best.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tap, min_size=1, max_size=40))
def test_silver_and_fact_match_brute_force(spark, taps):
    rows = _rows(taps)
    stations = spark.createDataFrame([(i, f"S{i}", 10 + i, 1, 43.0, -79.0) for i in range(3)],
                                     "station_id int, name string, line_id int, zone int, lat double, lon double")
    df = spark.createDataFrame(rows, SCHEMA)
    s = silver.build_silver(df, stations)
    got = {r.tap_id: r for r in s.collect()}
    want = _expected_silver(rows)
    assert set(got) == set(want)
    for k, r in want.items():
        assert got[k].fare_amount_cad == r[5] and got[k].ingest_timestamp_utc == r[10]
    # hourly fact against a Python group-by
    agg = defaultdict(lambda: [0, 0, set(), Decimal(0)])
    for r in want.values():
        h = r[7].replace(minute=0, second=0, microsecond=0)
        a = agg[(h, r[2])]
        a[0] += r[6] == "TAP_ON"
        a[1] += 1
        a[2].add(r[1])
        a[3] += r[5]
    fact = {(r.tap_hour_utc, r.station_id): r for r in gold.fact_ridership_hourly(s).collect()}
    assert set(fact) == set(agg)
    for k, (on, n, cards, fare) in agg.items():
        f = fact[k]
        assert (f.tap_on_count, f.total_taps, f.unique_riders) == (on, n, len(cards))
        assert abs(f.total_fare_cad - float(fare)) < 1e-9
    # order-insensitive: a shuffled input gives the same silver
    again = {r.tap_id: r.fare_amount_cad for r in silver.build_silver(df.repartition(4).sortWithinPartitions("card_token"), stations).collect()}
    assert again == {k: v.fare_amount_cad for k, v in got.items()}


batch = st.lists(st.tuples(st.integers(0, 8), st.integers(1, 4)), min_size=1, max_size=8,
                 unique_by=lambda t: t[0])      # one row per key within a batch


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(batch, min_size=1, max_size=3))
def test_upsert_sequence_equals_last_write_wins(spark, batches):
    from railyard.operators import loads as L
    t = L.new_table_name("t_prop")
    model = {}
    for i, b in enumerate(batches):
        rows = [(k, f"v{i}", d) for k, d in b]
        L.upsert(spark, t, spark.createDataFrame(rows, "tap_id long, v string, date_key int"), "tap_id", "date_key")
        for k, v, d in rows:
            model[k] = (k, v, d)
    got = sorted(tuple(r) for r in spark.table(t).select("tap_id", "v", "date_key").collect())
    assert got == sorted(model.values())
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()}
    assert parts == {f"date_key={d}" for _, _, d in model.values()}     # no empty partition left
