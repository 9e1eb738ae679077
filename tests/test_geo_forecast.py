"""Events, nearest station, forecasts: the reference's assertions."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from railyard.operators import forecast as R, geo
from railyard.sources import binding as B
from tests.conftest import SMOKE


def _hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    dphi, dl = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
    h = math.sin(dphi / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def test_nearest_station_matches_brute_force(spark):
    rnd = random.Random(7)
    st = [(i, 43.0 + rnd.random() * 0.5, -79.5 + rnd.random() * 0.5) for i in range(30)]
    pts = [(i, 42.5 + rnd.random() * 1.5, -80.0 + rnd.random() * 1.5) for i in range(300)]
    pts += [(1000, -33.9, 151.2), (1001, 89.9, 179.99), (1002, 43.2, -79.2)]   # far away, pole, inside
    sdf = spark.createDataFrame(st, "station_id int, lat double, lon double")
    pdf = spark.createDataFrame(pts, "point_id long, lat double, lon double")
    got = {r.point_id: r.station_id for r in geo.nearest_station(pdf, sdf).collect()}
    assert len(got) == len(pts)
    for pid, la, lo in pts:
        want = min(st, key=lambda s: (_hav((la, lo), (s[1], s[2])), s[0]))[0]
        assert got[pid] == want, pid


def test_nearest_station_far_away_and_across_the_date_line(spark):
    rnd = random.Random(11)
    st = [(i, rnd.uniform(-20, 20), ((180 + rnd.uniform(-3, 3) + 180) % 360) - 180) for i in range(40)]
    st += [(100 + i, 60 + rnd.random(), rnd.uniform(-0.5, 0.5)) for i in range(60)] + [(300, -90.0, 17.0)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(400)]
    pts += [(1000 + i, rnd.uniform(-5, 5), x) for i, x in enumerate((179.999, -179.999, 180.0, -180.0, 179.2, -178.8))]
    pts += [(2000, 90.0, 0.0), (2001, -90.0, 55.0), (2002, 60.5, 0.0)]
    sdf = spark.createDataFrame([*st, (400, None, 1.0)], "station_id int, lat double, lon double")
    pdf = spark.createDataFrame([*pts, (3000, None, None)], "point_id long, lat double, lon double")
    for rings in (geo.RINGS, ()):  # also by the tree alone
        got = {r.point_id: (r.station_id, r.distance_km) for r in geo.nearest_station(pdf, sdf, rings).collect()}
        assert set(got) == {p[0] for p in pts}
        for pid, la, lo in pts:
            best = min(_hav((la, lo), s[1:]) for s in st)
            assert got[pid][1] == pytest.approx(best, abs=1e-6)
            assert _hav((la, lo), next(s[1:] for s in st if s[0] == got[pid][0])) == pytest.approx(best, abs=1e-6)
    assert geo.nearest_station(pdf, sdf.limit(0)).count() == 0


def test_far_points_open_few_cells(spark):
    """Points 10,000 km off a network of 3,000 stations meet few of them."""
    rnd = random.Random(5)
    st = spark.createDataFrame([(i, 43 + rnd.random() * 2, -80 + rnd.random() * 2) for i in range(3000)],
                               "station_id int, lat double, lon double")
    pts = spark.createDataFrame([(i, -30 - i / 10, 140 + i / 10) for i in range(50)],
                                "point_id long, lat double, lon double")
    seen = []
    real = geo._nearest_of
    geo._nearest_of = lambda pairs: seen.append(pairs.count()) or real(pairs)
    try:
        assert geo.nearest_station(pts, st, ()).count() == 50
    finally:
        geo._nearest_of = real
    assert seen[-1] < 50 * 3000 / 10


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_interval_join_equals_all_pairs(spark, threshold):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)

    def spans(n, longest):
        out = []
        for i in range(n):
            s = base + dt.timedelta(seconds=rnd.randrange(4 * 86400))
            out.append((i, rnd.randrange(3), s, s + dt.timedelta(seconds=rnd.randrange(-60, longest))))
        return out

    a, b = spans(120, 20 * 3600), spans(150, 9000)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        left = spark.createDataFrame(a, "a int, station_id int, s timestamp, e timestamp")
        right = spark.createDataFrame(b, "b int, station_id int, s2 timestamp, e2 timestamp")
        got = sorted((r.a, r.b) for r in geo.interval_join(left, right, ["station_id"], ("s", "e"), ("s2", "e2")).collect())
        assert got == sorted((x[0], y[0]) for x in a for y in b
                             if x[1] == y[1] and max(x[2], y[2]) <= min(x[3], y[3]) and x[2] <= x[3] and y[2] <= y[3])
        got = sorted((r.a, r.b) for r in geo.interval_join(left, right, ["station_id"], ("s", "s"), ("s2", "e2")).collect())
        assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and y[2] <= x[2] <= y[3])
    finally:
        spark.conf.set(key, before)


def test_event_window_bounds_closed_and_station_scoped(spark):
    cal = B.event_calendar(spark)
    rows = [(3, "2024-01-10 18:00:00"), (3, "2024-01-10 23:00:00"), (3, "2024-01-10 23:00:01"),
            (4, "2024-01-10 20:00:00"), (7, "2024-01-20 17:00:00")]
    sh = spark.createDataFrame(rows, "station_id int, s string").withColumn("tap_hour_utc", F.to_timestamp("s"))
    hits = geo.event_hours(sh, cal).collect()
    got = sorted((r.station_id, r.tap_hour_utc.isoformat(), r.event_id) for r in hits)
    assert got == [(3, "2024-01-10T18:00:00", "E1"), (3, "2024-01-10T23:00:00", "E1"),
                   (7, "2024-01-20T17:00:00", "E2"), (7, "2024-01-20T17:00:00", "E3")]


def test_overlapping_events_multiply(spark):
    cal = B.event_calendar(spark)
    sh = spark.createDataFrame([(7, "2024-01-20 17:00:00")], "station_id int, s string") \
              .withColumn("tap_hour_utc", F.to_timestamp("s"))
    hits = geo.event_hours(sh, cal)
    m = hits.groupBy().agg(F.exp(F.sum(F.log("uplift_multiplier")))).first()[0]
    assert m == pytest.approx(2.8 * 3.5)


def _requests(spark, rows):
    return spark.createDataFrame(rows, "station_id string, horizon_hours int") \
                .withColumn("as_of", F.lit("2024-03-01 05:00:00").cast("timestamp"))


def test_forecast_points_and_bounds(spark):
    ok, bad = R.validate_requests(_requests(spark, [("union", 24), ("x", 0), ("y", 999), ("bad id", 5)]))
    assert sorted(r.station_id for r in bad.collect()) == ["BAD ID", "X", "Y"]
    pts = R.forecast_points(ok).collect()
    assert len(pts) == 24 and {p.station_id for p in pts} == {"UNION"}
    for p in pts:
        assert p.pi_lower_80 <= p.predicted_ridership <= p.pi_upper_80
    seed = sum(map(ord, "UNION")) % 100 + 25
    first = min(pts, key=lambda p: p.ts)
    assert first.ts == dt.datetime(2024, 3, 1, 5, 0)
    assert first.predicted_ridership == int(seed * 0.5 * 100)


def test_forecast_truncates_like_doubles(spark):
    # 3500 * 1.15 is 4024.999... in doubles: int() gives 4024
    df = spark.range(1).select(F.floor(F.lit(3500) * F.lit(1.15)).cast("int").alias("v"))
    assert df.first().v == int(3500 * 1.15) == 4024


def test_overlap_totals_equal_the_sums_of_the_pairs(spark):
    """Also with spans over midnight and several days, instants, repeated ids, and spans that match nothing."""
    rnd = random.Random(5)

    def side(n, name, start, end):
        rows = [(7, 1, None, None), (7, 1, dt.datetime(2024, 1, 2), None)]
        for _ in range(n):
            a = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 6 * 1440, 5))
            rows.append((rnd.randrange(n // 2), rnd.choice([1, 2, None]), a,
                         a + dt.timedelta(minutes=rnd.choice([-10, 0, 0, 5, 30, 200, 1500, 4000]))))
        return spark.createDataFrame(rows, f"{name} long, station_id int, {start} timestamp_ntz, {end} timestamp_ntz")

    w, v = side(60, "w_id", "w_start", "w_end"), side(80, "v_id", "v_start", "v_end")
    for seconds in (3600, 5000):
        args = (["station_id"], ("w_start", "w_end"), ("v_start", "v_end"))
        got = geo.overlap_totals(w, v, *args, "w_id", "v_id", seconds)
        want = geo.interval_join(w, v, *args, seconds).groupBy("station_id", F.to_date("w_start").alias("day")).agg(
            F.count("*").alias("pairs"), F.countDistinct("w_id").alias("lefts"), F.countDistinct("v_id").alias("rights"),
            F.min(F.greatest("w_start", "v_start")).alias("first"))
        rows = sorted(map(tuple, got.collect()))
        assert rows == sorted(map(tuple, want.collect())) and len(rows) > 8


def test_window_overlaps_forms_no_pairs(spark, monkeypatch):
    """Windows meet visits as one span per station and day."""
    import __spark_entry__ as E
    sides, real = [], geo.interval_join
    monkeypatch.setattr(geo, "interval_join", lambda left, *a: sides.append(left.count()) or real(left, *a))
    got = E.queries()["window_overlaps"](spark, SMOKE)
    days = spark.read.parquet(f"{SMOKE}/events.parquet").select(F.to_date("ts")).distinct().count()
    assert got.agg(F.sum("pairs")).first()[0] > 0
    assert sides and max(sides) <= 4 * days
