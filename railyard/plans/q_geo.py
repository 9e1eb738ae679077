"""Events, geography, expected demand and forecasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X
from railyard.operators import forecast as R, geo, marts
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import _cte, compose
from railyard.plans.q_core import facts_of, silver_of
from railyard.plans.q_dims import hav_sql
from railyard.session import scratch_path
from railyard.sources import binding as B
from railyard.sources import reference as RF
from railyard.sources.tables import read_table


@register("event_interval_join", compose("silver", "calendar_x", """
SELECT c.event_id, s.station_id, COUNT(*) AS event_taps, COUNT(DISTINCT s.card_token) AS event_riders,
       min(s.tap_timestamp_utc) AS first_tap, max(s.tap_timestamp_utc) AS last_tap
FROM silver s JOIN calendar_x c ON s.station_id = c.ev_station
 AND s.tap_timestamp_utc >= c.start_ts AND s.tap_timestamp_utc <= c.end_ts
GROUP BY 1, 2"""), "J6 P8 F25")
def q_event_interval_join(spark, sf_dir):
    return geo.event_interval_join(silver_of(spark, sf_dir), B.event_calendar(spark))


_cte("points", (), """
  SELECT c_custkey AS point_id, CAST(42.8 + (c_custkey % 41) * 0.02 AS DOUBLE) AS lat,
         CAST(-79.0 - (c_custkey % 43) * 0.02 AS DOUBLE) AS lon
  FROM customer""")


@register("nearest_station", compose("points", "stations", f"""
SELECT point_id, station_id, ROUND(d, 6) AS distance_km FROM (
  SELECT p.point_id, s.station_id, {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')} AS d,
         ROW_NUMBER() OVER (PARTITION BY p.point_id ORDER BY {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')}, s.station_id) AS rn
  FROM points p, stations s) WHERE rn = 1"""), "J7 O2 N6 F15")
def q_nearest_station(spark, sf_dir):
    pts = geo.customer_points(read_table(spark, sf_dir, "customer", ["c_custkey"]))
    n = geo.nearest_station(pts, B.stations(spark, sf_dir))
    return n.select("point_id", "station_id", X.r6("distance_km").alias("distance_km"))


_WORLD = """(SELECT c_custkey AS point_id, CAST((c_custkey * 7919) % 179999 AS DOUBLE) / 1000 - 90 AS lat,
         CAST((c_custkey * 104729) % 360001 AS DOUBLE) / 1000 - 180 AS lon FROM customer)"""
_DATE_LINE = """(SELECT station_id, lat, CASE WHEN e > 180 THEN e - 360 ELSE e END AS lon FROM (
         SELECT s_suppkey AS station_id, CAST((s_suppkey * 6007) % 150001 AS DOUBLE) / 1000 - 75 AS lat,
                CASE WHEN s_suppkey % 3 = 0 THEN CAST((s_suppkey * 15013) % 90001 AS DOUBLE) / 1000
                     ELSE 178 + CAST((s_suppkey * 3571) % 4001 AS DOUBLE) / 1000 END AS e FROM supplier))"""


@register("nearest_world", f"""
SELECT point_id, station_id, ROUND(d, 6) AS distance_km FROM (
  SELECT p.point_id, s.station_id, {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')} AS d,
         ROW_NUMBER() OVER (PARTITION BY p.point_id ORDER BY {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')}, s.station_id) AS rn
  FROM {_WORLD} p, {_DATE_LINE} s) WHERE rn = 1""", "J7 N6 F15")
def q_nearest_world(spark, sf_dir):
    """Points all over the earth, most far from any station; two thirds of the
    stations lie on both sides of the antimeridian."""
    read_table(spark, sf_dir, "customer", ["c_custkey"]).createOrReplaceTempView("_world_customers")
    read_table(spark, sf_dir, "supplier", ["s_suppkey"]).createOrReplaceTempView("_world_suppliers")
    points = spark.sql("SELECT * FROM " + _WORLD.replace("FROM customer", "FROM _world_customers"))
    stations = spark.sql("SELECT * FROM " + _DATE_LINE.replace("FROM supplier", "FROM _world_suppliers"))
    n = geo.nearest_station(points, stations)
    return n.select("point_id", "station_id", X.r6("distance_km").alias("distance_km"))


@register("window_overlaps", """
WITH w AS (SELECT event_id, event_id % 4 AS station_id, ts AS w_start, ts + to_minutes(user_id % 7 * 20) AS w_end
           FROM events WHERE event_id % 8 < 4),
v AS (SELECT event_id AS visit_id, event_id % 4 AS station_id, ts AS v_start, ts + to_minutes(user_id % 5 * 10) AS v_end
      FROM events WHERE event_id % 8 >= 4)
SELECT w.station_id, CAST(w_start AS DATE) AS service_date, COUNT(*) AS pairs, COUNT(DISTINCT event_id) AS windows,
       COUNT(DISTINCT visit_id) AS visits, min(greatest(w_start, v_start)) AS first_overlap
FROM w JOIN v ON w.station_id = v.station_id AND w_start <= v_end AND v_start <= w_end GROUP BY ALL""", "J6 N5")
def q_window_overlaps(spark, sf_dir):
    """Service windows and visits, thousands of each at one of four stations."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id"])
    station = (F.col("event_id") % 4).alias("station_id")

    def until(n, minutes):
        return F.expr(f"ts + make_interval(0, 0, 0, 0, 0, CAST(user_id % {n} * {minutes} AS INT))")

    windows = ev.where("event_id % 8 < 4").select("event_id", station, F.col("ts").alias("w_start"),
                                                  until(7, 20).alias("w_end"))
    visits = ev.where("event_id % 8 >= 4").select(F.col("event_id").alias("visit_id"), station,
                                                  F.col("ts").alias("v_start"), until(5, 10).alias("v_end"))
    met = geo.overlap_totals(windows, visits, ["station_id"], ("w_start", "w_end"), ("v_start", "v_end"),
                             "event_id", "visit_id", 3600)
    return met.select("station_id", F.col("day").alias("service_date"), "pairs", F.col("lefts").alias("windows"),
                      F.col("rights").alias("visits"), F.col("first").alias("first_overlap"))


@register("km_haversine", compose("points", f"""
SELECT point_id,
       ROUND(sqrt(pow(lat - {C.UNION_ANCHOR[0]}, 2) + pow(lon - ({C.UNION_ANCHOR[1]}), 2)) * 111.0, 6) AS km_planar,
       ROUND({hav_sql('lat', 'lon', C.UNION_ANCHOR[0], f'({C.UNION_ANCHOR[1]})')}, 6) AS km_haversine
FROM points"""), "F14 F15 D17")
def q_km_haversine(spark, sf_dir):
    pts = geo.customer_points(read_table(spark, sf_dir, "customer", ["c_custkey"]))
    a_lat, a_lon = C.UNION_ANCHOR
    return pts.select("point_id", X.r6(X.planar_km("lat", "lon")).alias("km_planar"),
                      X.r6(X.haversine_km("lat", "lon", F.lit(a_lat), F.lit(a_lon))).alias("km_haversine"))


_cte("priors", ("silver",), """
  SELECT station_id, COUNT(*) AS taps, COUNT(*) / SUM(COUNT(*)) OVER () AS prior FROM silver GROUP BY 1""")

_DEMAND = f"""({C.DEMAND_CURVE['base']} + {C.DEMAND_CURVE['a1']} * exp(-pow(h - {C.DEMAND_CURVE['c1']}, 2) / {C.DEMAND_CURVE['w1']})
     + {C.DEMAND_CURVE['a2']} * exp(-pow(h - {C.DEMAND_CURVE['c2']}, 2) / {C.DEMAND_CURVE['w2']}))"""


@register("expected_demand", compose("fact_rh", "priors", "event_hours", f"""
SELECT station_id, tap_hour_utc, ROUND(m, 6) AS event_multiplier, ROUND(w, 6) AS weight,
       ROUND(sh / SUM(sh) OVER (PARTITION BY tap_hour_utc), 6) AS expected_share,
       ROUND(total_taps / SUM(total_taps) OVER (PARTITION BY tap_hour_utc), 6) AS observed_share
FROM (SELECT f.station_id, f.tap_hour_utc, f.total_taps, coalesce(e.m, 1.0) AS m, p.taps * coalesce(e.m, 1.0) AS sh,
             p.prior * {_DEMAND.replace('h', 'CAST(extract(hour FROM f.tap_hour_utc) AS DOUBLE)').replace('exCAST', 'ex')} * coalesce(e.m, 1.0) AS w
      FROM fact_rh f JOIN priors p USING (station_id)
      LEFT JOIN (SELECT station_id, tap_hour_utc, exp(SUM(ln(uplift_multiplier))) AS m
                 FROM event_hours GROUP BY 1, 2) e USING (station_id, tap_hour_utc))"""), "N8 F16 J6")
def q_expected_demand(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    from railyard.operators import gold
    return geo.expected_demand(gold.fact_ridership_hourly(s), geo.station_priors(s), B.event_calendar(spark))


@register("od_share", compose("od_pairs", "priors", """
SELECT p.origin, p.destination, p.trips, ROUND(p.trips / SUM(p.trips) OVER (), 6) AS observed_share,
       ROUND(CASE WHEN p.origin <> p.destination THEN a.prior * b.prior / z.z END, 6) AS expected_share
FROM od_pairs p
LEFT JOIN priors a ON a.station_id = p.origin
LEFT JOIN priors b ON b.station_id = p.destination,
(SELECT pow(SUM(prior), 2) - SUM(pow(prior, 2)) AS z FROM priors) z"""), "N9 J11")
def q_od_share(spark, sf_dir):
    return geo.od_share(geo.od_pairs(B.od_trips(spark, sf_dir)), geo.station_priors(silver_of(spark, sf_dir)))


@register("demand_profile", compose("fact_rh", """
SELECT 'hour_share' AS profile, h AS bucket, ROUND(t / SUM(t) OVER (), 6) AS value
FROM (SELECT CAST(extract(hour FROM tap_hour_utc) AS INTEGER) AS h, SUM(total_taps) AS t FROM fact_rh GROUP BY 1)
UNION ALL
SELECT 'weekday_factor', dw, ROUND(AVG(t) / (SELECT AVG(t) FROM (SELECT SUM(total_taps) AS t FROM fact_rh
                                                                  GROUP BY CAST(tap_hour_utc AS DATE))), 6)
FROM (SELECT CAST(extract(dow FROM CAST(tap_hour_utc AS DATE)) AS INTEGER) AS dw, SUM(total_taps) AS t
      FROM fact_rh GROUP BY CAST(tap_hour_utc AS DATE), 1) GROUP BY dw"""), "N10")
def q_demand_profile(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return geo.demand_profile(r)


@register("feature_table", compose("uplift_trailing", "event_hours", """
SELECT t.station_id, t.tap_hour_utc, t.unique_riders, t.baseline_riders,
       CAST(extract(hour FROM t.tap_hour_utc) AS INTEGER) AS hour_of_day,
       CAST(extract(dow FROM t.tap_hour_utc) AS INTEGER) AS day_of_week,
       isodow(t.tap_hour_utc) >= 6 AS is_weekend, t.is_event_day,
       CAST(coalesce(e.n, 0) AS BIGINT) AS active_events, ROUND(coalesce(e.m, 1.0), 6) AS event_multiplier
FROM (SELECT DISTINCT station_id, tap_hour_utc, unique_riders, baseline_riders, is_event_day FROM uplift_trailing) t
LEFT JOIN (SELECT station_id, tap_hour_utc, COUNT(*) AS n, exp(SUM(ln(uplift_multiplier))) AS m
           FROM event_hours GROUP BY 1, 2) e USING (station_id, tap_hour_utc)"""), "N11 N7")
def q_feature_table(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    cal = B.event_calendar(spark)
    t = marts.uplift_trailing(r, cal).select("station_id", "tap_hour_utc", "unique_riders", "baseline_riders",
                                             "is_event_day").dropDuplicates(["station_id", "tap_hour_utc"])
    hits = geo.event_hours(r.select("station_id", "tap_hour_utc"), cal)
    e = hits.groupBy("station_id", "tap_hour_utc").agg(F.count(F.lit(1)).alias("_n"),
                                                       F.exp(F.sum(F.log("uplift_multiplier"))).alias("_m"))
    j = t.join(e, ["station_id", "tap_hour_utc"], "left")
    return j.select("station_id", "tap_hour_utc", "unique_riders", "baseline_riders",
                    X.hour_of_day("tap_hour_utc").alias("hour_of_day"),
                    X.dow_sunday0("tap_hour_utc").alias("day_of_week"),
                    X.is_weekend("tap_hour_utc").alias("is_weekend"), "is_event_day",
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("active_events"),
                    X.r6(F.coalesce("_m", F.lit(1.0))).alias("event_multiplier"))


# --- forecasts (R1-R5, M11) ---------------------------------------------------------------
FORECAST_AS_OF = "2024-01-31 00:00:00"


def forecast_requests(spark, sf_dir):
    """Requests: one per station (24 h) and one per region name (horizon from
    its key, so some are out of range; one name has a space)."""
    n = read_table(spark, sf_dir, "nation", ["n_name"]).select(
        F.col("n_name").alias("station_id"), F.lit(24).alias("horizon_hours"))
    r = read_table(spark, sf_dir, "region", ["r_name", "r_regionkey"]).select(
        F.col("r_name").alias("station_id"), (F.col("r_regionkey") * 50).alias("horizon_hours"))
    return n.unionByName(r).withColumn("as_of", F.lit(FORECAST_AS_OF).cast("timestamp"))


_ORD = "list_sum(list_transform(string_split({s}, ''), lambda c: ascii(c)))"
_FACTOR = ("CASE WHEN {h} BETWEEN 7 AND 9 THEN 1.5::DOUBLE WHEN {h} BETWEEN 16 AND 18 THEN 1.4::DOUBLE "
           "WHEN {h} <= 5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END")


def pred_sql(s: str, h: str) -> str:
    return f"CAST(trunc(({_ORD.format(s=s)} % 100 + 25) * {_FACTOR.format(h=h)} * 100.0::DOUBLE) AS INTEGER)"


_cte("requests", (), f"""
  SELECT upper(trim(station_id)) AS station_id, horizon_hours, TIMESTAMP '{FORECAST_AS_OF}' AS as_of FROM (
    SELECT n_name AS station_id, 24 AS horizon_hours FROM nation
    UNION ALL SELECT r_name, r_regionkey * 50 FROM region)""")

_VALID = ("length(station_id) BETWEEN 1 AND 32 AND (regexp_full_match(station_id, '[A-Za-z0-9]+') "
          "OR contains(station_id, '_')) AND horizon_hours BETWEEN 1 AND 168")


@register("forecast_batch", compose("requests", f"""
SELECT station_id, horizon_hours, ts, pred AS predicted_ridership,
       CAST(trunc(pred * 0.85::DOUBLE) AS INTEGER) AS pi_lower_80,
       CAST(trunc(pred * 1.15::DOUBLE) AS INTEGER) AS pi_upper_80
FROM (SELECT station_id, horizon_hours, ts, {pred_sql('station_id', 'extract(hour FROM ts)')} AS pred
      FROM (SELECT station_id, horizon_hours, as_of + h * INTERVAL 1 HOUR AS ts
            FROM (SELECT *, unnest(range(0, horizon_hours)) AS h FROM requests WHERE {_VALID})))"""), "R1 R2 F22")
def q_forecast_batch(spark, sf_dir):
    ok, _ = R.validate_requests(forecast_requests(spark, sf_dir))
    return R.forecast_points(ok)


@register("forecast_rejects", compose("requests", f"""
SELECT station_id, horizon_hours, as_of, array_to_string(list_filter([
  CASE WHEN length(station_id) NOT BETWEEN 1 AND 32 THEN 'id_length' END,
  CASE WHEN NOT (regexp_full_match(station_id, '[A-Za-z0-9]+') OR contains(station_id, '_')) THEN 'id_chars' END,
  CASE WHEN horizon_hours NOT BETWEEN 1 AND 168 THEN 'horizon_range' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM requests WHERE NOT ({_VALID})"""), "R2 Q8")
def q_forecast_rejects(spark, sf_dir):
    _, bad = R.validate_requests(forecast_requests(spark, sf_dir))
    return bad


def _actual_vs_stub(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    names = B.stations(spark, sf_dir).select("station_id", F.col("name").alias("station_name"))
    a = r.groupBy("station_id", "tap_hour_utc").agg(F.sum("total_taps").alias("total_taps"))
    return R.stub_for_hours(a.join(names, "station_id"))


_cte("actual_vs_stub", ("fact_rh", "stations"), f"""
  SELECT a.station_id, a.tap_hour_utc, a.total_taps,
         {pred_sql('upper(trim(s.name))', 'extract(hour FROM a.tap_hour_utc)')} AS forecast
  FROM (SELECT station_id, tap_hour_utc, CAST(SUM(total_taps) AS BIGINT) AS total_taps FROM fact_rh GROUP BY 1, 2) a
  JOIN stations s USING (station_id)""")


@register("forecast_variance", compose("actual_vs_stub", """
SELECT station_id, tap_hour_utc, total_taps, forecast, total_taps - forecast AS variance,
       ROUND(CAST(total_taps - forecast AS DOUBLE) / NULLIF(forecast, 0) * 100, 6) AS variance_pct
FROM actual_vs_stub"""), "M11")
def q_forecast_variance(spark, sf_dir):
    return R.forecast_variance(_actual_vs_stub(spark, sf_dir))


@register("forecast_mape", compose("actual_vs_stub", "event_days", """
SELECT station_id, COUNT(*) AS hours,
       ROUND(AVG(abs(total_taps - forecast) / CAST(NULLIF(total_taps, 0) AS DOUBLE)) * 100, 6) AS mape_pct
FROM actual_vs_stub a JOIN event_days e ON CAST(a.tap_hour_utc AS DATE) = e.service_date
GROUP BY 1"""), "R3")
def q_forecast_mape(spark, sf_dir):
    a = _actual_vs_stub(spark, sf_dir).withColumn("service_date", F.to_date("tap_hour_utc"))
    ed = geo.event_days(B.event_calendar(spark))
    return R.mape(a.join(ed, "service_date", "inner"))


@register("uplift_attribution", compose("uplift_static", "event_hours", "calendar", """
SELECT event_id, CAST(observed AS BIGINT) AS observed, ROUND(cf, 6) AS counterfactual, ROUND(ratio, 6) AS uplift_ratio,
       ROUND(ratio - 1.96 * sqrt(v) / NULLIF(cf, 0.0), 6) AS ci_lower,
       ROUND(ratio + 1.96 * sqrt(v) / NULLIF(cf, 0.0), 6) AS ci_upper
FROM (SELECT *, observed / NULLIF(cf, 0.0) AS ratio FROM (
  SELECT event_id, observed, v, base * (CAST(donor_obs AS DOUBLE) / NULLIF(donor_base, 0.0)) AS cf FROM (
    SELECT h.event_id,
           SUM(CASE WHEN list_contains(c.station_ids, u.station_id) THEN u.unique_riders END) AS observed,
           SUM(CASE WHEN list_contains(c.station_ids, u.station_id) THEN u.baseline_riders END) AS base,
           SUM(CASE WHEN list_contains(c.station_ids, u.station_id) THEN pow(u.baseline_riders_sd, 2) END) AS v,
           SUM(CASE WHEN NOT list_contains(c.station_ids, u.station_id) THEN u.unique_riders END) AS donor_obs,
           SUM(CASE WHEN NOT list_contains(c.station_ids, u.station_id) THEN u.baseline_riders END) AS donor_base
    FROM uplift_static u
    JOIN (SELECT DISTINCT event_id, tap_hour_utc FROM event_hours) h USING (tap_hour_utc)
    JOIN calendar c ON c.event_id = h.event_id
    GROUP BY 1)))"""), "R5")
def q_uplift_attribution(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    cal = B.event_calendar(spark)
    hits = geo.event_hours(r.select("station_id", "tap_hour_utc"), cal)
    return R.uplift_attribution(marts.uplift_static(r), hits, cal)


@register("forecast_drivers", compose("uplift_trailing", "event_hours", """
SELECT t.station_id, t.tap_hour_utc, t.unique_riders, ROUND(t.baseline_riders * e.m, 6) AS predicted_riders,
       ROUND(t.baseline_riders, 6) AS driver_baseline, ROUND(e.m, 6) AS driver_event_uplift
FROM (SELECT DISTINCT station_id, tap_hour_utc, unique_riders, baseline_riders FROM uplift_trailing) t
JOIN (SELECT station_id, tap_hour_utc, exp(SUM(ln(uplift_multiplier))) AS m FROM event_hours GROUP BY 1, 2) e
USING (station_id, tap_hour_utc)"""), "R4 W3 J6")
def q_forecast_drivers(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    cal = B.event_calendar(spark)
    hits = geo.event_hours(r.select("station_id", "tap_hour_utc"), cal)
    f = R.forecast_with_drivers(marts.uplift_trailing(r, cal), hits)
    return f.select("station_id", "tap_hour_utc", "unique_riders", "predicted_riders",
                    F.col("drivers.baseline").alias("driver_baseline"),
                    F.col("drivers.event_uplift").alias("driver_event_uplift"))


# --- venue events: files written from the bound tables, read back, mapped to stations ------
def _venue_events(spark, sf_dir):
    """Every card holder's home hosts one evening; written as the reference
    layout's events.csv and read by its loader."""
    pts = geo.customer_points(read_table(spark, sf_dir, "customer", ["c_custkey"]))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("point_id") % 28).cast("int")).cast("string")
    rows = pts.select(
        F.col("point_id").cast("string").alias("event_id"), F.concat(F.lit("Event "), "point_id").alias("name"),
        F.concat(F.lit("Venue "), "point_id").alias("venue_name"), F.col("lat").alias("venue_latitude"),
        F.col("lon").alias("venue_longitude"), F.concat(day, F.lit("T18:00:00")).alias("start_iso"),
        F.concat(day, F.lit("T21:59:59")).alias("end_iso"),
        (F.col("point_id") % 1000).cast("int").alias("expected_attendance"))
    root = scratch_path(spark, "venues")
    rows.write.option("header", True).csv(f"{root}/net-a/events.csv")
    return RF.load_events(spark, root, "net-a")


_VENUE_SQL = f"""(SELECT CAST(point_id AS VARCHAR) AS event_id, point_id, station_id, ROUND(d, 6) AS distance_km FROM (
  SELECT p.point_id, s.station_id, {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')} AS d,
         ROW_NUMBER() OVER (PARTITION BY p.point_id ORDER BY {hav_sql('p.lat', 'p.lon', 's.lat', 's.lon')}, s.station_id) AS rn
  FROM points p, stations s) WHERE rn = 1)"""


@register("event_venue_bridge", compose("points", "stations", f"""
SELECT event_id, station_id, distance_km FROM {_VENUE_SQL}"""), "N6 S14")
def q_event_venue_bridge(spark, sf_dir):
    b = geo.venue_stations(_venue_events(spark, sf_dir), B.stations(spark, sf_dir))
    return b.select("event_id", "station_id", X.r6("distance_km").alias("distance_km"))


@register("dim_event", compose("points", "stations", "silver", f"""
SELECT v.event_id, 'Venue ' || v.event_id AS venue_name, v.station_id,
       CAST(v.point_id % 1000 AS INTEGER) AS expected_attendance, COUNT(s.tap_id) AS event_taps
FROM {_VENUE_SQL} v LEFT JOIN silver s ON s.station_id = v.station_id
  AND s.tap_timestamp_utc >= TIMESTAMP '2024-01-01 18:00:00' + to_days(CAST(v.point_id % 28 AS INTEGER))
  AND s.tap_timestamp_utc <= TIMESTAMP '2024-01-01 21:59:59' + to_days(CAST(v.point_id % 28 AS INTEGER))
GROUP BY ALL"""), "N4 N6 J6 S14")
def q_dim_event(spark, sf_dir):
    """Venue events with their station and the taps made there during the event."""
    events = _venue_events(spark, sf_dir)
    dim = geo.dim_event(events, geo.venue_stations(events, B.stations(spark, sf_dir)))
    calendar = dim.filter(F.col("station_id").isNotNull()).select(
        "event_id", F.array("station_id").alias("station_ids"), "start_ts", "end_ts",
        F.lit(1.0).alias("uplift_multiplier"))
    taps = geo.event_interval_join(silver_of(spark, sf_dir), calendar).select("event_id", "event_taps")
    return (dim.join(taps, "event_id", "left")
            .select("event_id", "venue_name", "station_id", "expected_attendance",
                    F.coalesce("event_taps", F.lit(0)).alias("event_taps")))


_cte("daily_taps", (), """
  SELECT c_nationkey AS station_id, CAST(o_orderdate AS DATE) AS service_date, COUNT(*) AS taps
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
_cte("backtested", ("daily_taps",), f"""
  SELECT f.*, forecast + q[1] AS lower, forecast + q[2] AS upper FROM (
    SELECT *, date_trunc('month', service_date) AS month FROM (
      SELECT station_id, service_date, actual, AVG(actual) OVER w AS forecast, COUNT(*) OVER w AS n FROM (
        SELECT d.station_id, d.service_date, CAST(coalesce(taps, 0) AS DOUBLE) AS actual,
               CAST(d.service_date - DATE '1970-01-01' AS INTEGER) AS e
        FROM (SELECT station_id, CAST(unnest(generate_series(CAST(MIN(service_date) AS TIMESTAMP),
                CAST(MAX(service_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS service_date
              FROM daily_taps GROUP BY station_id) d
        LEFT JOIN daily_taps USING (station_id, service_date))
      WINDOW w AS (PARTITION BY station_id, e % 7 ORDER BY e RANGE BETWEEN {7 * R.SEASON_WEEKS} PRECEDING AND 1 PRECEDING))
    WHERE n >= {R.LEAST_WEEKS}) f
  JOIN (SELECT station_id, month, quantile_cont(r, [0.1, 0.9]) AS q FROM (
          SELECT station_id, actual - forecast AS r,
                 unnest([date_trunc('month', service_date) + to_months(i) FOR i IN range(1, {R.RESIDUAL_MONTHS + 1})]) AS month
          FROM (SELECT station_id, service_date, actual, AVG(actual) OVER w AS forecast, COUNT(*) OVER w AS n FROM (
            SELECT d.station_id, d.service_date, CAST(coalesce(taps, 0) AS DOUBLE) AS actual,
                   CAST(d.service_date - DATE '1970-01-01' AS INTEGER) AS e
            FROM (SELECT station_id, CAST(unnest(generate_series(CAST(MIN(service_date) AS TIMESTAMP),
                    CAST(MAX(service_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS service_date
                  FROM daily_taps GROUP BY station_id) d
            LEFT JOIN daily_taps USING (station_id, service_date))
          WINDOW w AS (PARTITION BY station_id, e % 7 ORDER BY e RANGE BETWEEN {7 * R.SEASON_WEEKS} PRECEDING AND 1 PRECEDING))
          WHERE n >= {R.LEAST_WEEKS})
        GROUP BY 1, 2 HAVING COUNT(*) >= {R.LEAST_RESIDUALS}) b
  ON b.station_id = f.station_id AND b.month = f.month""")


def _daily_taps(spark, sf_dir):
    return (B.daily_orders(spark, sf_dir).groupBy("station_id", "service_date")
            .agg(F.count(F.lit(1)).alias("taps")))


@register("forecast_backtest", compose("backtested", """
SELECT station_id, COUNT(*) AS days, ROUND(AVG(abs(actual - forecast) / nullif(actual, 0)) * 100, 6) AS mape_pct,
       ROUND(AVG(forecast - actual), 6) AS bias,
       ROUND(AVG(CASE WHEN actual >= lower AND actual <= upper THEN 1.0 ELSE 0.0 END), 6) AS covered
FROM backtested GROUP BY 1"""), "R3 R4")
def q_forecast_backtest(spark, sf_dir):
    """Rolling-origin error and coverage of the seasonal forecast per station."""
    return R.backtest_summary(R.backtest(_daily_taps(spark, sf_dir)))


@register("forecast_interval_variance", compose("backtested", """
SELECT station_id, service_date, actual, ROUND(forecast, 6) AS forecast, ROUND(lower, 6) AS lower,
       ROUND(upper, 6) AS upper, ROUND(actual - forecast, 6) + 0.0 AS variance,
       ROUND((actual - forecast) / nullif(forecast, 0) * 100, 6) + 0.0 AS variance_pct,
       actual >= lower AND actual <= upper AS inside
FROM backtested"""), "M11 R4")
def q_forecast_interval_variance(spark, sf_dir):
    return R.interval_variance(R.backtest(_daily_taps(spark, sf_dir)))


@register("calendar_file_events", compose("silver", "calendar_x", """
SELECT 'event ' || c.event_id AS name, s.station_id, COUNT(*) AS event_taps, COUNT(DISTINCT s.card_token) AS event_riders
FROM silver s JOIN calendar_x c ON s.station_id = c.ev_station
 AND s.tap_timestamp_utc >= c.start_ts AND s.tap_timestamp_utc <= c.end_ts
GROUP BY 1, 2"""), "S15 J6")
def q_calendar_file_events(spark, sf_dir):
    """The event calendar from its JSON file (station ids are text there), joined to the taps."""
    path = scratch_path(spark, "calendar")
    rows = [(f"event {e}", a, b, [str(i) for i in ids], m) for e, a, b, ids, m in C.EVENT_CALENDAR]
    made = spark.createDataFrame(rows, RF.CALENDAR_JSON_SCHEMA)
    made.select(F.to_json(F.collect_list(F.struct(*made.columns)).over(Window.partitionBy())).alias("value")).limit(1) \
        .write.text(path)
    calendar = RF.load_calendar(spark, path).withColumn("station_ids", F.col("station_ids").cast("array<int>"))
    taps = geo.event_interval_join(silver_of(spark, sf_dir), calendar)
    return (taps.join(calendar.select("event_id", "name"), "event_id")
            .select("name", "station_id", "event_taps", "event_riders"))
