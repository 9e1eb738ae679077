"""Dimensions and bridges."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard import constants as C
from railyard.operators import dims, geo
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.plans.q_core import silver_of
from railyard.sources import binding as B
from railyard.sources.tables import read_table

_HAV = """2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)
        + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def hav_sql(lat1, lon1, lat2, lon2) -> str:
    return _HAV.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


def year_bounds(spark, sf_dir):
    """First and last year covered by taps (events) and daily history (orders)."""
    e = read_table(spark, sf_dir, "events", ["ts"]).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"]).agg(F.min("o_orderdate").alias("a"),
                                                                  F.max("o_orderdate").alias("b"))
    u = e.unionByName(o).agg(F.year(F.min("a")).alias("y0"), F.year(F.max("b")).alias("y1"))
    return u


_DIM_DATE_SQL = compose("event_days", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_name,
       isodow(d) >= 6 AS is_weekend,
       CASE WHEN isodow(d) >= 6 THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type,
       coalesce(e.is_event_day, false) AS is_event_day
FROM (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(year(min(a)) AS INTEGER) AS y0, CAST(year(max(b)) AS INTEGER) AS y1
            FROM (SELECT min(ts) AS a, max(ts) AS b FROM events
                  UNION ALL SELECT min(o_orderdate), max(o_orderdate) FROM orders))) s
LEFT JOIN event_days e ON e.service_date = s.d""")


@register("dim_date", _DIM_DATE_SQL, "N1 N2 N7 F5 F6 F7 P6")
def q_dim_date(spark, sf_dir):
    from railyard.operators.geo import event_days
    return dims.dim_date(dims.date_spine(year_bounds(spark, sf_dir)), event_days(B.event_calendar(spark)))


@register("dim_station", compose("stations", "lines", f"""
SELECT s.station_id, s.name, s.line_id, l.line_name, s.zone, s.lat, s.lon,
       ROUND(sqrt(pow(s.lat - {C.UNION_ANCHOR[0]}, 2) + pow(s.lon - ({C.UNION_ANCHOR[1]}), 2)) * 111.0, 6) AS km_planar,
       ROUND({hav_sql('s.lat', 's.lon', C.UNION_ANCHOR[0], f'({C.UNION_ANCHOR[1]})')}, 6) AS km_haversine
FROM stations s LEFT JOIN lines l USING (line_id)"""), "N3 J2 F14 F15 D17")
def q_dim_station(spark, sf_dir):
    return dims.dim_station(B.stations(spark, sf_dir), B.lines(spark, sf_dir))


@register("dim_line", compose("stations", "lines", """
SELECT l.line_id, l.line_name, CAST(coalesce(p.n_stations, 0) AS BIGINT) AS n_stations,
       CAST(coalesce(p.n_zones, 0) AS BIGINT) AS n_zones
FROM lines l LEFT JOIN (SELECT line_id, COUNT(*) AS n_stations, COUNT(DISTINCT zone) AS n_zones
                        FROM stations GROUP BY 1) p USING (line_id)"""), "N4")
def q_dim_line(spark, sf_dir):
    return dims.dim_line(B.stations(spark, sf_dir), B.lines(spark, sf_dir))


@register("event_station_bridge", compose("calendar_x", "stations", "fact_rh", """
SELECT c.event_id, c.ev_station AS station_id, s.name, c.start_ts, c.end_ts, c.uplift_multiplier,
       CAST(coalesce(SUM(f.total_taps), 0) AS BIGINT) AS taps_in_window
FROM calendar_x c JOIN stations s ON s.station_id = c.ev_station
LEFT JOIN fact_rh f ON f.station_id = c.ev_station AND f.tap_hour_utc >= c.start_ts AND f.tap_hour_utc <= c.end_ts
GROUP BY ALL"""), "N5 F25 P8")
def q_event_station_bridge(spark, sf_dir):
    from railyard.operators import gold
    cal = B.event_calendar(spark)
    br = geo.event_station_bridge(cal, B.stations(spark, sf_dir))
    fact = gold.fact_ridership_hourly(silver_of(spark, sf_dir))
    hits = geo.event_hours(fact.select("station_id", "tap_hour_utc"), cal) \
        .join(fact.select("station_id", "tap_hour_utc", "total_taps"), ["station_id", "tap_hour_utc"])
    taps = hits.groupBy("event_id", "station_id").agg(F.sum("total_taps").alias("_t"))
    return br.join(taps, ["event_id", "station_id"], "left") \
             .withColumn("taps_in_window", F.coalesce(F.col("_t"), F.lit(0)).cast("bigint")).drop("_t")


@register("line_code_bridge", compose("silver", """
SELECT device_id, CAST(pos AS INTEGER) AS position, string_split(device_id, '-')[pos] AS code
FROM (SELECT DISTINCT device_id FROM silver) d,
     LATERAL (SELECT unnest(generate_series(1, len(string_split(device_id, '-')))) AS pos)"""), "F26")
def q_line_code_bridge(spark, sf_dir):
    """Hyphen-delimited code lists split to a bridge; the binding's coded
    field is the reader id ``reader-<station>-<n>``."""
    devices = silver_of(spark, sf_dir).select("device_id").distinct()
    return dims.code_bridge(devices, "device_id", "device_id")


@register("station_distance_matrix", compose("od_pairs", "stations", f"""
SELECT p.origin, p.destination, p.trips,
       ROUND({hav_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS km_haversine
FROM od_pairs p JOIN stations a ON a.station_id = p.origin JOIN stations b ON b.station_id = p.destination"""),
    "J11 F15")
def q_station_distance_matrix(spark, sf_dir):
    """Distances for every observed station pair (never all pairs)."""
    return geo.station_distance_matrix(geo.od_pairs(B.od_trips(spark, sf_dir)), B.stations(spark, sf_dir))
