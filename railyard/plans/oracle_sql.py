"""Independent SQL (DuckDB dialect) for every oracle-checked query.

Named CTE fragments are composed on demand: ``compose("fact_rh", final)``
pulls in ``fact_rh`` and everything it depends on, in definition order.
The fragments spell the same binding and rules as the Spark code, written
independently as plain SQL.
"""

from __future__ import annotations

from railyard import constants as C

_FARE_CASE = "CASE event_type " + " ".join(
    f"WHEN '{et}' THEN '{fc}'" for et, fc in C.EVENT_TYPE_TO_FARE_CLASS) + " END"

_CALENDAR_ROWS = ",\n    ".join(
    f"('{e}', TIMESTAMP '{s}', TIMESTAMP '{t}', [{', '.join(str(i) for i in ids)}], CAST({m} AS DOUBLE))"
    for e, s, t, ids, m in C.EVENT_CALENDAR)

_DEDUP_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "ingest_timestamp_utc", "fare_amount_cad", "tap_timestamp_utc", "card_token", "station_id",
    "fare_class", "tap_type", "device_id", "zone", "schema_version"))

# (name, deps, body)
_CTES: list[tuple[str, tuple[str, ...], str]] = []


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    _CTES.append((name, deps, body))


_cte("ev", (), """
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events""")

_cte("variants", ("ev",), f"""
  SELECT *, 0 AS variant FROM ev
  UNION ALL SELECT *, 1 AS variant FROM ev WHERE k < {C.DUPLICATE_K_BELOW}""")

_cte("variants_dq", ("ev",), f"""
  SELECT *, 0 AS variant FROM ev
  UNION ALL SELECT *, 1 AS variant FROM ev WHERE k < {C.DUPLICATE_K_BELOW}
  UNION ALL SELECT *, 2 AS variant FROM ev WHERE k = {C.VIOLATION_BAD_TAP_TYPE_K}
  UNION ALL SELECT *, 3 AS variant FROM ev WHERE k = {C.VIOLATION_UNKNOWN_STATION_K}""")


def _bronze_body(src: str) -> str:
    return f"""
  SELECT v.event_id AS tap_id,
         v.user_id AS card_token,
         v.station_id,
         n.n_regionkey AS zone,
         {_FARE_CASE.replace('event_type', 'v.event_type')} AS fare_class,
         CAST(CASE WHEN v.variant = 1 THEN CAST(v.value AS DECIMAL(18,2)) + 1
                   ELSE CAST(v.value AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS fare_amount_cad,
         CASE WHEN v.variant = 2 THEN 'TAP_X'
              WHEN v.k % 2 = 0 THEN 'TAP_ON' ELSE 'TAP_OFF' END AS tap_type,
         v.ts AS tap_timestamp_utc,
         'reader-' || CAST(v.k % {C.N_STATIONS_BOUND} AS VARCHAR) || '-' || CAST(v.event_id % 4 + 1 AS VARCHAR) AS device_id,
         'v1' AS schema_version,
         CASE WHEN v.variant = 1 THEN v.ts + INTERVAL 1 HOUR ELSE v.ts END AS ingest_timestamp_utc,
         v.k
  FROM (SELECT *, CASE WHEN variant = 3 THEN {C.UNKNOWN_STATION_ID} ELSE k % {C.N_STATIONS_BOUND} END AS station_id
        FROM {src}) v
  LEFT JOIN nation n ON n.n_nationkey = v.station_id"""


_cte("bronze", ("variants",), _bronze_body("variants"))
_cte("bronze_dq", ("variants_dq",), _bronze_body("variants_dq"))

_cte("stations", (), """
  SELECT n_nationkey AS station_id, n_name AS name, n_regionkey AS line_id, n_regionkey AS zone,
         CAST(43 + (n_nationkey % 5) * 0.1 AS DOUBLE) AS lat,
         CAST(-79 - (n_nationkey // 5) * 0.1 AS DOUBLE) AS lon
  FROM nation""")

_cte("lines", (), "SELECT r_regionkey AS line_id, r_name AS line_name FROM region")


def _tagged_body(src: str) -> str:
    return f"""
  SELECT b.*, s.line_id,
         list_filter([
           CASE WHEN b.tap_id IS NULL THEN 'tap_id_null' END,
           CASE WHEN b.tap_timestamp_utc IS NULL THEN 'event_time_null' END,
           CASE WHEN NOT coalesce(b.tap_type IN ('TAP_ON', 'TAP_OFF'), false) THEN 'bad_tap_type' END,
           CASE WHEN s.station_id IS NULL THEN 'unknown_station' END], lambda x: x IS NOT NULL) AS reasons
  FROM {src} b LEFT JOIN stations s ON b.station_id = s.station_id"""


_cte("tagged", ("bronze", "stations"), _tagged_body("bronze"))
_cte("tagged_dq", ("bronze_dq", "stations"), _tagged_body("bronze_dq"))

_cte("bronze_faulty", ("bronze_dq",), """
  SELECT * REPLACE (
    CASE WHEN k <> 93 THEN tap_id END AS tap_id, CASE WHEN k <> 92 THEN card_token END AS card_token,
    CASE WHEN k <> 87 THEN station_id END AS station_id,
    CASE WHEN k = 91 THEN -fare_amount_cad - 1 ELSE fare_amount_cad END AS fare_amount_cad,
    CASE WHEN k <> 90 THEN tap_timestamp_utc END AS tap_timestamp_utc,
    CASE WHEN k = 88 THEN 'door-' || device_id ELSE device_id END AS device_id,
    CASE WHEN k = 89 THEN 'version 2' ELSE schema_version END AS schema_version)
  FROM bronze_dq""")
_cte("tagged_faulty", ("bronze_faulty", "stations"), _tagged_body("bronze_faulty"))
_cte("stations_faulty", ("stations",), """
  SELECT * REPLACE (CASE WHEN station_id = 3 THEN 91.5 ELSE lat END AS lat,
    CASE WHEN station_id = 4 THEN -200.0 ELSE lon END AS lon, CASE WHEN station_id = 5 THEN 'no id!' ELSE name END AS name)
  FROM stations""")

_cte("dedup", ("tagged",), f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tap_id ORDER BY {_DEDUP_ORDER}) AS rn
    FROM tagged WHERE len(reasons) = 0) WHERE rn = 1""")

_cte("silver", ("dedup",), """
  SELECT tap_id, card_token, station_id, line_id, zone, fare_class, fare_amount_cad, tap_type,
         tap_timestamp_utc, device_id, schema_version,
         CAST(strftime(tap_timestamp_utc, '%Y%m%d') AS INTEGER) AS date_key,
         date_trunc('hour', tap_timestamp_utc) AS tap_hour_utc,
         ingest_timestamp_utc
  FROM dedup""")

_cte("fact_rh", ("silver",), """
  SELECT date_key, tap_hour_utc, station_id, line_id, zone,
         CAST(SUM(CASE WHEN tap_type = 'TAP_ON' THEN 1 ELSE 0 END) AS BIGINT) AS tap_on_count,
         CAST(SUM(CASE WHEN tap_type = 'TAP_OFF' THEN 1 ELSE 0 END) AS BIGINT) AS tap_off_count,
         COUNT(*) AS total_taps,
         COUNT(DISTINCT card_token) AS unique_riders,
         ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE), 2) AS total_fare_cad,
         ROUND(CASE WHEN COUNT(DISTINCT card_token) = 0 THEN 0
                    ELSE CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT card_token) END, 6) AS taps_per_rider
  FROM silver
  GROUP BY date_key, tap_hour_utc, station_id, line_id, zone""")

_cte("fact_faulty", ("fact_rh",), """
  SELECT * REPLACE (
    CASE WHEN station_id = 6 THEN total_taps + 1 WHEN station_id = 9 THEN -total_taps ELSE total_taps END AS total_taps,
    CASE WHEN station_id = 8 THEN total_taps + 1 WHEN station_id = 9 THEN -1 ELSE unique_riders END AS unique_riders,
    CASE WHEN station_id = 9 THEN -tap_on_count - 1 ELSE tap_on_count END AS tap_on_count,
    CASE WHEN station_id = 9 THEN -tap_off_count - 1 ELSE tap_off_count END AS tap_off_count,
    CASE WHEN station_id = 9 THEN -total_fare_cad - 1 ELSE total_fare_cad END AS total_fare_cad,
    CASE WHEN station_id = 9 THEN -1.0 ELSE taps_per_rider END AS taps_per_rider,
    CASE WHEN station_id <> 10 THEN date_key END AS date_key, CASE WHEN station_id <> 10 THEN line_id END AS line_id,
    CASE WHEN station_id <> 10 THEN tap_hour_utc END AS tap_hour_utc,
    CASE WHEN station_id <> 11 THEN station_id END AS station_id)
  FROM (SELECT * FROM fact_rh UNION ALL SELECT * FROM fact_rh WHERE station_id = 5)""")

_cte("fact_fr", ("silver",), """
  SELECT date_key, tap_hour_utc, station_id, line_id, zone, fare_class,
         ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE), 2) AS gross_fare_revenue_cad,
         COUNT(*) AS paid_tap_count,
         COUNT(DISTINCT card_token) AS paying_riders,
         ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE) / NULLIF(COUNT(*), 0), 6) AS avg_fare_per_tap_cad,
         ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE) / NULLIF(COUNT(DISTINCT card_token), 0), 6) AS revenue_per_rider_cad
  FROM silver WHERE tap_type = 'TAP_ON'
  GROUP BY date_key, tap_hour_utc, station_id, line_id, zone, fare_class""")

_cte("calendar", (), f"""
  SELECT * FROM (VALUES
    {_CALENDAR_ROWS}) AS t(event_id, start_ts, end_ts, station_ids, uplift_multiplier)""")

_cte("calendar_x", ("calendar",), """
  SELECT event_id, unnest(station_ids) AS ev_station, start_ts, end_ts, uplift_multiplier FROM calendar""")

_cte("event_days", ("calendar",), """
  SELECT DISTINCT CAST(d AS DATE) AS service_date, true AS is_event_day
  FROM (SELECT unnest(generate_series(CAST(CAST(start_ts AS DATE) AS TIMESTAMP),
                                      CAST(CAST(end_ts AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM calendar)""")

_cte("event_hours", ("fact_rh", "calendar_x"), """
  SELECT f.station_id, f.tap_hour_utc, c.event_id, c.uplift_multiplier
  FROM (SELECT DISTINCT station_id, tap_hour_utc FROM fact_rh) f
  JOIN calendar_x c ON f.station_id = c.ev_station
   AND f.tap_hour_utc >= c.start_ts AND f.tap_hour_utc <= c.end_ts""")


def _uplift_cols(r: str, b: str, sd: str) -> str:
    return f"""
         ROUND({b}, 6) AS baseline_riders,
         ROUND({sd}, 6) AS baseline_riders_sd,
         ROUND({r} - {b}, 6) + 0.0 AS uplift_riders,
         ROUND(CASE WHEN {b} = 0 THEN NULL ELSE ({r} - {b}) / {b} END, 6) + 0.0 AS uplift_multiplier,
         ROUND(CASE WHEN {sd} IS NULL OR {sd} = 0 THEN NULL ELSE ({r} - {b}) / {sd} END, 6) + 0.0 AS uplift_z_score,
         (CAST({r} AS DOUBLE) / NULLIF({b}, 0)) >= CAST({C.UPLIFT_FLOOR_MULTIPLIER} AS DOUBLE) AS meets_uplift_floor"""


_cte("ridership_keys", ("fact_rh",), """
  SELECT *, CAST(extract(dow FROM tap_hour_utc) AS INTEGER) AS day_of_week,
            CAST(extract(hour FROM tap_hour_utc) AS INTEGER) AS hour_of_day
  FROM fact_rh""")

_cte("uplift_static", ("ridership_keys",), f"""
  SELECT r.date_key, r.tap_hour_utc, r.station_id, r.line_id, r.day_of_week, r.hour_of_day,
         r.unique_riders, {_uplift_cols('r.unique_riders', 'b.baseline', 'b.sd')}
  FROM ridership_keys r
  LEFT JOIN (SELECT station_id, day_of_week, hour_of_day,
                    AVG(unique_riders) AS baseline, STDDEV_POP(unique_riders) AS sd
             FROM ridership_keys GROUP BY station_id, day_of_week, hour_of_day) b
  USING (station_id, day_of_week, hour_of_day)""")

_cte("uplift_trailing", ("ridership_keys", "event_days", "event_hours"), f"""
  SELECT t.date_key, t.tap_hour_utc, t.station_id, t.line_id, h.event_id, t.is_event_day,
         t.unique_riders, {_uplift_cols('t.unique_riders', 't.b', 't.sd')}
  FROM (
    SELECT *,
      AVG(CASE WHEN NOT is_event_day THEN unique_riders END) OVER w AS b,
      STDDEV_POP(CASE WHEN NOT is_event_day THEN unique_riders END) OVER w AS sd
    FROM (SELECT r.*, coalesce(e.is_event_day, false) AS is_event_day,
                 CAST(CAST(r.tap_hour_utc AS DATE) - DATE '1970-01-01' AS INTEGER) AS epoch_day
          FROM ridership_keys r LEFT JOIN event_days e ON CAST(r.tap_hour_utc AS DATE) = e.service_date)
    WINDOW w AS (PARTITION BY station_id, day_of_week, hour_of_day ORDER BY epoch_day
                 RANGE BETWEEN {C.TRAILING_BASELINE_DAYS} PRECEDING AND 1 PRECEDING)) t
  LEFT JOIN event_hours h ON t.station_id = h.station_id AND t.tap_hour_utc = h.tap_hour_utc""")

_cte("station_kpis", ("fact_rh", "fact_fr"), """
  SELECT r.station_id, r.service_date, r.daily_taps, r.peak_hour_taps, r.avg_hour_taps, r.active_hours,
         CAST(coalesce(f.cents, 0) AS BIGINT) AS fare_revenue_cents,
         ROUND(coalesce(f.cents, 0) / 100.0, 2) AS fare_revenue_dollars,
         CAST(coalesce(f.concession_taps, 0) AS BIGINT) AS concession_taps,
         CAST(coalesce(f.youth_taps, 0) AS BIGINT) AS youth_taps,
         CAST(coalesce(f.senior_taps, 0) AS BIGINT) AS senior_taps,
         CAST(coalesce(f.employee_taps, 0) AS BIGINT) AS employee_taps,
         ROUND(CAST(coalesce(f.concession_taps, 0) AS DOUBLE) / NULLIF(r.daily_taps, 0), 6) AS concession_share,
         CASE WHEN r.daily_taps >= 50000 THEN 'very_high'
              WHEN r.daily_taps >= 20000 THEN 'high'
              WHEN r.daily_taps >= 5000 THEN 'medium'
              WHEN r.daily_taps >= 500 THEN 'low'
              ELSE 'very_low' END AS daily_volume_band
  FROM (SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date,
               CAST(SUM(total_taps) AS BIGINT) AS daily_taps, MAX(total_taps) AS peak_hour_taps,
               ROUND(AVG(total_taps), 6) AS avg_hour_taps, COUNT(DISTINCT tap_hour_utc) AS active_hours
        FROM fact_rh GROUP BY 1, 2) r
  LEFT JOIN (SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date,
                    SUM(CAST(ROUND(gross_fare_revenue_cad * 100) AS BIGINT)) AS cents,
                    SUM(CASE WHEN upper(fare_class) = 'CONCESSION' THEN paid_tap_count ELSE 0 END) AS concession_taps,
                    SUM(CASE WHEN upper(fare_class) = 'YOUTH' THEN paid_tap_count ELSE 0 END) AS youth_taps,
                    SUM(CASE WHEN upper(fare_class) = 'SENIOR' THEN paid_tap_count ELSE 0 END) AS senior_taps,
                    SUM(CASE WHEN upper(fare_class) = 'EMPLOYEE' THEN paid_tap_count ELSE 0 END) AS employee_taps
             FROM fact_fr GROUP BY 1, 2) f
  USING (station_id, service_date)""")


_cte("daily", (), """
  SELECT o.o_orderkey AS tap_id, o.o_custkey AS card_token, c.c_nationkey AS station_id, n.n_regionkey AS line_id,
         o.o_orderpriority AS fare_class, CAST(o.o_orderdate AS DATE) AS service_date,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS fare_amount_cad
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")


_cte("od_pairs", (), """
  SELECT c.c_nationkey AS origin, s.s_nationkey AS destination, COUNT(*) AS trips
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2""")


def compose(*parts: str) -> str:
    """``compose(cte_name..., final_select)``: a WITH query holding the named
    CTEs and all their dependencies."""
    *names, final = parts
    want: set[str] = set()
    by_name = {n: (d, b) for n, d, b in _CTES}

    def add(n):
        if n in want:
            return
        for d in by_name[n][0]:
            add(d)
        want.add(n)

    for n in names:
        add(n)
    body = ",\n".join(f"{n} AS ({b}\n)" for n, _, b in _CTES if n in want)
    return (f"WITH {body}\n{final}" if body else final).strip()
