"""Semantic measures, time intelligence, roll-ups and governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X
from railyard.operators import geo, governance as G, marts, semantic as S
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import _cte, compose
from railyard.plans.q_core import facts_of, silver_of
from railyard.sources import binding as B

_MONEY = "ROUND(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE), 2)"


@register("slice_zone", compose("fact_fr", f"""
SELECT zone, fare_class, CAST(GROUPING(zone, fare_class) AS INTEGER) AS grouping_level,
       {_MONEY.format(c='gross_fare_revenue_cad')} AS fare_revenue, CAST(SUM(paid_tap_count) AS BIGINT) AS paid_taps
FROM (SELECT * REPLACE (CAST(zone * 10 + station_id % 2 AS INTEGER) AS zone) FROM fact_fr)
GROUP BY ROLLUP (zone, fare_class)"""), "A18")
def q_slice_zone(spark, sf_dir):
    """Zone slice, two zones on every line."""
    _, v = facts_of(spark, sf_dir)
    return S.slice_rollup(v.withColumn("zone", (F.col("zone") * 10 + F.col("station_id") % 2).cast("int")),
                          ("zone", "fare_class"))


@register("slice_rollup", compose("fact_fr", f"""
SELECT line_id, station_id, fare_class, CAST(GROUPING(line_id, station_id, fare_class) AS INTEGER) AS grouping_level,
       {_MONEY.format(c='gross_fare_revenue_cad')} AS fare_revenue, CAST(SUM(paid_tap_count) AS BIGINT) AS paid_taps
FROM fact_fr GROUP BY ROLLUP (line_id, station_id, fare_class)"""), "A18")
def q_slice_rollup(spark, sf_dir):
    _, v = facts_of(spark, sf_dir)
    return S.slice_rollup(v)


@register("slice_cube", compose("fact_fr", f"""
SELECT line_id, fare_class, CAST(GROUPING(line_id, fare_class) AS INTEGER) AS grouping_level,
       {_MONEY.format(c='gross_fare_revenue_cad')} AS fare_revenue, CAST(SUM(paid_tap_count) AS BIGINT) AS paid_taps
FROM fact_fr GROUP BY CUBE (line_id, fare_class)"""), "A18")
def q_slice_cube(spark, sf_dir):
    _, v = facts_of(spark, sf_dir)
    return S.slice_cube(v)


@register("grain_rollup", compose("fact_rh", "\nUNION ALL ".join(
    f"""SELECT '{g}' AS grain, date_trunc('{g}', tap_hour_utc) AS period_start,
       CAST(SUM(total_taps) AS BIGINT) AS total_taps, CAST(SUM(unique_riders) AS BIGINT) AS ridership,
       {_MONEY.format(c='total_fare_cad')} AS total_fare_cad FROM fact_rh GROUP BY 1, 2""" for g in S.GRAINS)), "A17")
def q_grain_rollup(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return S.grain_rollup(r)


@register("top_stations", compose("fact_rh", """
SELECT * FROM (
  SELECT line_id, station_id, CAST(SUM(total_taps) AS BIGINT) AS taps,
         CAST(ROW_NUMBER() OVER (PARTITION BY line_id ORDER BY SUM(total_taps) DESC, station_id) AS INTEGER) AS rank
  FROM fact_rh GROUP BY 1, 2) WHERE rank <= 3"""), "O2 O4")
def q_top_stations(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return S.top_stations(r, 3)


@register("prior_normalised", compose("silver", """
SELECT station_id, COUNT(*) AS taps, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS prior
FROM silver GROUP BY 1"""), "A20 D14")
def q_prior_normalised(spark, sf_dir):
    p = geo.station_priors(silver_of(spark, sf_dir))
    return p.select("station_id", "taps", X.r6("prior").alias("prior"))


_MIX = ", ".join(f"('{c}', CAST({v} AS DOUBLE))" for c, v in C.FARE_CLASS_DISTRIBUTION)
_FARES = ", ".join(f"('{c}', CAST({v} AS DOUBLE))" for c, v in C.FARE_BY_CLASS)


@register("fare_mix", compose("silver", f"""
SELECT coalesce(o.fare_class, e.fare_class) AS fare_class, CAST(coalesce(o.taps, 0) AS BIGINT) AS taps,
       ROUND(coalesce(o.share, 0.0), 6) AS observed_share, ROUND(e.expected_share, 6) AS expected_share,
       ROUND(coalesce(o.share, 0.0) - e.expected_share, 6) AS share_gap,
       f.list_fare_cad,
       ROUND(CAST(o.fare AS DOUBLE) / NULLIF(o.taps, 0), 6) AS avg_fare_cad
FROM (SELECT fare_class, COUNT(*) AS taps, SUM(fare_amount_cad) AS fare, COUNT(*) / SUM(COUNT(*)) OVER () AS share
      FROM silver GROUP BY 1) o
FULL JOIN (SELECT * FROM (VALUES {_MIX}) t(fare_class, expected_share)) e USING (fare_class)
LEFT JOIN (SELECT * FROM (VALUES {_FARES}) t(fare_class, list_fare_cad)) f
  ON f.fare_class = coalesce(o.fare_class, e.fare_class)"""), "A21 F17")
def q_fare_mix(spark, sf_dir):
    return S.fare_mix(silver_of(spark, sf_dir))


_cte("daily_totals", ("daily",), """
  SELECT service_date, COUNT(*) AS taps, SUM(fare_amount_cad) AS revenue, COUNT(DISTINCT card_token) AS riders
  FROM daily GROUP BY 1""")


@register("mtd_qtd_ytd", compose("daily_totals", """
SELECT service_date, ROUND(CAST(revenue AS DOUBLE), 2) AS value,
       ROUND(CAST(SUM(revenue) OVER (PARTITION BY year(service_date), month(service_date) ORDER BY service_date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS mtd,
       ROUND(CAST(SUM(revenue) OVER (PARTITION BY year(service_date), quarter(service_date) ORDER BY service_date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS qtd,
       ROUND(CAST(SUM(revenue) OVER (PARTITION BY year(service_date) ORDER BY service_date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS ytd
FROM daily_totals"""), "W4 M4")
def q_mtd_qtd_ytd(spark, sf_dir):
    return S.to_date_running(S.daily_totals(B.daily_orders(spark, sf_dir)), "revenue")


@register("yoy", compose("daily_totals", """
SELECT c.service_date, ROUND(CAST(c.taps AS DOUBLE), 2) AS value, ROUND(CAST(p.taps AS DOUBLE), 2) AS prior_year_value,
       ROUND(CAST(c.taps - p.taps AS DOUBLE) / NULLIF(p.taps, 0) * 100, 6) AS yoy_pct
FROM daily_totals c LEFT JOIN daily_totals p ON p.service_date = CAST(c.service_date - INTERVAL 12 MONTH AS DATE)"""),
    "W5 M3")
def q_yoy(spark, sf_dir):
    return S.prior_year(S.daily_totals(B.daily_orders(spark, sf_dir)), "taps")


@register("prior_period", compose("daily_totals", """
SELECT month_start, ROUND(CAST(value AS DOUBLE), 2) AS value, ROUND(CAST(prior_value AS DOUBLE), 2) AS prior_value,
       ROUND(CAST(value - prior_value AS DOUBLE) / NULLIF(prior_value, 0) * 100, 6) AS pct_change
FROM (SELECT s.month_start, coalesce(m.value, 0) AS value,
             LAG(coalesce(m.value, 0)) OVER (ORDER BY s.month_start) AS prior_value
      FROM (SELECT CAST(unnest(generate_series(min(m0), max(m0), INTERVAL 1 MONTH)) AS DATE) AS month_start
            FROM (SELECT CAST(date_trunc('month', service_date) AS DATE) AS m0 FROM daily_totals)) s
      LEFT JOIN (SELECT CAST(date_trunc('month', service_date) AS DATE) AS month_start, SUM(revenue) AS value
                 FROM daily_totals GROUP BY 1) m USING (month_start))"""), "W6")
def q_prior_period(spark, sf_dir):
    return S.prior_period(S.daily_totals(B.daily_orders(spark, sf_dir)), "revenue")


@register("prior_period_gap", compose("daily_totals", """
SELECT month_start, ROUND(CAST(value AS DOUBLE), 2) AS value, ROUND(CAST(prior_value AS DOUBLE), 2) AS prior_value,
       ROUND(CAST(value - prior_value AS DOUBLE) / NULLIF(prior_value, 0) * 100, 6) AS pct_change
FROM (SELECT s.month_start, coalesce(m.value, 0) AS value,
             LAG(coalesce(m.value, 0)) OVER (ORDER BY s.month_start) AS prior_value
      FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS month_start) s
      LEFT JOIN (SELECT CAST(date_trunc('month', service_date) AS DATE) AS month_start, SUM(revenue) AS value
                 FROM daily_totals WHERE date_trunc('month', service_date) NOT IN (DATE '1997-03-01', DATE '1999-11-01')
                 GROUP BY 1) m USING (month_start))"""), "W6")
def q_prior_period_gap(spark, sf_dir):
    """Two months without a row are zero months, not skipped ones."""
    rows = B.daily_orders(spark, sf_dir).filter(
        ~F.trunc("service_date", "month").isin(F.lit("1997-03-01").cast("date"), F.lit("1999-11-01").cast("date")))
    return S.prior_period(S.daily_totals(rows), "revenue")


@register("station_volume_bands", compose("fact_rh", """
SELECT station_id, service_date, daily_taps, CASE WHEN daily_taps >= 50000 THEN 'very_high' WHEN daily_taps >= 20000 THEN 'high'
       WHEN daily_taps >= 5000 THEN 'medium' WHEN daily_taps >= 500 THEN 'low' ELSE 'very_low' END AS daily_volume_band
FROM (SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date,
             CAST(SUM(total_taps) * [1, 60, 600, 2500, 20000][station_id % 5 + 1] AS BIGINT) AS daily_taps
      FROM fact_rh GROUP BY station_id, 2)"""), "P7")
def q_station_volume_bands(spark, sf_dir):
    """Daily taps of stations scaled up so that all five bands occur."""
    r, _ = facts_of(spark, sf_dir)
    scale = F.element_at(F.array(*[F.lit(x) for x in (1, 60, 600, 2500, 20000)]), (F.col("station_id") % 5 + 1).cast("int"))
    per = r.groupBy("station_id", F.to_date("tap_hour_utc").alias("service_date")).agg(F.sum("total_taps").alias("_t"))
    per = per.select("station_id", "service_date", (F.col("_t") * scale).cast("bigint").alias("daily_taps"))
    return per.withColumn("daily_volume_band", X.volume_band("daily_taps"))


@register("peak_hour_share", compose("fact_rh", f"""
SELECT station_id, ROUND(CAST(SUM(CASE WHEN extract(hour FROM tap_hour_utc) IN ({', '.join(map(str, C.PEAK_HOURS))})
                                     THEN total_taps ELSE 0 END) AS DOUBLE) / NULLIF(SUM(total_taps), 0), 6) AS peak_hour_share
FROM fact_rh GROUP BY 1"""), "M5")
def q_peak_hour_share(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return S.peak_hour_share(r)


@register("revenue_per_tap", compose("fact_fr", f"""
SELECT station_id, {_MONEY.format(c='gross_fare_revenue_cad')} AS fare_revenue,
       CAST(SUM(paid_tap_count) AS BIGINT) AS paid_taps, CAST(SUM(paying_riders) AS BIGINT) AS paying_rider_hours,
       ROUND(CAST(SUM(CAST(gross_fare_revenue_cad AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(SUM(paid_tap_count), 0), 6) AS revenue_per_tap,
       ROUND(CAST(SUM(CAST(gross_fare_revenue_cad AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(SUM(paying_riders), 0), 6) AS revenue_per_rider
FROM fact_fr GROUP BY 1"""), "M6 M7 M13")
def q_revenue_per_tap(spark, sf_dir):
    _, v = facts_of(spark, sf_dir)
    return S.revenue_per_tap(v)


@register("daily_measures", compose("fact_rh", f"""
SELECT CAST(tap_hour_utc AS DATE) AS service_date, CAST(SUM(unique_riders) AS BIGINT) AS ridership,
       CAST(SUM(total_taps) AS BIGINT) AS daily_taps, {_MONEY.format(c='total_fare_cad')} AS fare_revenue,
       COUNT(DISTINCT tap_hour_utc) AS active_hours
FROM fact_rh GROUP BY 1"""), "M1 M2 M6 M10")
def q_daily_measures(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    m = S.measures()
    return r.groupBy(F.to_date("tap_hour_utc").alias("service_date")).agg(
        *[c.alias(n) for n, c in m.items()])


@register("active_hours", compose("fact_rh", """
SELECT station_id, COUNT(DISTINCT tap_hour_utc) AS active_hours,
       COUNT(DISTINCT CAST(tap_hour_utc AS DATE)) AS active_days
FROM fact_rh GROUP BY 1"""), "M10 A7")
def q_active_hours(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return r.groupBy("station_id").agg(F.countDistinct("tap_hour_utc").alias("active_hours"),
                                       F.countDistinct(F.to_date("tap_hour_utc")).alias("active_days"))


@register("event_day_uplift_pct", compose("fact_rh", "uplift_static", "event_days", """
SELECT m8.station_id,
       ROUND((m8.e / NULLIF(m8.n, 0.0) - 1) * 100, 6) AS event_day_uplift_pct,
       m9.uplift_multiplier_pct
FROM (SELECT station_id, AVG(CASE WHEN is_event_day THEN t END) AS e, AVG(CASE WHEN NOT is_event_day THEN t END) AS n
      FROM (SELECT d.station_id, d.t, coalesce(e.is_event_day, false) AS is_event_day
            FROM (SELECT station_id, CAST(tap_hour_utc AS DATE) AS service_date, SUM(total_taps) AS t
                  FROM fact_rh GROUP BY 1, 2) d LEFT JOIN event_days e USING (service_date))
      GROUP BY 1) m8
LEFT JOIN (SELECT station_id, ROUND(AVG(uplift_multiplier) * 100, 6) + 0.0 AS uplift_multiplier_pct
           FROM (SELECT station_id, uplift_multiplier FROM uplift_static) GROUP BY 1) m9 USING (station_id)"""),
    "M8 M9 F18")
def q_event_day_uplift_pct(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return S.event_day_uplift_pct(r, marts.uplift_static(r), geo.event_days(B.event_calendar(spark)))


def _run_sql(m, *keys):
    return (f"CAST(SUM({m}) OVER (PARTITION BY {', '.join(f'{k}(service_date)' for k in keys)} ORDER BY service_date "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)")


@register("measure_variants", compose("daily_totals", "\nUNION ALL ".join(f"""
SELECT c.service_date, '{m}' AS measure, v.variant, ROUND(v.value, 2) AS value
FROM (SELECT service_date, CAST({m} AS DOUBLE) AS cur, {_run_sql(m, 'year', 'month')} AS mtd,
             {_run_sql(m, 'year', 'quarter')} AS qtd, {_run_sql(m, 'year')} AS ytd FROM daily_totals) c
LEFT JOIN (SELECT service_date, CAST({m} AS DOUBLE) AS py FROM daily_totals) p
  ON p.service_date = CAST(c.service_date - INTERVAL 12 MONTH AS DATE)
LEFT JOIN (SELECT service_date, CAST({m} AS DOUBLE) AS pp FROM daily_totals) q
  ON q.service_date = CAST(c.service_date - INTERVAL 1 MONTH AS DATE),
LATERAL (SELECT * FROM (VALUES ('current', c.cur), ('mtd', c.mtd), ('qtd', c.qtd), ('ytd', c.ytd), ('prior_year', p.py),
                        ('pct_yoy', (c.cur - p.py) / nullif(p.py, 0) * 100), ('prior_period', q.pp),
                        ('pct_prior_period', (c.cur - q.pp) / nullif(q.pp, 0) * 100))
         t(variant, value)) v""" for m in ("taps", "revenue"))), "M12 M13")
def q_measure_variants(spark, sf_dir):
    return S.measure_variants(S.daily_totals(B.daily_orders(spark, sf_dir)), ["taps", "revenue"])


# --- governance -------------------------------------------------------------------------
def _access(spark, sf_dir):
    return G.user_access(B.user_scopes(spark), B.stations(spark, sf_dir))


_cte("user_access", ("stations",), """
  SELECT 'all@example.com' AS user_principal_name, 'executive' AS role, station_id FROM stations
  UNION ALL SELECT 'line0@example.com', 'operations-line0', station_id FROM stations WHERE line_id = 0
  UNION ALL SELECT 'partner@example.com', 'external-partner', station_id FROM stations WHERE station_id IN (7)
  UNION ALL SELECT 'analyst@example.com', 'analyst', station_id FROM stations WHERE station_id NOT IN (3, 11)""")


@register("rls_rows", compose("fact_rh", "user_access", """
SELECT * FROM fact_rh WHERE station_id IN
  (SELECT station_id FROM user_access WHERE user_principal_name = 'line0@example.com')"""), "G1 J8")
def q_rls_rows(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return G.row_filter(r, _access(spark, sf_dir), "line0@example.com")


@register("rls_counts_by_role", compose("fact_rh", "user_access", """
SELECT a.user_principal_name, a.role, CAST(coalesce(SUM(f.n), 0) AS BIGINT) AS visible_rows,
       COUNT(DISTINCT a.station_id) AS visible_stations
FROM user_access a LEFT JOIN (SELECT station_id, COUNT(*) AS n FROM fact_rh GROUP BY 1) f USING (station_id)
GROUP BY 1, 2"""), "G2 G4")
def q_rls_counts_by_role(spark, sf_dir):
    r, _ = facts_of(spark, sf_dir)
    return G.visible_counts(r, _access(spark, sf_dir))


# the salt of the test tables; a deployment sets spark.railyard.pii.salt
_TEST_SALT = "railyard"


@register("pii_masked", compose("silver", f"""
SELECT tap_id, station_id, sha256('{_TEST_SALT}' || CAST(card_token AS VARCHAR)) AS card_token
FROM silver"""), "G3")
def q_pii_masked(spark, sf_dir):
    """As the external partner sees it: the access table grants no other role."""
    s = silver_of(spark, sf_dir)
    member = G.in_role(_access(spark, sf_dir), "partner@example.com", "executive")
    salt = spark.conf.get("spark.railyard.pii.salt", _TEST_SALT)
    return s.select("tap_id", "station_id", G.mask("card_token", member, salt).alias("card_token"))
