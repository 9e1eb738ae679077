"""Reference-data scans, schema evolution, clustering, access bridge, recent-N."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.functions import columns as X
from railyard.operators import geo, governance as G, silver
from railyard import constants as C
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.plans.q_core import silver_of
from railyard.session import scratch_path
from railyard.sources import binding as B
from railyard.sources import bronze as BR
from railyard.sources import reference as RF

NETWORKS = ("net-a", "net-b")


@register("network_priors", compose("priors", "stations", """
SELECT s.network, CAST(p.station_id AS VARCHAR) AS station_id, ROUND(p.prior, 6) AS ridership_prior,
       ROUND(p.taps / SUM(p.taps) OVER (PARTITION BY s.network), 6) AS prior_normalised
FROM priors p JOIN (SELECT station_id, CASE WHEN line_id < 3 THEN 'net-a' ELSE 'net-b' END AS network
                    FROM stations) s USING (station_id)"""), "S13 S16 S12 U1 A20 D14")
def q_network_priors(spark, sf_dir):
    """Station seeds written one CSV directory per network, read back with
    the network scanner, priors renormalised per network."""
    pri = geo.station_priors(silver_of(spark, sf_dir))
    st = B.stations(spark, sf_dir).join(pri, "station_id").select(
        F.col("station_id").cast("string").alias("station_id"), "name",
        F.col("line_id").cast("string").alias("line"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), F.col("prior").alias("ridership_prior"),
        F.when(F.col("line_id") < 3, F.lit("net-a")).otherwise(F.lit("net-b")).alias("network"))
    root = scratch_path(spark, "networks")
    RF.write_network_stations(st, root)
    r = RF.renormalise_priors(RF.load_networks(spark, root, NETWORKS))
    return r.select("network", "station_id", X.r6("ridership_prior").alias("ridership_prior"),
                    X.r6("prior_normalised").alias("prior_normalised"))


@register("schema_evolution", compose("bronze", """
SELECT tap_id, station_id, CASE WHEN k = 97 THEN 'P' || CAST(tap_id AS VARCHAR) END AS promo_code FROM bronze"""),
    "S5")
def q_schema_evolution(spark, sf_dir):
    """A later batch adds ``promo_code``; the table is appended with the new
    column and read with merged schemas (older rows read NULL)."""
    b = B.bronze_taps(spark, sf_dir, with_k=True)
    path = scratch_path(spark, "evolving")
    RF.append_evolving(b.filter(F.col("k") != 97).select(*B.BRONZE_COLUMNS), path)
    RF.append_evolving(b.filter(F.col("k") == 97).select(*B.BRONZE_COLUMNS).withColumn(
        "promo_code", F.concat(F.lit("P"), F.col("tap_id").cast("string"))), path)
    return RF.read_evolving(spark, path).select("tap_id", "station_id", "promo_code")


@register("silver_clustered", compose("silver", """
SELECT * REPLACE (CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad) FROM silver"""), "O5")
def q_silver_clustered(spark, sf_dir):
    path = BR.write_clustered(silver_of(spark, sf_dir), scratch_path(spark, "silver-clustered"))
    return spark.read.parquet(path).select(*silver.SILVER_COLUMNS) \
                .withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))


@register("dim_user_access", compose("user_access", "SELECT * FROM user_access"), "G2 N4")
def q_dim_user_access(spark, sf_dir):
    return G.user_access(B.user_scopes(spark), B.stations(spark, sf_dir))


@register("recent_quarantine", compose("tagged_dq", """
SELECT tap_id, station_id, tap_type, ingest_timestamp_utc, array_to_string(reasons, ',') AS reasons
FROM tagged_dq WHERE len(reasons) > 0
ORDER BY ingest_timestamp_utc DESC, tap_id DESC LIMIT 200"""), "O3")
def q_recent_quarantine(spark, sf_dir):
    """The 200 most recent quarantined rows (the limit is the feature)."""
    q = silver.quarantine(B.bronze_taps(spark, sf_dir, with_violations=True), B.stations(spark, sf_dir))
    return q.orderBy(F.desc("ingest_timestamp_utc"), F.desc("tap_id")).limit(200)


def register_views(spark, sf_dir, prefix: str = "ry_") -> list[str]:
    """Ad-hoc SQL surface (S19): silver, facts and dimensions as temp views."""
    from railyard.operators import dims, gold
    s = silver_of(spark, sf_dir)
    views = {
        "silver_taps": s,
        "fact_ridership_hourly": gold.fact_ridership_hourly(s),
        "fact_fare_revenue": gold.fact_fare_revenue(s),
        "dim_station": dims.dim_station(B.stations(spark, sf_dir), B.lines(spark, sf_dir)),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]


@register("sql_surface", compose("fact_rh", "fact_fr", "stations", "lines", """
SELECT l.line_name, CAST(SUM(r.total_taps) AS BIGINT) AS total_taps,
       ROUND(CAST(SUM(CAST(v.rev AS DECIMAL(18,2))) AS DOUBLE), 2) AS fare_revenue
FROM fact_rh r
JOIN stations s USING (station_id)
JOIN lines l ON l.line_id = s.line_id
LEFT JOIN (SELECT station_id, tap_hour_utc, SUM(gross_fare_revenue_cad) AS rev FROM fact_fr GROUP BY 1, 2) v
  USING (station_id, tap_hour_utc)
GROUP BY 1"""), "S19 J10 P10")
def q_sql_surface(spark, sf_dir):
    """An analyst's SQL over the registered views."""
    register_views(spark, sf_dir)
    return spark.sql("""
        SELECT d.line_name, SUM(r.total_taps) AS total_taps,
               ROUND(CAST(SUM(CAST(v.rev AS DECIMAL(18,2))) AS DOUBLE), 2) AS fare_revenue
        FROM ry_fact_ridership_hourly r
        JOIN ry_dim_station d USING (station_id)
        LEFT JOIN (SELECT station_id, tap_hour_utc, SUM(gross_fare_revenue_cad) AS rev
                   FROM ry_fact_fare_revenue GROUP BY station_id, tap_hour_utc) v
          USING (station_id, tap_hour_utc)
        GROUP BY d.line_name""")


@register("governed_sql", compose("silver", "user_access", """
SELECT u.user_principal_name AS as_user, s.station_id, COUNT(*) AS taps, COUNT(DISTINCT s.card_token) AS riders,
       MIN(CASE WHEN u.role = 'executive' THEN CAST(s.card_token AS VARCHAR)
                ELSE sha256('railyard' || CAST(s.card_token AS VARCHAR)) END) AS first_card
FROM silver s JOIN user_access u USING (station_id) GROUP BY 1, 2"""), "S19 G1 G3 X1")
def q_governed_sql(spark, sf_dir):
    """One statement over one view, run for each user: other rows, other cards."""
    access = G.user_access(B.user_scopes(spark), B.stations(spark, sf_dir))
    s, out = silver_of(spark, sf_dir), None
    for user in [scope[0] for scope in C.USER_SCOPES]:
        G.register_functions(spark, access, "railyard", as_user=user)
        G.governed_view(spark, "taps", s, masked=("card_token",))
        seen = spark.sql("""SELECT as_user, station_id, count(*) AS taps, count(DISTINCT card_token) AS riders,
                                   min(card_token) AS first_card
                            FROM (SELECT ry_user() AS as_user, station_id, card_token FROM ry_taps)
                            GROUP BY as_user, station_id""")
        out = seen if out is None else out.unionByName(seen)
    return out


@register("silver_zordered", compose("silver", """
SELECT * REPLACE (CAST(fare_amount_cad AS DOUBLE) AS fare_amount_cad) FROM silver"""), "O5")
def q_silver_zordered(spark, sf_dir):
    path = BR.write_zordered(silver_of(spark, sf_dir), scratch_path(spark, "silver-zordered"), ("date_key", "station_id"))
    return spark.read.parquet(path).select(*silver.SILVER_COLUMNS) \
                .withColumn("fare_amount_cad", F.col("fare_amount_cad").cast("double"))
