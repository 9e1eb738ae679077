"""Governance: user-access bridge, row filters and column masks.

The access bridge is built per scope kind with equi-joins or filters on the
station dimension; the row filter is a
``left_semi`` join on ``station_id``, so facts are never duplicated by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard import constants as C


def user_access(scopes: DataFrame, stations: DataFrame) -> DataFrame:
    """(user_principal_name, role, station_id) from role scopes (G2):
    ``all`` -> every station, ``all_but_pilots`` -> all but experimental pilot
    stations, ``line`` -> stations of that line,
    ``stations`` -> the listed stations the dimension knows."""
    st = stations.select("station_id", "line_id")
    # each station carries the scope words that cover it, so these scopes are an equi-join too
    words = F.array_compact(F.array(F.lit("all"), F.when(~F.col("station_id").isin(*C.PILOT_STATIONS),
                                                         F.lit("all_but_pilots"))))
    every = scopes.join(st.select("station_id", F.explode(words).alias("_scope")), F.col("scope") == F.col("_scope")) \
        .select("user_principal_name", "role", "station_id")
    by_line = scopes.filter(F.col("scope") == "line") \
        .join(st, F.col("scope_line") == st.line_id).select("user_principal_name", "role", "station_id")
    listed = scopes.filter(F.col("scope") == "stations") \
        .select("user_principal_name", "role", F.explode("scope_stations").alias("station_id")) \
        .join(st.select("station_id"), "station_id").select("user_principal_name", "role", "station_id")
    return every.unionByName(by_line).unionByName(listed)


def row_filter(df: DataFrame, access: DataFrame, user: str | Column | None = None) -> DataFrame:
    """Rows of ``df`` whose station the user may see (G1).  ``user`` defaults
    to the session's ``current_user()``."""
    u = F.current_user() if user is None else (F.lit(user) if isinstance(user, str) else user)
    allowed = access.filter(F.col("user_principal_name") == u).select("station_id").distinct()
    return df.join(allowed, "station_id", "left_semi")


def visible_counts(df: DataFrame, access: DataFrame) -> DataFrame:
    """Visible row count per user and role (G4): one equi-join, one grouped
    count; each fact row meets only the users granted its station."""
    per_station = df.groupBy("station_id").agg(F.count(F.lit(1)).alias("_n"))
    return access.join(per_station, "station_id", "left").groupBy("user_principal_name", "role") \
                 .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("visible_rows"),
                      F.countDistinct("station_id").alias("visible_stations"))


def in_role(access: DataFrame, user: str, role: str) -> Column:
    """Whether the access table grants ``user`` the role (one row is read)."""
    hit = access.filter((F.col("user_principal_name") == user) & (F.col("role") == role)).limit(1).count()
    return F.lit(hit > 0)


def mask(col: str, is_member: Column, salt: str) -> Column:
    """Column mask (G3): the value for members, else a salted SHA-256.  The
    salt is a secret of the deployment (``spark.railyard.pii.salt``)."""
    return F.when(is_member, F.col(col).cast("string")).otherwise(
        F.sha2(F.concat(F.lit(salt), F.col(col).cast("string")), 256))


# --- governed SQL (S19, G1, G3) -------------------------------------------------------
def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession, access: DataFrame, salt: str, as_user: str | None = None,
                       clear_role: str = "executive", prefix: str = "ry_") -> None:
    """SQL functions that views use to filter rows and mask columns:
    ``<prefix>user()`` (the session's ``current_user()``, or a user that a service
    acts for), ``<prefix>may_see(station)`` and ``<prefix>masked(value)``, which
    shows the value to ``clear_role`` and a salted digest to all others.  They
    are inlined into plans, so the filter is a semi join on the access bridge."""
    access.createOrReplaceTempView(f"{prefix}user_access")
    user = "current_user()" if as_user is None else _text(as_user)
    mine = f"{prefix}user_access a WHERE a.user_principal_name = {user}"

    def define(signature: str, kind: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURNS {kind} RETURN {body}")

    define("user()", "STRING", user)
    define("may_see(station INT)", "BOOLEAN", f"EXISTS (SELECT 1 FROM {mine} AND a.station_id = station)")
    define("masked(value STRING)", "STRING",
           f"CASE WHEN (SELECT count(*) FROM {mine} AND a.role = {_text(clear_role)}) > 0 THEN value "
           f"ELSE sha2(concat({_text(salt)}, value), 256) END")


def governed_view(spark: SparkSession, name: str, df: DataFrame, masked=(), prefix: str = "ry_") -> None:
    """A view of ``df`` that shows the user's stations only, ``masked`` columns
    through the mask."""
    df.createOrReplaceTempView(f"{prefix}all_{name}")
    cols = ", ".join(f"{prefix}masked(CAST(`{c}` AS STRING)) AS `{c}`" if c in masked else f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} AS SELECT {cols} FROM {prefix}all_{name} "
              f"WHERE {prefix}may_see(station_id)")
