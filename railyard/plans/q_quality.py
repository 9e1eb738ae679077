"""Data-quality checks, freshness and retention (Q1-Q17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard import constants as C
from railyard.operators import gold, quality as Q, silver
from railyard.plans.catalog import register
from railyard.plans.oracle_sql import compose
from railyard.plans.q_core import silver_of
from railyard.sources import binding as B
from railyard.sources import contracts as CT

BRONZE = "bronze.afc_taps"
SILVER = "silver.afc_taps"
FACT = "gold.fact_ridership_hourly"
REVENUE = "gold.fact_fare_revenue"
STATIONS = "bronze.stations"


def _status_sql(failed: str, severity: str) -> str:
    return (f"CASE WHEN {failed} = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END")


def rules_sql(cte: str, table: str, rules: list[tuple[str, str, str, str]]) -> str:
    """rules: (check_id, column, failing-row predicate, severity)."""
    parts = []
    for check_id, col, pred, sev in rules:
        f = f"CAST(count_if({pred}) AS BIGINT)"
        parts.append(f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, '{col}' AS column_name, "
                     f"{f} AS failed_rows, CAST(COUNT(*) AS BIGINT) AS total_rows, {_status_sql(f, sev)} AS status "
                     f"FROM {cte}")
    return "\nUNION ALL ".join(parts)


def unique_sql(cte: str, table: str, keys: list[str], severity: str, check_id: str = "unique") -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    f = "CAST(coalesce(SUM(CASE WHEN c > 1 AND nn THEN c END), 0) AS BIGINT)"
    return (f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, '{'+'.join(keys)}' AS column_name, "
            f"{f} AS failed_rows, CAST(coalesce(SUM(c), 0) AS BIGINT) AS total_rows, {_status_sql(f, severity)} AS status "
            f"FROM (SELECT {k}, COUNT(*) AS c, bool_and({nn}) AS nn FROM {cte} GROUP BY {k})")


def rel_sql(cte: str, table: str, col: str, parent: str, pcol: str, severity: str = "error") -> str:
    f = f"CAST(count_if(c.{col} IS NOT NULL AND p.k IS NULL) AS BIGINT)"
    return (f"SELECT 'relationships' AS check_id, '{table}' AS table_name, '{col}' AS column_name, "
            f"{f} AS failed_rows, CAST(COUNT(*) AS BIGINT) AS total_rows, {_status_sql(f, severity)} AS status "
            f"FROM {cte} c LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM {parent}) p ON c.{col} = p.k")


def _bronze_dq(spark, sf_dir):
    return B.bronze_taps(spark, sf_dir, with_violations=True)


def _faulty_fact(spark, sf_dir):
    return B.faulty_fact(gold.fact_ridership_hourly(silver_of(spark, sf_dir)))


# --- Q1 not_null -------------------------------------------------------------------
_NN_BRONZE = ["tap_id", "card_token", "station_id", "tap_timestamp_utc"]
_NN_FACT = ["date_key", "tap_hour_utc", "station_id", "line_id"]


@register("dq_not_null", compose("bronze_faulty", "fact_faulty", "\nUNION ALL ".join([
    rules_sql("bronze_faulty", BRONZE, [("not_null", c, f"{c} IS NULL", "error") for c in _NN_BRONZE]),
    rules_sql("fact_faulty", FACT, [("not_null", c, f"{c} IS NULL", "error") for c in _NN_FACT])])), "Q1")
def q_dq_not_null(spark, sf_dir):
    return Q.union_all([
        Q.run_rules(B.faulty_taps(spark, sf_dir), BRONZE, [Q.not_null(c) for c in _NN_BRONZE]),
        Q.run_rules(_faulty_fact(spark, sf_dir), FACT, [Q.not_null(c) for c in _NN_FACT])])


# --- Q2 unique (bronze warns, silver errors: D19) -----------------------------------
@register("dq_unique", compose("bronze_dq", "silver", "stations", "\nUNION ALL ".join([
    unique_sql("bronze_dq", BRONZE, ["tap_id"], "warn"),
    unique_sql("silver", SILVER, ["tap_id"], "error"),
    unique_sql("stations", STATIONS, ["station_id"], "error")])), "Q2 Q17 D19")
def q_dq_unique(spark, sf_dir):
    return Q.union_all([
        Q.unique(_bronze_dq(spark, sf_dir), BRONZE, "tap_id", "warn"),
        Q.unique(silver_of(spark, sf_dir), SILVER, "tap_id", "error"),
        Q.unique(B.stations(spark, sf_dir), STATIONS, "station_id", "error")])


# --- Q3 relationships ------------------------------------------------------------------
@register("dq_relationships", compose("bronze_dq", "fact_rh", "stations", "lines", "\nUNION ALL ".join([
    rel_sql("bronze_dq", BRONZE, "station_id", "stations", "station_id"),
    rel_sql("fact_rh", FACT, "station_id", "stations", "station_id"),
    rel_sql("fact_rh", FACT, "line_id", "lines", "line_id")])), "Q3 J9")
def q_dq_relationships(spark, sf_dir):
    st, ln = B.stations(spark, sf_dir), B.lines(spark, sf_dir)
    fact = gold.fact_ridership_hourly(silver_of(spark, sf_dir))
    return Q.union_all([
        Q.relationships(_bronze_dq(spark, sf_dir), BRONZE, "station_id", st, "station_id"),
        Q.relationships(fact, FACT, "station_id", st, "station_id"),
        Q.relationships(fact, FACT, "line_id", ln, "line_id")])


# --- Q4 accepted values ---------------------------------------------------------------------
def _in_list(vals):
    return ", ".join(f"'{v}'" for v in vals)


@register("dq_accepted_values", compose("bronze_dq", "fact_fr", "\nUNION ALL ".join([
    rules_sql("bronze_dq", BRONZE, [
        ("accepted_values", "fare_class", f"NOT coalesce(fare_class IN ({_in_list(C.FARE_CLASSES)}), true)", "error"),
        ("accepted_values", "tap_type", f"NOT coalesce(tap_type IN ({_in_list(C.TAP_TYPES)}), true)", "error")]),
    rules_sql("fact_fr", REVENUE, [
        ("accepted_values", "fare_class", f"NOT coalesce(fare_class IN ({_in_list(C.FARE_CLASSES)}), true)", "error")])])),
    "Q4 P5 D22")
def q_dq_accepted_values(spark, sf_dir):
    return Q.union_all([
        Q.run_rules(_bronze_dq(spark, sf_dir), BRONZE, [Q.accepted_values("fare_class", C.FARE_CLASSES),
                                                        Q.accepted_values("tap_type", C.TAP_TYPES)]),
        Q.run_rules(gold.fact_fare_revenue(silver_of(spark, sf_dir)), REVENUE,
                    [Q.accepted_values("fare_class", C.FARE_CLASSES)])])


# --- Q5 / Q12 / Q17 ranges -------------------------------------------------------------------
_RANGE_FACT = ["tap_on_count", "tap_off_count", "total_taps", "unique_riders", "total_fare_cad"]


@register("dq_range", compose("bronze_faulty", "fact_faulty", "stations_faulty", "\nUNION ALL ".join([
    rules_sql("bronze_faulty", BRONZE, [("between", "fare_amount_cad", "fare_amount_cad < 0", "error")]),
    rules_sql("fact_faulty", FACT, [("between", c, f"{c} < 0", "error") for c in _RANGE_FACT]),
    rules_sql("stations_faulty", STATIONS, [
        ("between", "lat", "NOT coalesce(lat BETWEEN -90 AND 90, true)", "error"),
        ("between", "lon", "NOT coalesce(lon BETWEEN -180 AND 180, true)", "error")])])), "Q5 Q12 Q17")
def q_dq_range(spark, sf_dir):
    st = B.faulty_stations(spark, sf_dir)
    return Q.union_all([
        Q.run_rules(B.faulty_taps(spark, sf_dir), BRONZE, [Q.at_least("fare_amount_cad", 0)]),
        Q.run_rules(_faulty_fact(spark, sf_dir), FACT, [Q.at_least(c, 0) for c in _RANGE_FACT]),
        Q.run_rules(st, STATIONS, [Q.Rule("between", "lat", F.coalesce(~F.col("lat").between(-90, 90), F.lit(False))),
                                   Q.Rule("between", "lon", F.coalesce(~F.col("lon").between(-180, 180), F.lit(False)))])])


# --- Q10 composite key ------------------------------------------------------------------------
@register("dq_composite_key", compose("fact_faulty", "\nUNION ALL ".join([
    unique_sql("fact_faulty", FACT, ["station_id", "tap_hour_utc"], "error", "composite_key")])), "Q10 D11")
def q_dq_composite_key(spark, sf_dir):
    return Q.unique(_faulty_fact(spark, sf_dir), FACT, ["station_id", "tap_hour_utc"], "error", "composite_key")


# --- Q11 cross-column rules ----------------------------------------------------------------------
@register("dq_row_rules", compose("fact_faulty", rules_sql("fact_faulty", FACT, [
    ("taps_add_up", "*", "NOT coalesce(total_taps = tap_on_count + tap_off_count, false)", "error"),
    ("riders_le_taps", "*", "NOT coalesce(unique_riders <= total_taps, false)", "error")])), "Q11")
def q_dq_row_rules(spark, sf_dir):
    return Q.run_rules(_faulty_fact(spark, sf_dir), FACT, [
        Q.row_rule("taps_add_up", F.col("total_taps") == F.col("tap_on_count") + F.col("tap_off_count")),
        Q.row_rule("riders_le_taps", F.col("unique_riders") <= F.col("total_taps"))])


# --- Q12 regex, F21, F22 ---------------------------------------------------------------------------
@register("dq_regex", compose("bronze_faulty", "stations_faulty", "\nUNION ALL ".join([
    rules_sql("bronze_faulty", BRONZE, [
        ("regex", "schema_version", f"NOT coalesce(regexp_full_match(schema_version, '{C.SCHEMA_VERSION_PATTERN[1:-1]}'), true)", "error"),
        ("regex", "device_id", "NOT coalesce(regexp_full_match(device_id, 'reader-[0-9]+-[1-4]'), true)", "warn")]),
    rules_sql("stations_faulty", STATIONS, [
        ("id_format", "name", "NOT (regexp_full_match(trim(upper(name)), '[A-Za-z0-9]+') OR contains(trim(upper(name)), '_'))", "error")])])),
    "Q12 F21 F22 D24")
def q_dq_regex(spark, sf_dir):
    from railyard.functions import columns as X
    st = B.faulty_stations(spark, sf_dir)
    return Q.union_all([
        Q.run_rules(B.faulty_taps(spark, sf_dir), BRONZE, [
            Q.matches("schema_version", C.SCHEMA_VERSION_PATTERN),
            Q.matches("device_id", "^reader-[0-9]+-[1-4]$", "warn")]),
        Q.run_rules(st, STATIONS, [Q.Rule("id_format", "name", ~X.id_is_valid(X.normalise_id("name")))])])


# --- Q13 freshness (D15: silver freshness uses the ingest time) ------------------------------------
FRESH_AS_OF = "2024-01-31 00:30:00"


def _fresh_sql(cte, table, warn, err):
    age = f"(epoch_us(TIMESTAMP '{FRESH_AS_OF}') - epoch_us(max(ingest_timestamp_utc))) / 60000000.0"
    return (f"SELECT '{table}' AS table_name, max(ingest_timestamp_utc) AS max_loaded_at, ROUND({age}, 6) AS age_minutes, "
            f"CASE WHEN {age} > {err} THEN 'error' WHEN {age} > {warn} THEN 'warn' ELSE 'pass' END AS status FROM {cte}")


@register("freshness_status", compose("bronze", "silver", "\nUNION ALL ".join([
    _fresh_sql("bronze", BRONZE, *C.FRESHNESS_TIERS["bronze"]),
    _fresh_sql("silver", SILVER, *C.FRESHNESS_TIERS["silver"])])), "Q13 D15")
def q_freshness_status(spark, sf_dir):
    as_of = F.lit(FRESH_AS_OF).cast("timestamp")
    return Q.union_all([
        Q.freshness(B.bronze_taps(spark, sf_dir), BRONZE, "ingest_timestamp_utc", as_of, *C.FRESHNESS_TIERS["bronze"]),
        Q.freshness(silver_of(spark, sf_dir), SILVER, "ingest_timestamp_utc", as_of, *C.FRESHNESS_TIERS["silver"])])


# --- Q14 retention -----------------------------------------------------------------------------------


@register("retention_filter", compose("daily", f"""
SELECT CAST(year(service_date) AS INTEGER) AS service_year, COUNT(*) AS rows,
       ROUND(CAST(SUM(fare_amount_cad) AS DOUBLE), 2) AS revenue
FROM daily WHERE service_date >= DATE '{C.ORDERS_AS_OF}' - INTERVAL {C.RETENTION_DAYS} DAY
GROUP BY 1"""), "Q14")
def q_retention_filter(spark, sf_dir):
    from railyard.functions import columns as X
    d = Q.retention(B.daily_orders(spark, sf_dir), "service_date", B.orders_as_of())
    return d.groupBy(F.year("service_date").alias("service_year")).agg(
        F.count(F.lit(1)).alias("rows"), X.money_out(F.sum("fare_amount_cad")).alias("revenue"))


# --- Q15 run metrics ------------------------------------------------------------------------------------
@register("load_metrics", compose("tagged_dq", """
SELECT CAST(COUNT(*) AS BIGINT) AS rows_in,
       CAST(count_if(len(reasons) = 0) AS BIGINT) AS rows_kept,
       CAST(count_if(len(reasons) > 0) AS BIGINT) AS rows_quarantined,
       CAST(count_if(list_contains(reasons, 'bad_tap_type')) AS BIGINT) AS bad_tap_type,
       CAST(count_if(list_contains(reasons, 'unknown_station')) AS BIGINT) AS unknown_station
FROM tagged_dq"""), "Q15")
def q_load_metrics(spark, sf_dir):
    t = silver.tag_violations(_bronze_dq(spark, sf_dir), B.stations(spark, sf_dir))
    return t.agg(F.count(F.lit(1)).alias("rows_in"),
                 F.count_if(F.size("_reasons") == 0).alias("rows_kept"),
                 F.count_if(F.size("_reasons") > 0).alias("rows_quarantined"),
                 F.count_if(F.array_contains("_reasons", "bad_tap_type")).alias("bad_tap_type"),
                 F.count_if(F.array_contains("_reasons", "unknown_station")).alias("unknown_station"))


@register("dq_contract", compose("bronze", """
SELECT 'bronze.afc_taps' AS contract, column_name, rule, CAST(failed AS BIGINT) AS failed_rows,
       (SELECT COUNT(*) FROM bronze) AS total_rows, CASE WHEN failed > 0 THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT unnest([{'column_name': 'tap_id', 'rule': 'required', 'failed': count_if(k = 93)},
  {'column_name': 'card_token', 'rule': 'required', 'failed': 0}, {'column_name': 'station_id', 'rule': 'required', 'failed': 0},
  {'column_name': 'line', 'rule': 'required', 'failed': 0}, {'column_name': 'zone', 'rule': 'required', 'failed': count_if(zone IS NULL)},
  {'column_name': 'fare_class', 'rule': 'required', 'failed': 0}, {'column_name': 'fare_class', 'rule': 'enum', 'failed': count_if(k = 92)},
  {'column_name': 'fare_amount_cad', 'rule': 'required', 'failed': 0}, {'column_name': 'fare_amount_cad', 'rule': 'min', 'failed': count_if(k = 91 AND fare_amount_cad >= 0)},
  {'column_name': 'tap_type', 'rule': 'required', 'failed': 0}, {'column_name': 'tap_type', 'rule': 'enum', 'failed': 0},
  {'column_name': 'tap_timestamp_utc', 'rule': 'required', 'failed': count_if(k = 90)},
  {'column_name': 'device_id', 'rule': 'required', 'failed': 0}, {'column_name': 'schema_version', 'rule': 'required', 'failed': 0},
  {'column_name': 'ingest_timestamp_utc', 'rule': 'required', 'failed': 0},
  {'column_name': 'tap_id', 'rule': 'unique', 'failed': (SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM bronze
    WHERE k <> 93 GROUP BY tap_id HAVING COUNT(*) > 1))}], recursive := true) FROM bronze)"""), "Q9 Q1 Q4 Q5 Q2")
def q_dq_contract(spark, sf_dir):
    """The tap contract over taps with planted faults: ids (k = 93), fare
    classes (92), negative fares (91), event times (90), and the re-ingested
    copies that break uniqueness."""
    b = B.bronze_taps(spark, sf_dir, with_k=True)
    faulty = b.select(
        F.when(F.col("k") != 93, F.col("tap_id").cast("string")).alias("tap_id"),
        F.col("card_token").cast("string").alias("card_token"), F.col("station_id").cast("string").alias("station_id"),
        F.lit("L").alias("line"), "zone",
        F.when(F.col("k") == 92, F.lit("STAFF")).otherwise(F.col("fare_class")).alias("fare_class"),
        F.when(F.col("k") == 91, -F.col("fare_amount_cad") - F.lit(1)).otherwise(F.col("fare_amount_cad"))
        .cast("double").alias("fare_amount_cad"), "tap_type",
        F.when(F.col("k") != 90, F.col("tap_timestamp_utc")).alias("tap_timestamp_utc"), "device_id",
        "schema_version", "ingest_timestamp_utc")
    return CT.violations(faulty, CT.BRONZE_TAPS, "bronze.afc_taps")


@register("quarantine_reasons", compose("tagged_faulty", """
SELECT unnest(reasons) AS reason, COUNT(*) AS rows FROM tagged_faulty GROUP BY 1"""), "Q6 Q8")
def q_quarantine_reasons(spark, sf_dir):
    """Rows of each of the four reasons; a row may have several."""
    t = silver.tag_violations(B.faulty_taps(spark, sf_dir), B.stations(spark, sf_dir))
    return t.select(F.explode("_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def _gold_contract_sql() -> str:
    rules = [(f.name, "required", f"{f.name} IS NULL") for f in CT.GOLD_RIDERSHIP_HOURLY if f.required] + [
        (f.name, "min", f"{f.name} < {f.min}") for f in CT.GOLD_RIDERSHIP_HOURLY if f.min is not None]
    return "\nUNION ALL ".join(
        f"SELECT '{FACT}' AS contract, '{c}' AS column_name, '{r}' AS rule, count_if({p})::BIGINT AS failed_rows, "
        f"COUNT(*) AS total_rows, CASE WHEN count_if({p}) > 0 THEN 'fail' ELSE 'pass' END AS status FROM fact_faulty"
        for c, r, p in rules)


@register("dq_gold_contract", compose("fact_faulty", _gold_contract_sql()), "Q9 Q1 Q5")
def q_dq_gold_contract(spark, sf_dir):
    """The hourly fact's contract over a fact with planted faults."""
    return CT.violations(_faulty_fact(spark, sf_dir), CT.GOLD_RIDERSHIP_HOURLY, FACT)
