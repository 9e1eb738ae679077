"""Data-quality checks and contracts (Q1-Q17).

Every check yields rows of one shape:
``(check_id, table_name, column_name, failed_rows, total_rows, status)``.

Row-level rules (not_null, accepted_values, between, regex, cross-column)
of one table are evaluated in a single aggregation pass with ``count_if``
per rule, then unpivoted with ``stack``; uniqueness is a grouped count and
relationships a ``left_anti`` join, both shuffle-partitioned on the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard import constants as C


@dataclass(frozen=True)
class Rule:
    check_id: str
    column: str
    failed: Column            # true when the row violates the rule
    severity: str = "error"   # error | warn


def not_null(col: str, severity="error") -> Rule:
    return Rule("not_null", col, F.col(col).isNull(), severity)


def accepted_values(col: str, values, severity="error") -> Rule:
    """NULL passes (SQL ``NOT IN`` behaviour, D22)."""
    return Rule("accepted_values", col, F.coalesce(~F.col(col).isin(*values), F.lit(False)), severity)


def at_least(col: str, minimum, severity="error") -> Rule:
    return Rule("between", col, F.coalesce(F.col(col) < F.lit(minimum), F.lit(False)), severity)


def matches(col: str, pattern: str, severity="error") -> Rule:
    return Rule("regex", col, F.coalesce(~F.col(col).rlike(pattern), F.lit(False)), severity)


def row_rule(name: str, expr: Column, severity="error") -> Rule:
    """Cross-column rule; not-true (false or NULL) fails."""
    return Rule(name, "*", ~F.coalesce(expr, F.lit(False)), severity)


def _status(failed: Column, severity: Column) -> Column:
    return F.when(failed == 0, F.lit("pass")).when(severity == "warn", F.lit("warn")).otherwise(F.lit("fail"))


def run_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All row rules of one table in one pass."""
    aggs = [F.count_if(r.failed).alias(f"_f{i}") for i, r in enumerate(rules)] + [F.count(F.lit(1)).alias("_n")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{r.check_id}', '{r.column}', '{r.severity}', _f{i}" for i, r in enumerate(rules))
    long = one.selectExpr(f"stack({len(rules)}, {stack}) AS (check_id, column_name, severity, failed_rows)", "_n")
    return long.select("check_id", F.lit(table).alias("table_name"), "column_name",
                       F.col("failed_rows").cast("bigint").alias("failed_rows"),
                       F.col("_n").cast("bigint").alias("total_rows"),
                       _status(F.col("failed_rows"), F.col("severity")).alias("status"))


def unique(df: DataFrame, table: str, keys, severity="error", check_id="unique") -> DataFrame:
    """Rows whose key occurs more than once (NULL keys ignored).  One grouped
    count (map-side combined), then a one-row total."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.max(any_null).alias("_null_key"))
    agg = per.agg(F.coalesce(F.sum(F.when((F.col("_c") > 1) & ~F.col("_null_key"), F.col("_c"))), F.lit(0))
                  .alias("failed_rows"),
                  F.coalesce(F.sum("_c"), F.lit(0)).alias("total_rows"))
    return _one_row(agg, check_id, table, "+".join(keys), severity)


def relationships(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str,
                  severity="error") -> DataFrame:
    """Non-NULL child keys without a parent row (orphans)."""
    p = parent.select(F.col(parent_col).alias(col)).distinct().withColumn("_has_parent", F.lit(True))
    j = child.select(col).join(p, col, "left")
    agg = j.agg(F.count_if(F.col(col).isNotNull() & F.col("_has_parent").isNull()).alias("failed_rows"),
                F.count(F.lit(1)).alias("total_rows"))
    return _one_row(agg, "relationships", table, col, severity)


def _one_row(df: DataFrame, check_id: str, table: str, column: str, severity: str) -> DataFrame:
    return df.select(F.lit(check_id).alias("check_id"), F.lit(table).alias("table_name"),
                     F.lit(column).alias("column_name"),
                     F.col("failed_rows").cast("bigint").alias("failed_rows"),
                     F.col("total_rows").cast("bigint").alias("total_rows"),
                     _status(F.col("failed_rows"), F.lit(severity)).alias("status"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- freshness, retention, contracts ---------------------------------------------------
def freshness(df: DataFrame, table: str, loaded_at: str, as_of: Column, warn_min: int, error_min: int) -> DataFrame:
    """Age of the newest row at ``as_of`` against warn and error ages (Q13);
    an empty table is an error."""
    m = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_micros(as_of) - F.unix_micros("max_loaded_at")) / F.lit(60_000_000.0)
    return m.select(F.lit(table).alias("table_name"), "max_loaded_at",
                    F.round(age, 6).alias("age_minutes"),
                    F.when(age.isNull() | (age > error_min), F.lit("error")).when(age > warn_min, F.lit("warn"))
                     .otherwise(F.lit("pass")).alias("status"))


def retention(df: DataFrame, date_col: str, as_of: Column, days: int = C.RETENTION_DAYS) -> DataFrame:
    """Rows inside the retention window (a partition filter on a ``dt``
    partitioned table)."""
    return df.filter(F.col(date_col) >= F.date_sub(as_of, days))


def contract_diff(df: DataFrame, contract: list[tuple[str, str, bool]]) -> list[tuple[str, str, str]]:
    """Schema contract (Q9): [(column, problem, detail)] for missing columns
    and wrong types.  Reads only the schema; values are checked by
    ``sources.contracts.violations``."""
    fields = {f.name: f for f in df.schema.fields}
    out = []
    for name, typ, required in contract:
        f = fields.get(name)
        if f is None:
            if required:
                out.append((name, "missing", typ))
            continue
        if f.dataType.simpleString() != typ:
            out.append((name, "type", f"{f.dataType.simpleString()} != {typ}"))
    return out
