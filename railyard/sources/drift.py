"""Messages whose shape drifts (S4, S5, Q9), decoded field by field as VARIANT.

A message is parsed once.  Every contract field is taken on its own: a value
that its type cannot hold exactly (a word where a number should be, a fraction
in an integer, a time that is none) is NULL in its column and stays, with keys
outside the contract, in ``_rescued_data``; the other fields are unharmed.  Only
text that is no JSON object is kept whole.

``drift_report`` reads the types that occur from the messages themselves, one
row per field; ``evolve`` turns such a report into the next schema: new fields
are added, numeric fields grow to a type that holds both without loss, and a
field with values of several kinds stays as agreed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.loads import common_type
from railyard.sources.bronze import TIME_FIELDS

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _kind(x: Column) -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, OBJECT<..>, ARRAY<..> or VOID."""
    return F.schema_of_variant(x)


def _is_number(x: Column) -> Column:
    return _kind(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def _typed(x: Column, field: T.StructField) -> tuple[Column, Column]:
    """(value, whether it says all that the variant ``x`` says)."""
    if field.name in TIME_FIELDS:
        text = F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
        value = F.try_to_timestamp(text)
        return value, value.isNotNull()
    kind = field.dataType
    if isinstance(kind, T.VariantType):
        return x, F.lit(True)
    value = F.try_variant_get(x, "$", kind.simpleString())
    if isinstance(kind, _NUMBERS):
        value = F.when(_is_number(x), value)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return value, value.isNotNull()
        # compared as the widest decimal: no digit may differ
        return value, F.coalesce(value.cast("decimal(38,18)") == F.try_variant_get(x, "$", "decimal(38,18)"), F.lit(False))
    if isinstance(kind, T.StringType):
        value = F.when(~_kind(x).rlike("^(OBJECT|ARRAY)"), value)
    return value, value.isNotNull()


def _parsed(msgs: DataFrame) -> DataFrame:
    """(_raw, _m): the text and its fields (NULL: no JSON object)."""
    raw = F.col("value").cast("string")
    return msgs.select(raw.alias("_raw"), F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>").alias("_m"))


def decode_fields(msgs: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` and ``_rescued_data`` (see module doc)."""
    values, wrong = [], []
    for f in schema.fields:
        x = F.try_element_at("_m", F.lit(f.name))
        value, whole = _typed(x, f)
        there = x.isNotNull() & ~F.is_variant_null(x)
        values.append(F.when(there & whole, value).alias(f.name))
        wrong.append(F.when(there & ~whole, F.lit(f.name)))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    out = _parsed(msgs).select("_raw", "_m", *values, F.array_compact(F.array(*wrong)).alias("_wrong"))
    left = F.map_filter("_m", lambda k, _: ~F.array_contains(known, k) | F.array_contains("_wrong", k))
    rescued = F.when(F.col("_m").isNull(), F.col("_raw")).when(F.size(left) > 0, F.to_json(left))
    return out.select(*[f.name for f in schema.fields], rescued.alias("_rescued_data"))


def drift_report(msgs: DataFrame, schema: T.StructType) -> DataFrame:
    """(field, agreed, seen, messages, status) of every field that occurs: one
    aggregate with a row per field and task, however many messages."""
    agreed = F.create_map(*[F.lit(x) for f in schema.fields for x in (
        f.name, "timestamp" if f.name in TIME_FIELDS else f.dataType.simpleString())])
    entry = _parsed(msgs).select(F.explode("_m").alias("field", "_x")).where(~F.is_variant_null("_x"))
    per = entry.groupBy("field").agg(
        F.schema_of_variant_agg("_x").alias("seen"), F.count("*").alias("messages"),
        F.max(F.abs(F.try_variant_get("_x", "$", "decimal(38,0)"))).alias("_most"))
    per = per.withColumn("agreed", F.try_element_at(agreed, F.col("field")))
    number = F.col("seen").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.col("agreed").isin("tinyint", "smallint", "int", "bigint")
    status = (F.when(F.col("agreed").isNull(), "new")
              .when(F.col("seen") == "VARIANT", "mixed")
              .when(whole & (F.col("seen") == "BIGINT"),
                    F.when((F.col("agreed") == "int") & (F.col("_most") > 2147483647), "wider").otherwise("as agreed"))
              .when(whole & number, "wider")
              .when(F.col("agreed").rlike("^(float|double|decimal)"), F.when(number, "as agreed").otherwise("other"))
              .when(F.col("agreed").isin("string", "timestamp"),
                    F.when(F.col("seen") == "STRING", "as agreed").otherwise("other"))
              .otherwise(F.when(F.lower("seen") == F.col("agreed"), "as agreed").otherwise("other")))
    return per.select("field", "agreed", "seen", "messages", status.alias("status"))


def evolve(schema: T.StructType, report: DataFrame) -> T.StructType:
    """The schema that holds what ``report`` (one row per field) has seen."""
    rows = {r["field"]: r for r in report.collect()}
    fields = []
    for f in schema.fields:
        r, kind = rows.pop(f.name, None), f.dataType
        if r is not None and r["status"] == "wider":
            kind = common_type(kind, T._parse_datatype_string(r["seen"])) or kind
        fields.append(T.StructField(f.name, kind))
    for name in sorted(rows):
        fields.append(T.StructField(name, T._parse_datatype_string(rows[name]["seen"])))
    return T.StructType(fields)
