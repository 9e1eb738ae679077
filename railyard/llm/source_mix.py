"""Mixing sources to target weights.

Words per source are aggregated (map-side combined), targets follow from the
weights by water-filling under a cap on repetition, and each source's rate is
target / size.  A document is emitted ``floor(rate)`` times plus one
hash-seeded Bernoulli copy whose probability is the fraction of the rate.

The draws come from a digest of the document id and nothing else, so reruns and
other partitionings agree.  Each document has ``SEEDS`` independent draws; the
same aggregate that is needed anyway sums, per source, the words that each
seed would take, and the source uses the seed that comes closest to its
target.  Per document the draw stays a Bernoulli draw with that probability.

Only the per-source table (one row per source) is ever gathered in one task.

Defined cases: null or empty text has size 0; a null source is a source of its
own, last in order; a source of size 0 has target 0; a null id draws like the
empty string; rows with equal ids draw alike; an empty table gives no rows.
Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.staging import Stage

WORD = r"[^\x20\x09-\x0D]+"
#: Draws per document: 8 hexadecimal digits each of two SHA-256 digests.
SEEDS = 16
WEIGHTS = (3, 1, 2)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str, seed: int) -> Column:
    """Uniform number in [0, 1) of seed number ``seed``."""
    key = F.concat(F.lit(f"mix{seed // 8}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    part = F.substring(F.sha2(key, 256), 8 * (seed % 8) + 1, 8)
    return F.conv(part, 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): ``share`` of
    all words by repeating ``weights`` in code-point order (null last), no
    target above ``most`` times its source's size."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(order) % len(weights)
    weight = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        weight = F.when(k == i + 1, F.lit(float(w))).otherwise(weight)
    s = (sizes.withColumn("weight", weight).withColumn("size_d", F.col("source_size").cast("double"))
         .withColumn("cap", F.lit(most) * F.col("size_d")))
    # in order of the level at which a source reaches its cap, capped sources come first
    fill = Window.orderBy((F.col("size_d") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("rest", F.lit(share) * F.sum("size_d").over(whole)
                      - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", F.col("rest") / F.col("open"))
         .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight")))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("size_d") / F.col("weight"), "level"))).over(whole)["level"]
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap"))
                    .otherwise(level * F.col("weight")).alias("target"))


def take(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, id_col: str = "doc_id",
         source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), a row per document."""
    st = Stage(docs.sparkSession, "source-mix")
    sized = st.stage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                 words(F.col(text_col)).alias("size")), "sizes")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = st.stage(plan.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                    .otherwise(0.0))
                    .withColumn("whole", F.floor("rate")).withColumn("odds", F.col("rate") - F.col("whole")), "plan")
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    # words that each seed adds, and the seed that comes closest (the first of equals)
    sums = joined.groupBy("source", "target", "source_size", "whole").agg(
        *[F.sum(F.when(draw("id", i) < F.col("odds"), F.col("size")).otherwise(0)).alias(f"a{i}")
          for i in range(SEEDS)])
    miss = F.least(*[F.struct(F.abs(F.col(f"a{i}") + F.col("whole") * F.col("source_size") - F.col("target"))
                              .alias("miss"), F.lit(i).alias("seed")) for i in range(SEEDS)])
    best = sums.select(F.col("source").alias("s"), miss["seed"].alias("seed"))
    chosen = F.element_at(F.array(*[draw("id", i) for i in range(SEEDS)]), F.col("seed") + 1)
    out = joined.join(best, joined["source"].eqNullSafe(best["s"])).withColumn(
        "copies", (F.col("whole") + F.when(chosen < F.col("odds"), 1).otherwise(0)).cast("long"))
    return out.select("id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    taken = take(docs, weights, share, most, id_col, source_col, text_col)
    # copies follow from the id and the source; one row per pair is enough
    copies = (taken.where("copies > 0").select(F.col("id").alias("_id"), F.col("source").alias("_source"), "copies")
              .withColumnRenamed("copies", "_copies").dropDuplicates(["_id", "_source"]))
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_i"),
                         F.col(source_col).alias("_s"))
    return (packed.join(copies, F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*"))


def oracle_sql() -> str:
    w = ", ".join(f"({i + 1}, {float(x)})" for i, x in enumerate(WEIGHTS))
    draws = ", ".join(f"('0x' || substr(sha256('mix{i // 8}:' || coalesce(CAST(doc_id AS VARCHAR), '')), "
                      f"{8 * (i % 8) + 1}, 8))::BIGINT / 4294967296.0" for i in range(SEEDS))
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  [{draws}] AS u FROM documents),
w(k, weight) AS (VALUES {w}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE AS size_d,
             (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS k FROM d GROUP BY source),
c AS (SELECT source, source_size, size_d, weight::DOUBLE AS weight, 2.0::DOUBLE * size_d AS cap FROM s JOIN w USING (k)),
l AS (SELECT *, (1.5::DOUBLE * sum(size_d) OVER () - coalesce(sum(cap) OVER (ORDER BY size_d / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY size_d / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
p AS (SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap ELSE weight *
             (SELECT arg_min(level, size_d / weight) FROM l WHERE cap > level * weight) END AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM p),
j AS (SELECT d.*, r.source_size, r.target, floor(r.rate)::BIGINT AS whole, r.rate - floor(r.rate) AS odds
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
e AS (SELECT source, i, any_value(abs(whole * source_size - target + 0)) AS base,
             abs(sum(CASE WHEN u[i] < odds THEN size ELSE 0 END) + any_value(whole * source_size) - any_value(target)) AS miss
      FROM j, (SELECT unnest(range(1, {SEEDS + 1})) AS i) GROUP BY source, i),
b AS (SELECT source, arg_min(i, (miss, i)) AS i FROM e GROUP BY source)
SELECT doc_id, j.source, size, source_size, target,
       whole + (CASE WHEN u[b.i] < odds THEN 1 ELSE 0 END) AS copies,
       (whole + (CASE WHEN u[b.i] < odds THEN 1 ELSE 0 END)) * size AS taken
FROM j JOIN b ON j.source IS NOT DISTINCT FROM b.source"""
