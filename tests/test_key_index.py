"""Key index, type evolution, awkward partition values, digests."""
import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators import key_index as K
from railyard.operators import loads as L


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows(spark, t, *cols):
    return sorted((tuple(r) for r in spark.table(t).select(*cols).collect()), key=str)


def test_filters_hold_every_key_and_few_others(spark):
    df = spark.range(30000).selectExpr("id", "cast(id % 7 as int) AS part").where("part <> 3 OR id < 50")
    index = K.filters(df, ["id"], "part").cache()
    assert index.agg(F.countDistinct("part")).first()[0] == 7
    for part, some in ((2, [9, 16, 29990]), (3, [3, 10]), (6, [6])):
        assert all(k % 7 == part for k in some)
        batch = spark.createDataFrame([(k,) for k in some], "id long")
        assert part in {r[0] for r in K.candidates(index, batch, ["id"], "part").collect()}
    # each partition holds about 4286 of 30000 keys; none of 2000 others should meet its filter
    others = spark.range(10 ** 6, 10 ** 6 + 2000).toDF("id")
    assert len(K.candidates(index, others, ["id"], "part").collect()) <= 1
    index.unpersist()


def test_filters_of_one_large_partition_are_built_by_many_tasks(spark, monkeypatch):
    """All keys in one partition value: their bits are dealt out by bitmap, and the filters are the same."""
    df = spark.range(20000).selectExpr("id", "CASE WHEN id < 0 THEN 1 END AS part")
    whole = {tuple(r) for r in K.filters(df, ["id"], "part").collect()}
    monkeypatch.setattr(K, "KEYS_PER_TASK", 1000, raising=False)
    index = K.filters(df, ["id"], "part")
    got = index.withColumn("_task", F.spark_partition_id()).collect()
    assert {tuple(r)[:-1] for r in got} == whole and len(whole) == 16
    assert len({r["_task"] for r in got}) > 4


def test_upsert_reads_candidates_only(spark):
    t = L.new_table_name("t_index")
    base = spark.range(2000).selectExpr("id", "cast(id % 20 as int) AS part", "'a' AS v")
    L.upsert(spark, t, base, "id", "part")
    assert K.exists(spark, t)
    keys = spark.createDataFrame([(41,), (81,)], "_key_id long")  # both live in partition 1
    seen = []
    real = L.candidate_rows

    def spy(s, table, col, values):
        seen.append(set(values))
        return real(s, table, col, values)

    L.candidate_rows = spy
    try:
        assert L.partitions_of_keys(spark, t, keys, ["id"], "part") == {1}
    finally:
        L.candidate_rows = real
    assert seen[-1] == {1}
    p = plan_text(L.candidate_rows(spark, t, "part", seen[-1]).select("id"))
    assert "PartitionFilters: [isnotnull(part" in p and "(part" in p.split("PartitionFilters")[1].split("\n")[0]
    assert "= 1)" in p.split("PartitionFilters")[1].split("\n")[0]


@pytest.mark.parametrize("lost", ["nothing", "the index", "one filter"])
def test_upserts_with_moving_keys_equal_a_dictionary(spark, lost):
    """Batches that move keys about, also after filters were lost."""
    rnd = random.Random(4)
    t, want = L.new_table_name("t_moves"), {}
    for step in range(4):
        batch = {k: (rnd.choice([None, 1, 2, 3, 4, 5]), f"s{step}") for k in rnd.sample(range(40), 15)}
        want |= batch
        L.upsert(spark, t, spark.createDataFrame([(k, v, p) for k, (p, v) in batch.items()], "id int, v string, part int"),
                 "id", "part")
        if step == 1 and lost == "the index":
            spark.sql(f"DROP TABLE {K.index_name(t)}")
        if step == 1 and lost == "one filter":
            some = next(iter(L.partition_values(spark, t, "part") - {None}))
            L.forget_keys(spark, t, "part", {some})
        assert {r.id: (r.part, r.v) for r in spark.table(t).collect()} == want
        assert spark.table(t).count() == len(want)


def test_overwritten_partitions_lose_their_filters(spark):
    t = L.new_table_name("t_over")
    L.upsert(spark, t, spark.createDataFrame([(1, 1), (2, 2)], "id int, part int"), "id", "part")
    L.overwrite_partitions(spark, t, spark.createDataFrame([(7, 1)], "id int, part int"), "part")
    L.upsert(spark, t, spark.createDataFrame([(7, 2)], "id int, part int"), "id", "part")  # 7 moves out of partition 1
    assert rows(spark, t, "id", "part") == [(2, 2), (7, 2)]


def test_common_types():
    t = {"byte": T.ByteType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
         "double": T.DoubleType(), "string": T.StringType(), "d52": T.DecimalType(5, 2), "d380": T.DecimalType(38, 0)}
    ok = [("int", "long", t["long"]), ("int", "double", t["double"]), ("float", "int", t["double"]),
          ("long", "d52", T.DecimalType(21, 2)), ("byte", "d52", t["d52"]), ("long", "double", None),
          ("string", "int", None), ("d380", "d52", None), ("double", "d52", None)]
    for a, b, want in ok:
        assert L.common_type(t[a], t[b]) == L.common_type(t[b], t[a]) == want, (a, b)


def test_wider_values_are_kept_and_impossible_ones_raise(spark):
    t = L.new_table_name("t_types")
    L.upsert(spark, t, spark.createDataFrame([(1, 7, 1), (2, 8, 2)], "id int, v int, part int"), "id", "part")
    L.upsert(spark, t, spark.createDataFrame([(1, 5.5, 1)], "id int, v double, part int"), "id", "part")
    assert rows(spark, t, "id", "v", "part") == [(1, 5.5, 1), (2, 8.0, 2)]
    L.upsert(spark, t, spark.createDataFrame([(3, 9, 1)], "id short, v int, part int"), "id", "part")  # narrower: cast
    L.upsert(spark, t, spark.createDataFrame([(2 ** 40, 1.5, 3)], "id long, v double, part int"), "id", "part")
    want = [(1, 5.5, 1), (2, 8.0, 2), (2 ** 40, 1.5, 3), (3, 9.0, 1)]
    assert sorted(rows(spark, t, "id", "v", "part")) == sorted(want)
    for bad, kind in (((9, "x", 1), "id long, v string, part int"), ((9, 1.0, "1"), "id long, v double, part string")):
        with pytest.raises(ValueError, match="without loss"):
            L.upsert(spark, t, spark.createDataFrame([bad], kind), "id", "part")
    with pytest.raises(ValueError, match="repeats a key"):
        L.upsert(spark, t, spark.createDataFrame([(1, 1.0, 1), (1, 2.0, 1)], "id long, v double, part int"), "id", "part")
    assert sorted(rows(spark, t, "id", "v", "part")) == sorted(want)


def test_awkward_partition_values(spark):
    t = L.new_table_name("t_names")
    names = ["it's", "a:b/c", "50% off", "x=y", "back\\slash", "é ü", "q\"q", None]
    L.upsert(spark, t, spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, part string"), "id", "part")
    assert L.partition_values(spark, t, "part") == set(names)
    L.upsert(spark, t, spark.createDataFrame([(i, "all") for i in range(len(names) - 1)], "id int, part string"),
             "id", "part")
    assert rows(spark, t, "id", "part") == [(i, "all") for i in range(7)] + [(7, None)]
    assert L.partition_values(spark, t, "part") == {"all", None}
    where = L._location(spark, t)
    assert spark.read.parquet(where).count() == 8  # nothing is left in the folders of emptied partitions


def test_digests_find_one_row(spark):
    a = spark.range(4000).selectExpr("id", "cast(id % 9 as int) AS part", "nullif(id % 5, 0) AS x", "nullif(id % 3, 0) AS y")
    b = a.withColumn("x", F.when(F.col("id") == 1003, None).otherwise(F.col("x"))) \
         .withColumn("y", F.when(F.col("id") == 1003, F.col("x")).otherwise(F.col("y"))).repartition(5)
    parts, found = L.drift(a, b, "part")
    # the other change, (x, null) to (null, x), must not hide behind equal hashes
    swapped = a.where("id = 1003").first()
    assert {r.partition for r in parts.collect() if r.differs} == {1003 % 9} and swapped is not None
    assert {r.id for r in found.collect()} == {1003}
    out = L.reconcile(a, b, "part").first()
    assert (out.rows_full, out.rows_incremental, out.only_in_full, out.only_in_incremental, out.status) \
        == (4000, 4000, 1, 1, "drift")
    assert L.reconcile(a, a.repartition(3), "part").first().status == "match"
    assert L.reconcile(a, a.union(a.limit(1)), "part").first().only_in_incremental == 1


def test_only_the_differing_partition_is_compared(spark):
    t = L.new_table_name("t_digest")
    v = spark.range(900).selectExpr("id", "id * 2 AS v", "cast(id % 9 as int) AS part")
    L.create_table(v.where("id <> 13"), t, "part")
    _, found = L.drift(v, spark.table(t), "part")
    p = plan_text(found)
    line = [x for x in p.split("\n") if x.startswith("PartitionFilters")]
    assert line and f"= {13 % 9})" in line[0]
    assert [r.id for r in found.collect()] == [13]
