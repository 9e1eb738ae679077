"""Quality checks and access rules on hand-made frames."""
from pyspark.sql import functions as F

from railyard.operators import governance as G, quality as Q
from railyard.sources import binding as B


def test_rules_in_one_pass(spark):
    df = spark.createDataFrame([(1, "ADULT", 1.0), (None, "X", -1.0), (3, None, 2.0)],
                               "id long, fare_class string, fare double")
    out = {(r.check_id, r.column_name): (r.failed_rows, r.status) for r in Q.run_rules(df, "t", [
        Q.not_null("id"), Q.accepted_values("fare_class", ["ADULT"]), Q.at_least("fare", 0)]).collect()}
    assert out == {("not_null", "id"): (1, "fail"), ("accepted_values", "fare_class"): (1, "fail"),
                   ("between", "fare"): (1, "fail")}


def test_unique_warn_and_relationships(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    r = Q.unique(df, "t", "k", "warn").first()
    assert (r.failed_rows, r.total_rows, r.status) == (2, 5, "warn")
    parent = spark.createDataFrame([(1,)], "k long")
    r = Q.relationships(df, "t", "k", parent, "k").first()
    assert (r.failed_rows, r.status) == (1, "fail")


def test_contract_diff(spark):
    df = spark.createDataFrame([(1, "a")], "tap_id long, fare_class string")
    diff = Q.contract_diff(df, [("tap_id", "bigint", True), ("fare_class", "int", True), ("zone", "int", True)])
    assert ("zone", "missing", "int") in diff and any(d[0] == "fare_class" and d[1] == "type" for d in diff)


def test_access_scopes_and_row_filter(spark):
    from tests.conftest import SMOKE
    st = B.stations(spark, SMOKE)
    acc = G.user_access(B.user_scopes(spark), st)
    per = {r.user_principal_name: r.n for r in acc.groupBy("user_principal_name").agg(F.count("*").alias("n")).collect()}
    assert per == {"all@example.com": 25, "line0@example.com": 5, "partner@example.com": 1, "analyst@example.com": 23}
    facts = spark.createDataFrame([(7, 1), (8, 1), (7, 2)], "station_id int, x int")
    assert facts.transform(lambda d: G.row_filter(d, acc, "partner@example.com")).count() == 2
    assert G.row_filter(facts, acc, "nobody@example.com").count() == 0


def test_mask_hashes_non_members(spark):
    df = spark.createDataFrame([(123,)], "card_token long")
    r = df.select(G.mask("card_token", F.lit(False), "s").alias("m"), G.mask("card_token", F.lit(True), "s").alias("c")).first()
    assert r.c == "123" and len(r.m) == 64 and r.m != "123"
