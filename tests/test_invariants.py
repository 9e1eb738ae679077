"""Invariants of registered outputs at sf0.001: shares sum to one, priors are
normalised, facts add up, marts agree with facts."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SMOKE


def q(spark, key):
    return E.queries()[key](spark, SMOKE)


def test_expected_and_observed_shares_sum_to_one_per_hour(spark):
    bad = (q(spark, "expected_demand").groupBy("tap_hour_utc")
           .agg(F.sum("expected_share").alias("e"), F.sum("observed_share").alias("o"))
           .filter((F.abs(F.col("e") - 1) > 1e-4) | (F.abs(F.col("o") - 1) > 1e-4)).count())
    assert bad == 0


def test_priors_and_od_shares(spark):
    assert q(spark, "prior_normalised").agg(F.sum("prior")).first()[0] == pytest.approx(1.0, abs=1e-4)
    od = q(spark, "od_share").agg(F.sum("observed_share"), F.sum("expected_share")).first()
    assert od[0] == pytest.approx(1.0, abs=1e-3) and 0 < od[1] <= 1.0 + 1e-3
    per_net = q(spark, "network_priors").groupBy("network").agg(F.sum("prior_normalised").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0, abs=1e-4) for r in per_net)


def test_demand_profile_hour_shares(spark):
    hs = q(spark, "demand_profile").filter("profile = 'hour_share'").agg(F.sum("value")).first()[0]
    assert hs == pytest.approx(1.0, abs=1e-4)


def test_kpis_agree_with_fact(spark):
    fact = q(spark, "fact_ridership_hourly")
    kpis = q(spark, "station_kpis")
    assert kpis.agg(F.sum("daily_taps")).first()[0] == fact.agg(F.sum("total_taps")).first()[0]
    assert kpis.filter(F.col("peak_hour_taps") > F.col("daily_taps")).count() == 0
    rev = q(spark, "fact_fare_revenue").agg(F.sum("gross_fare_revenue_cad")).first()[0]
    cents = kpis.agg(F.sum("fare_revenue_cents")).first()[0]
    assert cents == pytest.approx(rev * 100, abs=len(kpis.collect()))


def test_rollup_grand_total_equals_detail(spark):
    r = q(spark, "slice_rollup")
    top = r.filter(F.col("grouping_level") == 7).first()
    detail = r.filter(F.col("grouping_level") == 0).agg(F.sum("paid_taps")).first()[0]
    assert top.paid_taps == detail


def test_dedup_leaves_one_row_per_tap(spark):
    s = q(spark, "silver_conformed")
    assert s.count() == s.select("tap_id").distinct().count()
