"""Invariants on the real tables and grain uniqueness (§5 c)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from growthloom.plans.catalog import fact, queries, users
from growthloom.operators.growth import growth_status, growth_user_features
from growthloom.operators.reporting import growth_report
from growthloom.operators.retention import cohort_retention
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("source, grain", [("events", "day"), ("events", "week"), ("orders", "month")])
def test_status_counts_equal_active_users(spark, source, grain):
    fct = fact(spark, SF_SMALL, source)
    gs = growth_status(fct, grain)
    active = gs.filter(F.col("growth_status").isin("new", "retained", "resurrected")).groupBy("period_start", "engagement_type").count()
    flagged = gs.filter("is_active_current = 1").groupBy("period_start", "engagement_type").count()
    assert active.exceptAll(flagged).count() == 0 and flagged.exceptAll(active).count() == 0
    # one row per (user, type, period)
    assert gs.count() == gs.select("user_id", "engagement_type", "period_start").distinct().count()
    # every user x type runs from its first period to the same last period
    span = gs.groupBy("user_id", "engagement_type").agg(F.max("period_start").alias("m")).select("m").distinct()
    assert span.count() == 1


def test_cohort_invariants(spark):
    co = cohort_retention(fact(spark, SF_SMALL, "orders"), ("month", "week"))
    assert co.filter("retention_rate > 1").count() == 0
    p0 = co.filter("period_number = 0")
    assert p0.filter("retained_users != cohort_size").count() == 0
    keys = ["period_grain", "cohort_period", "engagement_type", "country", "gender", "period_number"]
    assert co.count() == co.select(*keys).distinct().count()


def test_report_country_sums_to_overall(spark):
    fct, du = fact(spark, SF_SMALL, "events"), users(spark, SF_SMALL, "events")
    rpt = growth_report(growth_user_features(fct, du, ("day", "week")))
    keys = ["period_start", "period_grain", "engagement_type", "growth_status"]
    overall = rpt.filter("is_overall").select(*keys, F.col("users").alias("o"))
    by_country = rpt.filter(F.col("aggregation_granularity") == "By Country").groupBy(*keys).agg(F.sum("users").alias("c"))
    joined = overall.join(by_country, keys, "full")
    assert joined.filter("o is null or c is null or o != c").count() == 0
    distinct = growth_report(growth_user_features(fct, du, ("day", "week")), distinct_users=True)
    assert rpt.exceptAll(distinct).count() == 0 and distinct.exceptAll(rpt).count() == 0


def test_growth_feature_grain_unique(spark):
    gf = queries()["growth_features_combined"](spark, SF_SMALL)
    assert gf.count() == gf.select("user_id", "period_grain", "period_start", "engagement_type").distinct().count()


@pytest.mark.parametrize(
    "name, keys",
    [
        ("user_features_day", ["user_id", "reporting_date", "period_grain"]),
        ("user_features_month", ["user_id", "reporting_date", "period_grain"]),
        ("features_performance", ["reporting_date", "period_grain", "user_type", "country", "gender",
                                  "first_utm_source", "first_event_type", "first_transaction_category", "first_platform",
                                  "primary_utm_source", "primary_event_type", "primary_transaction_category", "primary_platform"]),
        ("event_activity", ["period_start", "period_grain", "user_flag_of_period_grain", "country", "gender",
                            "transaction_category", "platform", "utm_source", "event_type"]),
        ("growth_report", ["aggregation_granularity", "period_start", "period_grain", "engagement_type", "growth_status",
                           "country", "gender", "event_type", "utm_source", "platform", "transaction_category"]),
        ("user_activity_week", ["period_start", "engagement_type", "user_id"]),
        ("dim_user_orders", ["user_id"]),
    ],
)
def test_grain_is_unique(spark, name, keys):
    df = queries()[name](spark, SF_SMALL)
    assert df.count() == df.select(*keys).distinct().count()
