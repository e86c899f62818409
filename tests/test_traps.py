"""Hand-worked expectations on the trap frame (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from growthloom.operators.core import dim_user
from growthloom.operators.features import user_period_features
from growthloom.operators.growth import growth_status, growth_user_features
from growthloom.operators.quality import run_checks
from growthloom.operators.retention import cohort_retention
from growthloom.sources.sinks import merge_by_key

D = dt.date


def _status(df):
    return {(r.engagement_type, r.user_id, r.period_start): r.growth_status for r in df.collect()}


def test_growth_status_day(trap_fct):
    gs = growth_status(trap_fct, "day")
    got = _status(gs)
    assert len(got) == gs.count() == 22
    expected_all = {
        ("u1", D(2025, 3, 29)): "new", ("u1", D(2025, 3, 30)): "retained", ("u1", D(2025, 3, 31)): "churned",
        ("u1", D(2025, 4, 1)): "resurrected", ("u1", D(2025, 4, 2)): "churned",
        ("u2", D(2025, 3, 30)): "new", ("u2", D(2025, 3, 31)): "churned", ("u2", D(2025, 4, 1)): "churned",
        ("u2", D(2025, 4, 2)): "resurrected",
    }
    assert {k[1:]: v for k, v in got.items() if k[0] == "all"} == expected_all
    pre = {k[1:]: v for k, v in got.items() if k[0] == "pre_engagement"}
    assert pre[("u1", D(2025, 3, 29))] == "new" and pre[("u2", D(2025, 3, 30))] == "new"
    assert sorted(v for v in pre.values()) == ["churned"] * 7 + ["new"] * 2
    trx = {k[1:]: v for k, v in got.items() if k[0] == "transaction"}
    assert trx == {
        ("u1", D(2025, 3, 30)): "new", ("u1", D(2025, 3, 31)): "churned",
        ("u1", D(2025, 4, 1)): "resurrected", ("u1", D(2025, 4, 2)): "churned",
    }
    assert gs.filter(F.col("user_id").isNull()).count() == 0
    new_customers = {(r.user_id, r.engagement_type, r.period_start) for r in gs.filter("is_new_customer").collect()}
    assert new_customers == {
        ("u1", "all", D(2025, 3, 29)), ("u1", "pre_engagement", D(2025, 3, 29)),
        ("u2", "all", D(2025, 3, 30)), ("u2", "pre_engagement", D(2025, 3, 30)),
    }


def test_growth_status_flags(trap_fct):
    rows = {(r.engagement_type, r.user_id, r.period_start): r for r in growth_status(trap_fct, "day").collect()}
    resurrected = rows[("all", "u1", D(2025, 4, 1))]
    assert (resurrected.is_active_current, resurrected.is_active_prior, resurrected.has_historical_before_prior) == (1, 0, 1)
    first_churn = rows[("all", "u1", D(2025, 3, 31))]
    assert (first_churn.is_active_current, first_churn.is_active_prior, first_churn.has_historical_before_prior) == (1 - 1, 1, 0)
    retained = rows[("all", "u1", D(2025, 3, 30))]
    assert (retained.is_active_prior, retained.has_historical_before_prior) == (1, 0)
    assert rows[("pre_engagement", "u2", D(2025, 4, 1))].is_active_prior == 0


def test_growth_status_week_and_month(trap_fct):
    week = _status(growth_status(trap_fct, "week"))
    assert week == {
        ("all", "u1", D(2025, 3, 23)): "new", ("all", "u1", D(2025, 3, 30)): "retained",
        ("all", "u2", D(2025, 3, 30)): "new",
        ("pre_engagement", "u1", D(2025, 3, 23)): "new", ("pre_engagement", "u1", D(2025, 3, 30)): "churned",
        ("pre_engagement", "u2", D(2025, 3, 30)): "new",
        ("transaction", "u1", D(2025, 3, 30)): "new",
    }
    monday = growth_status(trap_fct, "week", week_start="monday")
    assert monday.count() == 10
    assert {r.period_start for r in monday.collect()} == {D(2025, 3, 24), D(2025, 3, 31)}
    month = _status(growth_status(trap_fct, "month"))
    assert len(month) == 10
    assert month[("pre_engagement", "u1", D(2025, 4, 1))] == "churned"
    assert month[("transaction", "u1", D(2025, 4, 1))] == "retained"


def test_primary_null_rules(trap_fct, trap_staged):
    """P7 counts NULL as a value (tie goes to NULL); P9 skips NULL."""
    feats = user_period_features(trap_fct, "week").filter((F.col("user_id") == "u1") & (F.col("reporting_date") == D(2025, 3, 30)))
    r = feats.collect()[0]
    assert r.primary_utm_source is None
    assert r.first_utm_source == "facebook"
    assert r.first_transaction_category == "shopping"
    assert r.primary_transaction_category == "flight"
    assert r.miles_earned == Decimal("100.5") and r.miles_redeemed == Decimal("40")
    gf = growth_user_features(trap_fct, dim_user(trap_staged), "week")
    g = gf.filter((F.col("user_id") == "u1") & (F.col("period_start") == D(2025, 3, 30)) & (F.col("engagement_type") == "all")).collect()[0]
    assert g.primary_utm_source_in_period == "facebook"
    assert g.period_event_count == 2 and g.period_miles_amount == Decimal("140.5")
    assert (g.has_transaction_event, g.has_pre_engagement_event) == (1, 0)
    churned = gf.filter((F.col("growth_status") == "churned")).collect()
    assert churned and all(c.period_event_count == 0 and c.first_platform_in_period is None for c in churned)


def test_user_type_null_user_is_existing(trap_fct):
    feats = user_period_features(trap_fct, "day")
    null_rows = feats.filter(F.col("user_id").isNull()).collect()
    assert len(null_rows) == 1 and null_rows[0].user_type == "existing"
    assert feats.filter("user_id = 'u1' and user_type = 'new'").count() == 1


def test_cohorts(trap_fct):
    doc = cohort_retention(trap_fct, "month")
    rows = doc.collect()
    assert len(rows) == 8 and all(r.retention_rate == 1.0 for r in rows)
    assert sorted(r.engagement_type for r in rows).count("all") == 4
    written = cohort_retention(trap_fct, "month", join_on="cohort").collect()
    assert len(written) == 20
    assert sum(r.retention_rate is None for r in written) == 6


def test_checks(trap_fct, trap_staged):
    out = {(r.table_name, r.column_name, r.check_name): r.failing_rows for r in run_checks({"fct_events": trap_fct, "dim_user": dim_user(trap_staged)}).collect()}
    assert out[("dim_user", "user_id", "not_null")] == 1
    assert out[("dim_user", "user_id", "unique")] == 0
    assert out[("fct_events", "event_type", "accepted_values")] == 1
    assert out[("fct_events", "user_id", "not_null")] == 1
    assert out[("fct_events", "user_id", "relationships")] == 0


def test_dim_user(trap_staged):
    du = {r.user_id: r for r in dim_user(trap_staged).collect()}
    assert du["u1"].lifetime_events == 3 and du["u2"].lifetime_events == 2
    assert du["u1"].country == "SG" and du["u2"].gender == "M"
    assert du[None].lifetime_events == 1


def test_merge_key_collision(trap_fct):
    empty = trap_fct.limit(0)
    # A key stands for the group of rows that carry it: two users' events at
    # one instant are both kept, loaded again they are no more.
    assert merge_by_key(empty, trap_fct, ["event_ts"]).count() == 6
    assert merge_by_key(trap_fct, trap_fct, ["event_ts"]).count() == 6
    assert merge_by_key(empty, trap_fct, ["user_id", "event_ts", "event_type"]).count() == 6


def test_report_from_events_equals_dense(trap_fct, trap_staged):
    from growthloom.operators.reporting import growth_report, growth_report_from_events

    du = dim_user(trap_staged)
    for grains, ws in ((("day", "week", "month"), "sunday"), (("week",), "monday"), (("day",), "sunday")):
        fast = growth_report_from_events(trap_fct, du, grains, ws)
        dense = growth_report(growth_user_features(trap_fct, du, grains, ws))
        assert fast.count() == dense.count() > 0
        assert fast.exceptAll(dense).count() == 0 and dense.exceptAll(fast).count() == 0
    day = growth_report_from_events(trap_fct, du, ("day",))
    churned = day.filter("is_overall and engagement_type = 'pre_engagement' and growth_status = 'churned'")
    # u1 idle on 03-30..04-02, u2 idle on 03-31..04-02: 2 users on 03-31.
    assert {(r.period_start, r.users) for r in churned.collect()} == {
        (D(2025, 3, 30), 1), (D(2025, 3, 31), 2), (D(2025, 4, 1), 2), (D(2025, 4, 2), 2)
    }


def test_dashboard_measures(trap_fct):
    from growthloom.operators.reporting import miles_mix, redemption_rate, retention_curve, trailing_active_users

    mix = {(r.event_type, r.transaction_category): r for r in miles_mix(trap_fct).collect()}
    assert mix[("miles_earned", "shopping")].share_of_type == 1.0
    assert mix[("miles_redeemed", "flight")].miles_amount == Decimal("40")
    rate = redemption_rate(trap_fct).collect()[0]
    assert rate.miles_earned == Decimal("100.5") and rate.miles_redeemed == Decimal("40")
    assert abs(rate.redemption_rate - 40 / 100.5) < 1e-12
    curve = {(r.engagement_type, r.period_number): r for r in retention_curve(cohort_retention(trap_fct, "month")).collect()}
    assert curve[("all", 1)].retention_rate == 1.0 and curve[("transaction", 1)].retained_users == 1
    # transactions on 03-30 (u1) and 04-01 (u1): one user in the window ending 04-02
    t = trailing_active_users(trap_fct, "2025-04-02", 30).collect()[0]
    assert (t.as_of, t.window_days, t.retained_users) == (D(2025, 4, 2), 30, 1)
    assert trailing_active_users(trap_fct, "2025-04-02", 1, None).collect()[0].retained_users == 2


def test_unique_check_counts_repeated_rows(spark):
    from growthloom.operators.quality import Check, run_checks, unique_failures

    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,), (3,)], "k int")
    out = run_checks({"t": df}, [Check("t", "k", "unique")]).collect()[0]
    assert out.failing_rows == 5 == unique_failures(df, "k").count()
