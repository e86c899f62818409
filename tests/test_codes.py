from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from growthloom.functions.codes import COUNTED, TOLD, counted, few_values
from growthloom.operators.activity import event_detail_activity
from growthloom.operators.core import dim_user, fact_events
from growthloom.operators.features import FEATURE_ATTRIBUTES, USER_CONSTANTS, user_period_features
from growthloom.operators.growth import growth_user_features
from growthloom.operators.reporting import event_activity_report, growth_report_from_events
from growthloom.operators.retention import cohort_retention
from growthloom.operators.staging import stage_events
from growthloom.plans import refresh as plans
from growthloom.sources.adapters import raw_events
from tests.conftest import SF_SMALL
from tests.test_refresh import _same

COLUMNS = [*FEATURE_ATTRIBUTES, *USER_CONSTANTS]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _odd(spark, far: bool = False):
    """Ties in count and in time, NULL, empty and non-ASCII values, users, times and
    attributes missing, a column of one and one of no value, and one of too many."""
    words = [None, "", "a", "b", "é", "\U0001f600", "￿"]
    start = dt.datetime(1969, 12, 28, tzinfo=dt.timezone.utc)
    rows = []
    for i in range(900):
        ts = None if i % 41 == 0 else start + dt.timedelta(hours=7 * (i // 3))
        kind = ("like", "miles_earned", "other", None, "miles_redeemed", "share")[i * i % 6]
        rows.append((ts, None if i % 37 == 0 else i % 5, words[i * 5 % 7], kind, None, i * 1.5, words[i % 7], f"s{i % (COUNTED + 1):02d}", "x" if i % 2 else None))
    if far:
        rows.append((dt.datetime(9998, 1, 1, tzinfo=dt.timezone.utc), 1, "a", "like", None, 0.0, "a", "s00", "x"))
    schema = "event_time timestamp, user_id long, gender string, event_type string, transaction_category string, miles_amount double, platform string, utm_source string, country string"
    return stage_events(spark.createDataFrame(rows, schema))


def test_few_values_are_all_or_left_out(spark):
    fct = fact_events(_odd(spark))
    values = few_values(fct, COLUMNS)
    assert values["platform"] == ["", "a", "b", "é", "￿", "\U0001f600"]  # as UTF-8 bytes order
    assert values["transaction_category"] == [] and values["country"] == ["x"]
    assert len(values["utm_source"]) == COUNTED + 1 and "utm_source" not in counted(values, COLUMNS)
    many = spark.range(TOLD + 1).select(F.current_timestamp().alias("event_ts"), F.col("id").cast("string").alias("v"), F.lit("w").alias("w"))
    assert few_values(many, ["v", "w"]) == {"w": ["w"]}
    assert few_values(many.limit(TOLD), ["v"])["v"] == sorted(map(str, range(TOLD)))
    assert few_values(fact_events(_odd(spark, far=True)), COLUMNS) == {}


@pytest.mark.parametrize("grain", ["day", ("day", "week", "month")])
def test_coded_aggregates_equal_the_picks(spark, grain):
    staged = _odd(spark).cache()
    fct, users = fact_events(staged), dim_user(staged)
    values = few_values(fct, COLUMNS)
    assert _same(user_period_features(fct, grain, values=values), user_period_features(fct, grain))
    recent = fct.filter(F.col("event_ts").isNotNull())
    assert _same(growth_user_features(recent, users, grain, values=values), growth_user_features(recent, users, grain))
    assert _same(growth_report_from_events(recent, users, grain, values=values), growth_report_from_events(recent, users, grain))


def test_coded_cohorts_and_event_activity_equal_the_plain_ones(spark):
    fct = fact_events(_odd(spark).cache())
    values, detail = few_values(fct, COLUMNS), event_detail_activity(fct)
    assert len(values) == len(COLUMNS)
    assert _same(cohort_retention(fct, ("week", "month"), values=values), cohort_retention(fct, ("week", "month")))
    some = {c: v for c, v in values.items() if c != "country"}
    assert _same(cohort_retention(fct, "week", "cohort", values=some), cohort_retention(fct, "week", "cohort"))
    plain = event_activity_report(detail)
    assert plain.schema == event_activity_report(detail, values=values).schema
    for known in (values, some):
        assert _same(event_activity_report(detail, values=known), plain)


def test_a_value_that_is_not_known_is_an_error(spark):
    fct = fact_events(_odd(spark))
    values = few_values(fct, COLUMNS) | {"platform": ["a", "b"]}
    with pytest.raises(Exception, match="not among those known"):
        user_period_features(fct, "day", values=values).collect()


def test_the_refresh_aggregates_few_values_by_hash(spark, tmp_path):
    """Features and report of a refresh sort no events: their aggregates hold numbers alone."""
    raw = raw_events(spark, SF_SMALL, "events")
    plans.refresh(spark, raw, str(tmp_path), models=["stg_event_stream", "fct_events", "dim_user"])
    ctx = plans.Context(spark, raw, str(tmp_path))
    for name in ("int_user_features_weekly", "fct_growth_user_features_weekly", "rpt_growth_reporting", "fct_cohort_retention_weekly"):
        plan = _plan(plans.MODELS_BY_NAME[name].build(ctx))
        assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan, name
