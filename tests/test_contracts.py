"""Column contracts (P24): produced columns against the declared ones."""

from __future__ import annotations

from growthloom.operators.activity import event_detail_activity
from growthloom.operators.core import DIM_USER_COLUMNS, FACT_COLUMNS, dim_user
from growthloom.operators.features import USER_FEATURE_COLUMNS, user_period_features
from growthloom.operators.growth import GROWTH_FEATURE_COLUMNS, GROWTH_STATUS_COLUMNS, growth_status, growth_user_features
from growthloom.operators.quality import column_contract
from growthloom.operators.retention import COHORT_COLUMNS, cohort_retention
from growthloom.operators.staging import STAGED_COLUMNS


def test_operator_outputs_follow_contracts(trap_staged, trap_fct):
    pairs = [
        (trap_staged, STAGED_COLUMNS),
        (trap_fct, FACT_COLUMNS),
        (dim_user(trap_staged), DIM_USER_COLUMNS),
        (user_period_features(trap_fct, "week"), USER_FEATURE_COLUMNS),
        (growth_status(trap_fct, "day"), GROWTH_STATUS_COLUMNS),
        (growth_user_features(trap_fct, dim_user(trap_staged), "day"), GROWTH_FEATURE_COLUMNS),
        (cohort_retention(trap_fct, "month"), COHORT_COLUMNS),
    ]
    for df, declared in pairs:
        res = column_contract(df, declared)
        assert res.ok, (declared, res)


def test_contract_reports_drift(trap_fct):
    # The published fact contract omits the bucket column its consumers read.
    published = [c for c in FACT_COLUMNS if c != "engagement_bucket"]
    res = column_contract(trap_fct, published)
    assert res.undeclared == ["engagement_bucket"] and not res.missing
    res = column_contract(event_detail_activity(trap_fct).drop("user_flag_daily"), [*FACT_COLUMNS, "user_flag_daily"])
    assert res.missing == ["user_flag_daily"]
    res = column_contract(trap_fct.select("event_ts", "user_id"), ["user_id", "event_ts"])
    assert res.out_of_order and not res.ok


def test_top_level_api():
    import growthloom

    assert all(callable(getattr(growthloom, name)) for name in growthloom.__all__)
