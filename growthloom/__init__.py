"""growthloom: product analytics (growth, engagement, retention) on Spark.

Every transform takes DataFrames and returns a DataFrame built only from
Spark's own operators; I/O lives in ``sources`` and ``plans``.
"""

__version__ = "0.1.0"

from growthloom.operators.activity import event_detail_activity, user_activity  # noqa: E402
from growthloom.operators.core import dim_user, fact_events  # noqa: E402
from growthloom.operators.features import features_performance, user_period_features  # noqa: E402
from growthloom.operators.growth import growth_status, growth_user_features  # noqa: E402
from growthloom.operators.quality import column_contract, default_checks, run_checks  # noqa: E402
from growthloom.operators.reporting import (  # noqa: E402
    engagement_metrics,
    event_activity_report,
    grouping_report,
    growth_report,
    growth_report_from_events,
    miles_mix,
    redemption_rate,
    retention_curve,
    trailing_active_users,
    user_trend,
)
from growthloom.operators.retention import cohort_retention  # noqa: E402
from growthloom.operators.staging import stage_events  # noqa: E402
from growthloom.plans.loader import load_fact  # noqa: E402
from growthloom.plans.refresh import lazy_models, refresh  # noqa: E402
from growthloom.sources.raw import read_raw_events  # noqa: E402

__all__ = [
    "stage_events", "fact_events", "dim_user", "event_detail_activity", "user_activity",
    "user_period_features", "features_performance", "growth_status", "growth_user_features",
    "grouping_report", "growth_report", "growth_report_from_events", "event_activity_report",
    "engagement_metrics", "miles_mix", "redemption_rate", "retention_curve", "user_trend",
    "trailing_active_users", "cohort_retention", "default_checks", "run_checks", "column_contract",
    "load_fact", "refresh", "lazy_models", "read_raw_events",
]
