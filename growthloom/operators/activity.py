"""Event-level activity detail and per-user activity by period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.functions.periods import engagement_types, period_start


def user_first_dates(fct: DataFrame) -> DataFrame:
    """user_id -> first event date, one row per user (map-side combined)."""
    return fct.groupBy("user_id").agg(F.min("event_date").alias("_first_date"))


def event_detail_activity(fct: DataFrame, week_start: str = "sunday") -> DataFrame:
    """Each event with its day/week/month starts and a new/existing flag per
    grain (new = the event falls in the user's first day/week/month).

    The user's first date comes from an aggregate joined back on user_id
    rather than a window over all of a user's events: a window would put a
    hot user's events into one task, the join lets AQE split that partition
    (or broadcast the per-user side when it is small). A NULL user never
    matches, so its events are flagged ``existing``.
    """
    e = fct.join(user_first_dates(fct), "user_id", "left")
    d, first = F.col("event_date"), F.col("_first_date")

    def flag(grain: str):
        same = period_start(d, grain, week_start) == period_start(first, grain, week_start)
        return F.when(same, F.lit("new")).otherwise(F.lit("existing"))

    return e.select(
        *[F.col(c) for c in fct.columns],
        d.alias("period_start_day"),
        period_start(d, "week", week_start).alias("period_start_week"),
        period_start(d, "month", week_start).alias("period_start_month"),
        flag("day").alias("user_flag_daily"),
        flag("week").alias("user_flag_weekly"),
        flag("month").alias("user_flag_monthly"),
    )


def user_activity(fct: DataFrame, grain: str, week_start: str = "sunday") -> DataFrame:
    """Per user x period x engagement type: event count and miles.

    Each event counts under ``all`` and under its own bucket (``other``
    events only under ``all``). NULL users stay as a group of their own.
    """
    ex = fct.select(
        "user_id",
        period_start("event_date", grain, week_start).alias("period_start"),
        F.explode(engagement_types("engagement_bucket")).alias("engagement_type"),
        "miles_amount",
    )
    return ex.groupBy("period_start", "engagement_type", "user_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.coalesce(F.col("miles_amount"), F.lit(0))).alias("total_miles_amount"),
    )
