"""The user dimension kept up to date from new days.

``user_days`` (a row per user and day, partitioned by day) is the stored state.
A run stages the days from the last one stored on, and undated events, whose
bound reaches the raw scan; it replaces those days and merges the dimension from
the state. Like the fact's incremental load it redoes the last day, so events
that arrive later for an earlier day need ``since``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.operators.core import dim_user_from_days, user_days
from growthloom.sources.sinks import merge_table, read_target, replace_partitions_from, write_table


def days_to_read(staged: DataFrame, since: dt.date) -> DataFrame:
    """Staged events on or after ``since``, and undated ones."""
    return staged.where((F.col("event_date") >= F.lit(since)) | F.col("event_ts").isNull())


def refresh_user_days(spark: SparkSession, staged: DataFrame, path: str, since: dt.date | None = None) -> DataFrame:
    """Bring the stored user-days up to date and return them. ``since`` starts earlier than the last day stored."""
    stored = read_target(spark, path)
    last = stored.agg(F.max("event_date")).first()[0] if stored is not None else None
    if last is None:
        write_table(user_days(staged), path, ["event_date"], ["user_id"])
    else:
        start = min(last, since) if since is not None else last
        replace_partitions_from(spark, user_days(days_to_read(staged, start)), path, "event_date", start, ["user_id"])
    return read_target(spark, path)


def refresh_dim_user(spark: SparkSession, staged: DataFrame, dim_path: str, days_path: str, since: dt.date | None = None) -> None:
    """Merge the user dimension from the stored days; users gone from the source stay."""
    days = refresh_user_days(spark, staged, days_path, since)
    merge_table(spark, dim_user_from_days(days), dim_path, ["user_id"], ["first_seen_date"], ["user_id"])
