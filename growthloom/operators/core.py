"""Core tables: the event fact and the user dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.functions.periods import engagement_bucket
from growthloom.functions.picks import any_value_det

FACT_COLUMNS = (
    "user_id", "event_ts", "event_date", "event_type", "transaction_category",
    "miles_amount", "platform", "utm_source", "country", "gender",
    "engagement_bucket",
)

DIM_USER_COLUMNS = (
    "user_id", "gender", "country", "first_seen_ts", "last_seen_ts",
    "first_seen_date", "last_seen_date", "lifetime_events",
)


def as_date_column(value: str | dt.date | Column) -> Column:
    """A date literal, or a Column (e.g. a scalar subquery) as is."""
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def fact_events(staged: DataFrame, backfill_start_date: str | dt.date | Column | None = None) -> DataFrame:
    """Event fact: staged events with their engagement bucket.

    ``backfill_start_date`` keeps events on or after that date, and undated
    ones, which no bound can place; ``None`` means no lower bound. Where the
    source's timestamps are instants (the readers see to it), both reach the
    parquet scan, as a range or a null on the timestamp. A staged
    ``event_id`` stays as the last column.
    """
    fct = staged.select(
        "user_id",
        "event_ts",
        F.to_date("event_ts").alias("event_date"),
        "event_type",
        "transaction_category",
        "miles_amount",
        "platform",
        "utm_source",
        "country",
        "gender",
        engagement_bucket("event_type").alias("engagement_bucket"),
        *[c for c in ("event_id",) if c in staged.columns],
    )
    if backfill_start_date is not None:
        fct = fct.filter((F.col("event_date") >= as_date_column(backfill_start_date)) | F.col("event_ts").isNull())
    return fct


def dim_user(staged: DataFrame) -> DataFrame:
    """One row per user over all staged events.

    gender/country are the first non-NULL values recorded; ``lifetime_events``
    counts distinct timestamps. Spark plans the distinct count in two steps
    (first shuffled on (user, ts), then on user), so a user holding a large
    share of all events is spread over many tasks. Columns that aren't asked
    for (the growth tables take gender and country alone) are not computed.
    """
    return staged.groupBy("user_id").agg(
        any_value_det("gender", "event_ts").alias("gender"),
        any_value_det("country", "event_ts").alias("country"),
        F.min("event_ts").alias("first_seen_ts"),
        F.max("event_ts").alias("last_seen_ts"),
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count_distinct("event_ts").alias("lifetime_events"),
    )


USER_DAY_COLUMNS = ("user_id", "event_date", "first_ts", "last_ts", "instants", "gender", "gender_ts", "country", "country_ts")


def user_days(staged: DataFrame) -> DataFrame:
    """The user dimension's mergeable state: one row per user and day.

    A timestamp lies in one day, so distinct timestamps add up over days; the
    first values keep their times, so that the first of several days can be told.
    """

    def first(column: str) -> Column:
        return F.min(F.when(F.col(column).isNotNull(), F.struct(F.col("event_ts").alias("t"), F.col(column).alias("v")))).alias(f"_{column}")

    days = staged.groupBy("user_id", "event_date").agg(
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.count_distinct("event_ts").alias("instants"),
        first("gender"),
        first("country"),
    )
    pairs = [F.col(f"_{c}.{k}").alias(c if k == "v" else f"{c}_ts") for c in ("gender", "country") for k in ("v", "t")]
    return days.select("user_id", "event_date", "first_ts", "last_ts", "instants", *pairs)


def dim_user_from_days(days: DataFrame) -> DataFrame:
    """The user dimension from ``user_days``: a row per user and day is read, no event."""
    return days.groupBy("user_id").agg(
        any_value_det("gender", "gender_ts").alias("gender"),
        any_value_det("country", "country_ts").alias("country"),
        F.min("first_ts").alias("first_seen_ts"),
        F.max("last_ts").alias("last_seen_ts"),
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.sum("instants").alias("lifetime_events"),
    )
