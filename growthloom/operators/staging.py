"""Staging of the raw event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGED_COLUMNS = (
    "event_ts", "event_date", "user_id", "gender", "event_type",
    "transaction_category", "miles_amount", "platform", "utm_source", "country",
)


def stage_events(raw: DataFrame) -> DataFrame:
    """Rename and type the raw columns; no rows are dropped.

    ``event_time`` becomes a timestamp ``event_ts`` and its UTC calendar date
    ``event_date``; ``miles_amount`` becomes decimal(38,9) (NUMERIC). An
    ``event_id`` of the source is kept as the last column.
    """
    ts = F.col("event_time").cast("timestamp")
    return raw.select(
        ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        "user_id",
        "gender",
        "event_type",
        "transaction_category",
        F.col("miles_amount").cast("decimal(38,9)").alias("miles_amount"),
        "platform",
        "utm_source",
        "country",
        *[c for c in ("event_id",) if c in raw.columns],
    )
