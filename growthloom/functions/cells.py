"""Events reduced to mergeable counts before they are multiplied.

``day_cells`` is a first aggregate for what rolls up to periods:
one row per user, day, bucket and combination of attribute values, whose
buffers are numbers only, so it is a hash aggregate with a partial step on the
map side. Grains, engagement types and attributes multiply cells, never events,
and counts of values merge from days to any period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_KEYS = ("user_id", "event_date", "engagement_bucket")


def day_cells(fct: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """(user, day, bucket, *attributes) with events ``_n``, ``_miles`` and the first time ``_ts``.

    Dealt out by user afterwards: a user's cells are bounded by days and
    combinations of values, and every aggregate and window by user that follows
    needs no shuffle of its own.
    """
    cells = fct.groupBy(*CELL_KEYS, *attributes).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.coalesce(F.col("miles_amount"), F.lit(0))).alias("_miles"),
        F.min("event_ts").alias("_ts"),
    )
    return cells.repartition("user_id")


def value_counts(cells: DataFrame, group: Sequence[str], attributes: Sequence[str], flags: dict[str, Column] | None = None) -> DataFrame:
    """Counts of every attribute's values by ``group``: ``_attr`` (its place),
    ``_value``, ``_times``, ``_first`` (time); ``flags`` are 0/1 and kept if any
    row has 1. The first attribute's rows also carry ``_miles``."""
    flags = flags or {}
    none = F.lit(None).cast("decimal(38,9)")
    values = F.array(
        *[F.struct(F.lit(i).alias("_attr"), F.col(a).alias("_value"), (F.col("_miles") if i == 0 else none).alias("_miles")) for i, a in enumerate(attributes)]
    )
    each = cells.select(*group, "_n", "_ts", *[c.cast("int").alias(name) for name, c in flags.items()], F.inline(values))
    return each.groupBy(*group, "_attr", "_value").agg(
        F.sum("_n").alias("_times"),
        F.min("_ts").alias("_first"),
        F.sum("_miles").alias("_miles"),
        *[F.max(name).alias(name) for name in flags],
    )


def first_value(place: int) -> Column:
    """First non-NULL value by time of the attribute at ``place`` (ties: the smaller value), over ``value_counts``."""
    known = (F.col("_attr") == place) & F.col("_value").isNotNull()
    return F.min(F.when(known, F.struct("_first", "_value")))["_value"]


def top_value(place: int, with_null: bool = False) -> Column:
    """Most frequent value of the attribute at ``place``, over ``value_counts``; a
    tie goes to the smallest. ``with_null``: NULL is a value, the smallest."""
    counted = F.col("_attr") == place
    if not with_null:
        counted = counted & F.col("_value").isNotNull()
    return F.min(F.when(counted, F.struct((-F.col("_times")).alias("_order"), F.col("_value").alias("_value"))))["_value"]


def events_of(column: str = "_times") -> Column:
    """Number of events, over ``value_counts``: those of one attribute's values."""
    return F.sum(F.when(F.col("_attr") == 0, F.col(column)))
