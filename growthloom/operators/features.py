"""Per-user period features and the feature-performance mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthloom.functions.cells import day_cells, events_of, first_value, top_value, value_counts
from growthloom.functions.codes import Values, coded, counted, first_of, top_of
from growthloom.functions.periods import GRAINS, period_from_index, period_index
from growthloom.functions.picks import approx_top_value

FEATURE_ATTRIBUTES = ("utm_source", "event_type", "transaction_category", "platform")
USER_CONSTANTS = ("country", "gender")

USER_FEATURE_COLUMNS = (
    "reporting_date", "user_id", "period_grain", "user_type", "country", "gender",
    *[f"first_{a}" for a in FEATURE_ATTRIBUTES],
    *[f"primary_{a}" for a in FEATURE_ATTRIBUTES],
    "event_count", "miles_earned", "miles_redeemed",
)

PERFORMANCE_DIMENSIONS = tuple(c for c in USER_FEATURE_COLUMNS if c not in ("user_id", "event_count", "miles_earned", "miles_redeemed"))


def _amount_of(event_type: str) -> Column:
    return F.when(F.col("event_type") == event_type, F.coalesce(F.col("miles_amount"), F.lit(0))).otherwise(F.lit(0))


def _rolled_events(fct: DataFrame, structs: Column, primary: str, values: Values | None = None) -> DataFrame:
    """One row per (user, grain, period), from events."""
    known: dict = {}
    if primary == "exact":
        known = {c: v for c, v in (values or {}).items() if c in USER_CONSTANTS} | counted(values or {}, FEATURE_ATTRIBUTES)
        primaries = [top_of(a, known, with_null=True).alias(f"primary_{a}") for a in FEATURE_ATTRIBUTES]
    else:
        primaries = [approx_top_value(a).alias(f"primary_{a}") for a in FEATURE_ATTRIBUTES]
    fct = fct.withColumns({"_earned": _amount_of("miles_earned"), "_redeemed": _amount_of("miles_redeemed")})
    ex = (coded(fct, known) if known else fct).select(
        "user_id", "event_ts", "event_type", "transaction_category", "_earned", "_redeemed",
        "platform", "utm_source", "country", "gender", F.inline(structs),
    )
    return ex.groupBy("user_id", "period_grain", "pidx").agg(
        *[first_of(c, "event_ts", known).alias(c) for c in USER_CONSTANTS],
        F.count(F.lit(1)).alias("event_count"),
        F.sum("_earned").alias("miles_earned"),
        F.sum("_redeemed").alias("miles_redeemed"),
        *[first_of(a, "event_ts", known).alias(f"first_{a}") for a in FEATURE_ATTRIBUTES],
        *primaries,
    )


def _rolled_cells(fct: DataFrame, structs: Column) -> DataFrame:
    """One row per (user, grain, period), from counts of values by day cell: events
    are reduced by a hash aggregate before anything multiplies them."""
    # Miles go with the values of event_type, the first of the attributes here.
    attributes = sorted([*FEATURE_ATTRIBUTES, "country", "gender"], key=lambda a: a != "event_type")
    keys = ["user_id", "period_grain", "pidx"]
    ex = day_cells(fct, attributes).select("user_id", "_n", "_miles", "_ts", *attributes, F.inline(structs))
    place = {a: i for i, a in enumerate(attributes)}
    counts = value_counts(ex, keys, attributes)
    zero = F.lit(0).cast("decimal(38,9)")

    def miles(event_type: str) -> Column:
        return F.sum(F.when(F.col("_attr") == 0, F.when(F.col("_value") == event_type, F.col("_miles")).otherwise(zero)))

    return counts.groupBy(*keys).agg(
        first_value(place["country"]).alias("country"),
        first_value(place["gender"]).alias("gender"),
        events_of().alias("event_count"),
        miles("miles_earned").alias("miles_earned"),
        miles("miles_redeemed").alias("miles_redeemed"),
        *[first_value(place[a]).alias(f"first_{a}") for a in FEATURE_ATTRIBUTES],
        *[top_value(place[a], with_null=True).alias(f"primary_{a}") for a in FEATURE_ATTRIBUTES],
    )


def user_period_features(
    fct: DataFrame,
    grain: str | tuple[str, ...] = "day",
    primary: str = "exact",
    week_start: str = "sunday",
    values: Values | None = None,
) -> DataFrame:
    """One row per user x period (NULL users form a group of their own).

    ``first_*``: first non-NULL value by time. ``primary_*``: most frequent
    value where NULL counts as a value; ``primary="exact"`` breaks ties to the
    smallest value (NULL smallest), ``primary="approx"`` uses a top-k sketch.
    ``primary="cells"`` is exact too, from counts by day cell: for sources with
    many events a user and day.
    ``user_type`` is ``new`` in the user's first period, else ``existing``.
    ``values`` are those of ``few_values``, if known: the same rows, sooner.
    """
    grains = (grain,) if isinstance(grain, str) else tuple(grain)
    for g in grains:
        if g not in GRAINS:
            raise ValueError(f"Invalid grain: {g}")
    if primary not in ("exact", "approx", "cells"):
        raise ValueError(f"Invalid primary mode: {primary}")
    structs = F.array(
        *[F.struct(F.lit(g).alias("period_grain"), period_index(F.col("event_date"), g, week_start).alias("pidx")) for g in grains]
    )
    if primary == "cells":
        rolled = _rolled_cells(fct, structs)
    else:
        rolled = _rolled_events(fct, structs, primary, values)
    # A user's rows here are bounded by the number of periods, so a window
    # within the user is cheap whatever the user's event volume.
    first_period = F.min("pidx").over(Window.partitionBy("user_id", "period_grain"))
    is_new = F.col("user_id").isNotNull() & (F.col("pidx") == first_period)
    return rolled.select(
        period_from_index(F.col("pidx"), F.col("period_grain"), week_start).alias("reporting_date"),
        "user_id",
        "period_grain",
        F.when(is_new, F.lit("new")).otherwise(F.lit("existing")).alias("user_type"),
        *USER_FEATURE_COLUMNS[4:],
    )


def top_value_states(fct: DataFrame, items: int = 32) -> DataFrame:
    """Top-k sketches of every attribute by user and day: a stored state from
    which any period's approximate primary values can be had. ``items`` bounds a
    sketch: the values it tracks."""
    return fct.groupBy("user_id", "event_date").agg(*[F.expr(f"approx_top_k_accumulate(`{a}`, {items})").alias(a) for a in FEATURE_ATTRIBUTES])


def approx_primaries(states: DataFrame, grain: str, week_start: str = "sunday") -> DataFrame:
    """(reporting_date, user_id, primary_*) from ``top_value_states``: days'
    sketches are combined, no event is read."""
    pidx = period_index(F.col("event_date"), grain, week_start).alias("pidx")
    combined = states.select("user_id", pidx, *FEATURE_ATTRIBUTES).groupBy("user_id", "pidx").agg(*[F.expr(f"approx_top_k_combine(`{a}`)").alias(a) for a in FEATURE_ATTRIBUTES])
    tops = [F.get(F.expr(f"approx_top_k_estimate(`{a}`, 1)"), 0)["item"].alias(f"primary_{a}") for a in FEATURE_ATTRIBUTES]
    return combined.select(period_from_index(F.col("pidx"), grain, week_start).alias("reporting_date"), "user_id", *tops)


def features_performance(features: DataFrame) -> DataFrame:
    """Group the features of all grains by every non-measure column.

    ``users`` is a distinct count; the input has one row per user per
    (reporting_date, period_grain) and both are grouping keys, so it equals
    the count of non-NULL user ids and needs no second shuffle.
    """
    return features.groupBy(*PERFORMANCE_DIMENSIONS).agg(
        F.count("user_id").alias("users"),
        F.sum("event_count").alias("event_count"),
        F.sum("miles_earned").alias("miles_earned"),
        F.sum("miles_redeemed").alias("miles_redeemed"),
    )
