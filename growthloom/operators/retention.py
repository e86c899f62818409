"""Cohort retention by week or month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthloom.functions.codes import Values, coded, timed, value_of
from growthloom.functions.periods import engagement_types, period_from_index, period_index

RETENTION_GRAINS = ("week", "month")

COHORT_COLUMNS = (
    "cohort_period", "period_number", "engagement_type", "country", "gender",
    "cohort_size", "retained_users", "retention_rate", "period_grain",
)


def _first(value: str, known: Values) -> Column:
    if value in known:
        return F.min(timed(value, "event_ts"))
    v, t = F.col(value), F.col("event_ts")
    return F.min(F.when(v.isNotNull(), F.struct(t.alias("t"), v.alias("v"))))


def _user_periods(fct: DataFrame, grains: tuple[str, ...], week_start: str, known: Values) -> DataFrame:
    """One row per (user, grain, period, engagement type), with the first
    recorded country/gender of that group kept as (ts, value) structs, or longs
    where ``known``, so they can be combined again at the (user, type) level."""
    structs = F.array(
        *[F.struct(F.lit(g).alias("period_grain"), period_index(F.col("event_date"), g, week_start).alias("pidx")) for g in grains]
    )
    # Raw events are reduced to a row per day and values before they are
    # multiplied: a hash aggregate, as its buffer is one timestamp.
    # Dealt out by user, so that what follows within a user isn't shuffled again.
    fct = coded(fct, known) if known else fct
    days = fct.groupBy("user_id", "event_date", "engagement_bucket", "country", "gender").agg(F.min("event_ts").alias("event_ts")).repartition("user_id")
    ex = days.select("user_id", "event_ts", "country", "gender", "engagement_bucket", F.inline(structs))
    ex = ex.select(
        "user_id", "event_ts", "country", "gender", "period_grain", "pidx",
        F.explode(engagement_types("engagement_bucket")).alias("engagement_type"),
    )
    return ex.groupBy("user_id", "period_grain", "pidx", "engagement_type").agg(
        _first("country", known).alias("_country"),
        _first("gender", known).alias("_gender"),
    )


def cohort_retention(
    fct: DataFrame,
    grain: str | tuple[str, ...] = "month",
    join_on: str = "all",
    week_start: str = "sunday",
    values: Values | None = None,
) -> DataFrame:
    """Cohort = first active period per user x engagement type.

    ``join_on="all"`` (default) reports at the documented grain, cohort x
    type x country x gender: sizes and retained users are matched on all four
    keys (NULL-safe), so rates never exceed 1 and NULL users drop out.
    ``join_on="cohort"`` matches sizes on cohort and type only, as the
    published SQL does: rows multiply across countries/genders, and a NULL
    user adds a size-0 group. ``values`` are those of ``few_values``, if known:
    the same rows, sooner.
    """
    grains = (grain,) if isinstance(grain, str) else tuple(grain)
    for g in grains:
        if g not in RETENTION_GRAINS:
            raise ValueError(f"Invalid grain: {g}")
    if join_on not in ("all", "cohort"):
        raise ValueError(f"Invalid join_on: {join_on}")

    known = {c: values[c] for c in ("country", "gender") if c in values} if values else {}
    up = _user_periods(fct, grains, week_start, known)
    # Rows of one (user, grain, type) are bounded by the number of periods.
    per_user = Window.partitionBy("user_id", "period_grain", "engagement_type")

    def earliest(c: str) -> Column:
        first = F.min(f"_{c}").over(per_user)
        return (value_of(first, known[c]) if c in known else first["v"]).alias(c)

    up = up.select(
        "user_id", "period_grain", "pidx", "engagement_type",
        F.min("pidx").over(per_user).alias("cohort_idx"),
        earliest("country"),
        earliest("gender"),
    )
    group = ["period_grain", "cohort_idx", "engagement_type", "country", "gender"]
    # One row per user and period, so counting rows counts distinct users.
    # Events without a date have no period and are never retained.
    retention = (
        up.filter(F.col("user_id").isNotNull() & F.col("pidx").isNotNull())
        .withColumn("period_number", (F.col("pidx") - F.col("cohort_idx")).cast("bigint"))
        .groupBy(*group, "period_number")
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    if join_on == "all":
        # Every cohort member is active in period 0, so the size of a
        # (cohort, type, country, gender) group is its period-0 count.
        size = F.max(F.when(F.col("period_number") == 0, F.col("retained_users"))).over(Window.partitionBy(*group))
        out = retention.withColumn("cohort_size", size)
    else:
        sizes = (
            up.filter(F.col("pidx") == F.col("cohort_idx"))
            .groupBy(*group)
            .agg(F.count_distinct("user_id").alias("cohort_size"))
        )
        out = retention.drop("country", "gender").join(
            sizes, ["period_grain", "cohort_idx", "engagement_type"], "inner"
        )
    return out.select(
        period_from_index(F.col("cohort_idx"), F.col("period_grain"), week_start).alias("cohort_period"),
        "period_number",
        "engagement_type",
        "country",
        "gender",
        F.col("cohort_size").cast("bigint").alias("cohort_size"),
        "retained_users",
        F.try_divide(F.col("retained_users"), F.col("cohort_size")).cast("double").alias("retention_rate"),
        "period_grain",
    )


def cohort_retention_combined(fct: DataFrame, join_on: str = "all", week_start: str = "sunday") -> DataFrame:
    """Month and week cohorts together (one pass over the events)."""
    return cohort_retention(fct, ("month", "week"), join_on, week_start)
