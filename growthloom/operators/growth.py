"""Growth status panel (new / retained / resurrected / churned) and the
per-panel-row growth features.

Plan (no range join, no per-row Python):

1. explode each event into its grains x engagement types and aggregate to
   one row per active (user, grain, period, type); the aggregate combines
   map-side, so a hot user's events shrink to at most one row per period
   before the shuffle;
2. one repartition by user_id; a user's rows are bounded by the number of
   calendar periods, never by the number of events;
3. windows within the user give the previous and next active period and the
   user's first period overall;
4. each active row emits itself plus the idle periods up to its next active
   period (or the global last period) as ``churned`` rows: the dense panel
   is generated in place, with no spine cross join and no self joins.

The user dimension is joined to the active rows before the idle periods
are generated; the active rows keep the user partitioning and order, so
the join moves and sorts only the dimension.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthloom.functions.codes import Values, coded, counted, first_of, top_of
from growthloom.functions.periods import (
    GRAINS,
    engagement_types,
    period_from_index,
    period_index,
)
from growthloom.functions.picks import flag_any

ATTRIBUTES = ("platform", "utm_source", "event_type", "transaction_category")

GROWTH_STATUS_COLUMNS = (
    "user_id", "period_start", "period_grain", "engagement_type",
    "is_active_current", "is_active_prior", "has_historical_before_prior",
    "growth_status", "is_new_customer", "customer_status",
)

GROWTH_FEATURE_COLUMNS = (
    "user_id", "period_start", "period_grain", "engagement_type", "growth_status",
    "gender", "country",
    *[f"first_{a}_in_period" for a in ATTRIBUTES],
    *[f"primary_{a}_in_period" for a in ATTRIBUTES],
    "period_event_count", "period_miles_amount", "has_transaction_event",
    "has_pre_engagement_event",
)

# Value of each measure on an idle (churned) panel row, with its type.
_METRIC_DEFAULTS = {
    "period_event_count": "bigint",
    "period_miles_amount": "decimal(38,9)",
    "has_transaction_event": "int",
    "has_pre_engagement_event": "int",
}


def _grains(grain: str | tuple[str, ...] | list[str]) -> tuple[str, ...]:
    gs = (grain,) if isinstance(grain, str) else tuple(grain)
    for g in gs:
        if g not in GRAINS:
            raise ValueError(f"Invalid grain: {g}")
    return gs


def _explode_grains(df: DataFrame, grains: tuple[str, ...], week_start: str, keep: list[str]) -> DataFrame:
    structs = F.array(
        *[
            F.struct(
                F.lit(g).alias("period_grain"),
                period_index(F.col("event_date"), g, week_start).alias("pidx"),
            )
            for g in grains
        ]
    )
    return df.select(*keep, F.inline(structs))


def _active_rows(fct: DataFrame, grains: tuple[str, ...], week_start: str, with_metrics: bool, values: Values | None = None) -> DataFrame:
    """``values``: every value of an attribute, by attribute, as ``few_values`` finds
    them in ``fct``; few enough of them are aggregated as numbers (see ``codes``)."""
    keys = ["user_id", "period_grain", "pidx", "engagement_type"]
    base = fct.filter(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
    known = counted(values or {}, ATTRIBUTES)
    if with_metrics and known:
        base = coded(base, known)
    keep = ["user_id", "engagement_bucket"]
    if with_metrics:
        keep += ["event_ts", "miles_amount", *ATTRIBUTES]
    ex = _explode_grains(base, grains, week_start, keep)
    ex = ex.select(
        *[c for c in ex.columns if c != "engagement_bucket"],
        "engagement_bucket",
        F.explode(engagement_types("engagement_bucket")).alias("engagement_type"),
    )
    if not with_metrics:
        return ex.select(*keys).distinct()
    bucket = F.col("engagement_bucket")
    aggs = [
        F.count(F.lit(1)).alias("period_event_count"),
        F.sum(F.coalesce(F.col("miles_amount"), F.lit(0))).alias("period_miles_amount"),
        flag_any(bucket == "transaction").alias("has_transaction_event"),
        flag_any(bucket == "pre_engagement").alias("has_pre_engagement_event"),
    ]
    aggs += [first_of(a, "event_ts", known).alias(f"first_{a}_in_period") for a in ATTRIBUTES]
    aggs += [top_of(a, known).alias(f"primary_{a}_in_period") for a in ATTRIBUTES]
    return ex.groupBy(*keys).agg(*aggs)


def sequenced_activity(fct: DataFrame, grains: tuple[str, ...], week_start: str, with_metrics: bool, values: Values | None = None) -> DataFrame:
    """Active (user, grain, period index, type) rows with the previous and next
    active period of the same user and type (``_prev``, ``_next``), the
    user's first period over all types (``_first_overall``) and the global
    last period index of the grain (``_last``).

    Partitioned by user_id; windows run within a user, whose rows are
    bounded by the number of calendar periods.
    """
    # Last period over all events (NULL users included), a scalar subquery.
    last_date = fct.select(F.max("event_date")).scalar()
    act = _active_rows(fct, grains, week_start, with_metrics, values).repartition("user_id")

    by_user = Window.partitionBy("user_id")
    by_seq = Window.partitionBy("user_id", "period_grain", "engagement_type").orderBy("pidx")
    grain = F.col("period_grain")
    first_overall = None
    for g in grains:
        m = F.min(F.when(grain == g, F.col("pidx"))).over(by_user)
        first_overall = F.when(grain == g, m) if first_overall is None else first_overall.when(grain == g, m)
    act = act.withColumn("_first_overall", first_overall)
    act = act.withColumn("_prev", F.lag("pidx").over(by_seq)).withColumn("_next", F.lead("pidx").over(by_seq))
    return act.withColumn("_last", period_index(last_date, grain, week_start))


def active_status() -> Column:
    """Status of an active row from its previous active period."""
    pidx, prev = F.col("pidx"), F.col("_prev")
    return (
        F.when(prev.isNull(), F.lit("new"))
        .when(prev == pidx - 1, F.lit("retained"))
        .otherwise(F.lit("resurrected"))
    )


def gap_end() -> Column:
    """Last idle period after an active row: up to the next active period, or
    the global last period."""
    return F.coalesce(F.col("_next") - F.lit(1), F.col("_last"))


def _panel(
    fct: DataFrame,
    grains: tuple[str, ...],
    week_start: str,
    with_metrics: bool,
    users: DataFrame | None = None,
    values: Values | None = None,
) -> DataFrame:
    act = sequenced_activity(fct, grains, week_start, with_metrics, values)
    if users is not None:
        # Join the user attributes to the active rows, before the idle periods
        # are generated: the join sorts the active rows (already ordered by
        # user from the window) instead of the much larger dense panel.
        act = act.join(users.select("user_id", "gender", "country"), "user_id", "left")
    return _panel_rows(act, week_start, with_metrics, users is not None)


def _panel_rows(act: DataFrame, week_start: str, with_metrics: bool, with_users: bool, since: int | None = None) -> DataFrame:
    """Sequenced active rows as panel rows: themselves and the idle periods after them."""
    grain = F.col("period_grain")
    if "_begin" in act.columns:
        periods = F.sequence(F.col("_begin"), F.col("_end"))
    else:
        periods = _idle_or_active(since, lambda begin, end: F.sequence(begin, end))
    rows = act.withColumn("_p", F.explode(periods))

    pidx, p, prev = F.col("pidx"), F.col("_p"), F.col("_prev")
    active = p == pidx
    prior_active = F.when(active, F.coalesce(prev == pidx - 1, F.lit(False))).otherwise(p == pidx + 1)
    historical = active & F.coalesce(prev < pidx - 1, F.lit(False))
    status = F.when(~active, F.lit("churned")).otherwise(active_status())
    new_customer = active & (pidx == F.col("_first_overall"))
    cols: list[Column] = [
        F.col("user_id"),
        period_from_index(p, grain, week_start).alias("period_start"),
        grain.alias("period_grain"),
        F.col("engagement_type"),
        active.cast("int").alias("is_active_current"),
        prior_active.cast("int").alias("is_active_prior"),
        historical.cast("int").alias("has_historical_before_prior"),
        status.alias("growth_status"),
        new_customer.alias("is_new_customer"),
        F.when(new_customer, F.lit("new_customer")).otherwise(F.lit("existing_customer")).alias("customer_status"),
    ]
    if with_users:
        cols += [F.col("gender"), F.col("country")]
    if with_metrics:
        for a in ATTRIBUTES:
            for kind in ("first", "primary"):
                name = f"{kind}_{a}_in_period"
                cols.append(F.when(active, F.col(name)).alias(name))
        for name, dtype in _METRIC_DEFAULTS.items():
            cols.append(F.when(active, F.col(name)).otherwise(F.lit(0).cast(dtype)).alias(name))
    return rows.select(*cols)


def _idle_or_active(since: int | None, build: Callable[[Column, Column], Column]) -> Column:
    """``build`` of the first and last period (``since`` at least) of an active row's panel rows; NULL if it has none."""
    if since is None:
        return build(F.col("pidx"), gap_end())
    begin = F.greatest(F.col("pidx"), F.lit(since))
    return F.when(gap_end() >= begin, build(begin, gap_end()))


def spans(act: DataFrame, of: int, since: int | None = None) -> DataFrame:
    """Sequenced active rows, each as the runs of its panel rows that lie in one stretch (``_stretch``) of ``of``
    periods, from ``_begin`` to ``_end``. Few rows that stand for many: to be moved and sorted before
    ``status_rows`` makes the panel rows of them."""
    stretch = _idle_or_active(since, lambda begin, end: F.sequence(F.floor(begin / of).cast("int"), F.floor(end / of).cast("int")))
    first = F.col("pidx") if since is None else F.greatest(F.col("pidx"), F.lit(since))
    rows = act.withColumn("_stretch", F.explode(stretch))
    low = F.col("_stretch") * of
    return rows.withColumn("_begin", F.greatest(first, low)).withColumn("_end", F.least(gap_end(), low + (of - 1)))


def active_types(fct: DataFrame, grain: str, week_start: str = "sunday") -> DataFrame:
    """The active periods (user_id, engagement_type, pidx) of one grain."""
    return _active_rows(fct, _grains(grain), week_start, with_metrics=False).select("user_id", "engagement_type", "pidx")


def status_rows(act: DataFrame, week_start: str = "sunday", since: int | None = None) -> DataFrame:
    """Panel rows of sequenced active periods (see ``sequenced_activity``) or of their ``spans``; of the periods
    from ``since`` on, if given."""
    return _panel_rows(act, week_start, with_metrics=False, with_users=False, since=since).select(*GROWTH_STATUS_COLUMNS)


def growth_status(fct: DataFrame, grain: str | tuple[str, ...] = "day", week_start: str = "sunday") -> DataFrame:
    """Dense panel per user x engagement type from its first active period to
    the global last period, each row classified.

    ``grain`` may be one grain or several (rows of all grains, in one pass).
    NULL users have no rows.
    """
    return _panel(fct, _grains(grain), week_start, with_metrics=False).select(*GROWTH_STATUS_COLUMNS)


def growth_user_features(
    fct: DataFrame,
    users: DataFrame,
    grain: str | tuple[str, ...] = "day",
    week_start: str = "sunday",
    values: Values | None = None,
) -> DataFrame:
    """Growth panel rows with the user's gender/country and per-row activity:
    event count, miles, 0/1 bucket flags, first and most frequent value of
    platform, utm_source, event_type and transaction_category (NULLs skipped;
    ties go to the smaller value). Churned rows carry 0 and NULL. ``values`` are
    those of ``few_values``, if known: the same rows, sooner.
    """
    panel = _panel(fct, _grains(grain), week_start, with_metrics=True, users=users, values=values)
    return panel.select(*GROWTH_FEATURE_COLUMNS)


def growth_panel(fct: DataFrame, users: DataFrame, grain: str | tuple[str, ...] = "day", week_start: str = "sunday") -> DataFrame:
    """The columns of ``growth_status`` and ``growth_user_features`` together, in one pass."""
    panel = _panel(fct, _grains(grain), week_start, with_metrics=True, users=users)
    return panel.select(*GROWTH_STATUS_COLUMNS, *[c for c in GROWTH_FEATURE_COLUMNS if c not in GROWTH_STATUS_COLUMNS])


def growth_user_features_combined(fct: DataFrame, users: DataFrame, week_start: str = "sunday") -> DataFrame:
    """Day, week and month growth features together."""
    return growth_user_features(fct, users, GRAINS, week_start)
