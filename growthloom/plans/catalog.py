"""Registered queries: each takes (spark, base_dir) and returns a DataFrame
built over the whole input tables.

``events`` feeds the day and week grains (one month of fine-grained
events); ``orders`` feeds week and month grains (years of coarse events).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.operators.activity import event_detail_activity, user_activity
from growthloom.operators.core import DIM_USER_COLUMNS, FACT_COLUMNS, dim_user, fact_events
from growthloom.operators.features import FEATURE_ATTRIBUTES, approx_primaries, features_performance, top_value_states, user_period_features
from growthloom.operators.growth import growth_panel, growth_status, growth_user_features
from growthloom.operators.quality import grain_slices, run_checks
from growthloom.operators.reporting import (
    Dimension,
    Metric,
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
from growthloom.operators.retention import cohort_retention
from growthloom.operators.staging import stage_events
from growthloom.plans.dimension import refresh_dim_user
from growthloom.plans.loader import load_fact
from growthloom.plans.panel import refresh_panel
from growthloom.plans.refresh import MODELS, refresh
from growthloom.session import apply_runtime_conf, leave_task_sizes, shared_folder
from growthloom.sources.adapters import raw_events
from growthloom.sources.sinks import merge_table, read_target, write_table
from growthloom.sources.tables import table_bytes

Query = Callable[[SparkSession, str], DataFrame]


def staged(spark: SparkSession, base_dir: str, source: str) -> DataFrame:
    apply_runtime_conf(spark, table_bytes(spark, base_dir, source))
    return stage_events(raw_events(spark, base_dir, source))


def fact(spark: SparkSession, base_dir: str, source: str) -> DataFrame:
    return fact_events(staged(spark, base_dir, source))


def users(spark: SparkSession, base_dir: str, source: str) -> DataFrame:
    return dim_user(staged(spark, base_dir, source))


def _growth_features(source: str, grains) -> Query:
    return lambda spark, d: growth_user_features(fact(spark, d, source), users(spark, d, source), grains)


def _generic_grouping(spark: SparkSession, d: str) -> DataFrame:
    """The generic grouping report with the traps of its rules: a repeated
    set, the same columns in two orders, and a set naming a default."""
    source = growth_user_features(fact(spark, d, "orders"), users(spark, d, "orders"), "month")
    return grouping_report(
        source,
        dimensions=[
            Dimension("period_start", "period_start", "date"),
            Dimension("engagement_type", "engagement_type", "string"),
            Dimension("country", "country", "string"),
            Dimension("platform", "primary_platform_in_period", "string"),
            Dimension("category", "primary_transaction_category_in_period", "string"),
        ],
        aggregation_sets=[["country", "platform"], ["platform", "country"], ["engagement_type"], ["category"], ["category"]],
        metrics=[
            Metric("users", "count(distinct user_id)"),
            Metric("total_events", "sum(period_event_count)"),
            Metric("churned_rows", "sum(case when growth_status = 'churned' then 1 else 0 end)"),
        ],
        default_dimensions=["period_start"],
        include_overall=True,
    )


def _awkward(spark: SparkSession, d: str) -> DataFrame:
    """Staged events with NULL users and types, and undated ones."""
    minute = F.minute("event_ts")
    return (
        staged(spark, d, "events")
        .withColumn("user_id", F.when(minute != 7, F.col("user_id")))
        .withColumn("event_type", F.when(minute != 11, F.col("event_type")))
        .withColumn("event_date", F.when(minute != 13, F.col("event_date")))
        .withColumn("event_ts", F.when(minute != 13, F.col("event_ts")))
    )


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/growthloom-{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def _cut(stg: DataFrame) -> dt.date:
    """A week before the last day."""
    return stg.agg(F.max("event_date")).first()[0] - dt.timedelta(days=7)


def _fact_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Written and read back. A first load up to a week before the last day:
    half of that day's rows are missing and the others stale, and an earlier
    day lacks its afternoon. Then two incremental runs over all staged events
    put the last loaded day right and leave the earlier one as it is."""
    stg = _awkward(spark, d)
    cut = _cut(stg)
    day, late = F.col("event_date"), F.hour("event_ts") >= 12
    loaded = (day.isNull() | (day < cut) | ((day == cut) & ~late)) & ~F.coalesce((day == cut - dt.timedelta(days=3)) & late, F.lit(False))
    stale = F.when(day == cut, F.col("miles_amount") + 1).otherwise(F.col("miles_amount")).cast("decimal(38,9)")
    path = scratch(spark, "fact")
    load_fact(spark, stg.filter(loaded).withColumn("miles_amount", stale), path, "full")
    for _ in range(2):
        load_fact(spark, stg, path, "incremental")
    return read_target(spark, path).select(*FACT_COLUMNS)


def _fact_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Written and read back. A fact whose last days and undated rows are
    stale; then a backfill from a source in which one of those days is gone."""
    stg = _awkward(spark, d)
    cut = _cut(stg)
    start, gone = cut - dt.timedelta(days=5), cut + dt.timedelta(days=2)
    day = F.col("event_date")
    stale = F.when(day < start, F.col("miles_amount")).otherwise(F.col("miles_amount") + 1).cast("decimal(38,9)")
    path = scratch(spark, "fact")
    load_fact(spark, stg.withColumn("miles_amount", stale), path, "full")
    load_fact(spark, stg.filter(~day.eqNullSafe(F.lit(gone))), path, "backfill", backfill_start_date=start)
    return read_target(spark, path).select(*FACT_COLUMNS)


def _dim_user_merged(spark: SparkSession, d: str) -> DataFrame:
    """Written, merged by user and read back: a first load of all users up to
    a week before the last day, then one from a source without a fifth of them."""
    stg = staged(spark, d, "events")
    path = scratch(spark, "dim")
    kept = F.col("user_id").isNull() | (F.col("user_id") % 5 != 0)
    merge_table(spark, dim_user(stg.filter(F.col("event_date") <= _cut(stg))), path, ["user_id"], ["first_seen_date"], ["user_id"])
    merge_table(spark, dim_user(stg.filter(kept)), path, ["user_id"], ["first_seen_date"], ["user_id"])
    return read_target(spark, path).select(*DIM_USER_COLUMNS)


def _dim_user_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Written by days and read back: a first load up to a week before the last
    day, of which the afternoon is missing, then two runs that read new days alone."""
    stg = _awkward(spark, d)
    cut = _cut(stg)
    dim, days = scratch(spark, "dim"), scratch(spark, "days")
    day = F.col("event_date")
    refresh_dim_user(spark, stg.filter(day.isNull() | (day < cut) | ((day == cut) & (F.hour("event_ts") < 12))), dim, days)
    for _ in range(2):
        refresh_dim_user(spark, stg, dim, days)
    return read_target(spark, dim).select(*DIM_USER_COLUMNS)


def _panel_incremental(grain: str) -> Query:
    """Written and read back: a panel from the orders up to some weeks before the
    last day, then runs that read new days and the state, up to the middle of
    these weeks, to the end, and to the end again."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        path = scratch(spark, "panel")
        fct = fact(spark, d, "orders")
        last = fct.agg(F.max("event_date")).first()[0]
        for back in (75, 31, 0, 0):
            refresh_panel(spark, fct.filter(F.col("event_date") <= F.lit(last - dt.timedelta(days=back))), path, f"{path}-state", grain)
        return read_target(spark, path)

    return run


def _refreshed(spark: SparkSession, d: str, *tags: str) -> str:
    """A new warehouse: all models from events up to a week before the last day, then whole groups by tag from all events."""
    warehouse = scratch(spark, "warehouse")
    raw = raw_events(spark, d, "events")
    cut = _cut(staged(spark, d, "events"))
    leave_task_sizes(spark)
    refresh(spark, raw.filter(F.to_date(F.col("event_time").cast("timestamp")) <= cut), warehouse)
    for tag in tags:
        refresh(spark, raw, warehouse, tag=tag)
    return warehouse


def _refresh_groups(spark: SparkSession, d: str) -> DataFrame:
    """All refresh groups; row counts of every table written, read back. The daily group
    runs again at the end, as its tables over all grains read those of the other groups."""
    warehouse = _refreshed(spark, d, "refresh_daily", "refresh_weekly", "refresh_monthly", "refresh_daily")
    out = None
    for model in MODELS:
        if model.materialized != "view":
            rows = read_target(spark, f"{warehouse}/{model.layer}/{model.name}").agg(F.lit(model.name).alias("model"), F.count(F.lit(1)).alias("n_rows"))
            out = rows if out is None else out.unionByName(rows)
    return out


def _refresh_weekly(spark: SparkSession, d: str) -> DataFrame:
    """The daily and weekly groups; row counts by part read back from three tables (``refresh_groups`` has all)."""
    warehouse = _refreshed(spark, d, "refresh_daily", "refresh_weekly")
    parts = (("intermediate", "int_user_growth_status_weekly", "growth_status"), ("marts", "fct_cohort_retention_weekly", "engagement_type"), ("core", "fct_events", "engagement_bucket"))
    out = None
    for layer, model, part in parts:
        rows = read_target(spark, f"{warehouse}/{layer}/{model}").groupBy(F.lit(model).alias("model"), F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _approx_tops(spark: SparkSession, d: str) -> DataFrame:
    """The approximate primary values of user-months, from events."""
    fct = fact(spark, d, "orders")
    return _hits(fct, user_period_features(fct, "month", primary="approx"))


def _sketched_tops(spark: SparkSession, d: str) -> DataFrame:
    """The approximate primary values of user-months, from stored sketches of user-days."""
    fct = fact(spark, d, "orders")
    path = scratch(spark, "sketches")
    write_table(top_value_states(fct), path)
    return _hits(fct, approx_primaries(read_target(spark, path), "month"))


def _hits(fct: DataFrame, picks: DataFrame) -> DataFrame:
    """Per attribute: user-months, and those whose picked primary value is a most frequent one by exact counts."""
    values = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("v")) for a in FEATURE_ATTRIBUTES])
    chosen = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"primary_{a}").alias("pick")) for a in FEATURE_ATTRIBUTES])
    period = F.trunc("event_date", "month").alias("reporting_date")
    counts = fct.select("user_id", period, F.inline(values)).groupBy("user_id", "reporting_date", "attribute", "v").agg(F.count(F.lit(1)).alias("times"))
    tops = counts.groupBy("user_id", "reporting_date", "attribute").agg(F.max("times").alias("most"), F.max(F.when(F.col("v").isNotNull(), F.col("times"))).alias("most_known"), F.collect_list(F.struct("v", "times")).alias("all"))
    both = picks.select(F.col("user_id").alias("u"), F.col("reporting_date").alias("r"), F.inline(chosen)).withColumnRenamed("attribute", "a")
    # Sorted on both sides: files of sketches are small, the rows made from them aren't, so neither is broadcast by its files' size.
    joined = both.hint("merge").join(tops.hint("merge"), both["u"].eqNullSafe(tops["user_id"]) & (both["r"] == tops["reporting_date"]) & (both["a"] == tops["attribute"]))
    hit = F.exists("all", lambda x: x["v"].eqNullSafe(F.col("pick")) & ((x["times"] == F.col("most")) | (x["times"] == F.col("most_known"))))
    return joined.groupBy("attribute").agg(F.count(F.lit(1)).alias("user_periods"), F.count(F.when(hit, 1)).alias("with_a_top_value"))


def _dq_core(spark: SparkSession, d: str) -> DataFrame:
    return run_checks({"fct_events": fact(spark, d, "events"), "dim_user": users(spark, d, "events")})


def _dq_marts(spark: SparkSession, d: str) -> DataFrame:
    fct, du = fact(spark, d, "orders"), users(spark, d, "orders")
    panel = grain_slices(growth_panel(fct, du, ("week", "month")))
    features = grain_slices(user_period_features(fct, ("week", "month")))
    cohorts = grain_slices(cohort_retention(fct, ("month", "week")))
    tables = {}
    for grain, suffix in (("week", "weekly"), ("month", "monthly")):
        tables[f"fct_growth_user_features_{suffix}"] = panel(grain)
        tables[f"int_user_growth_status_{suffix}"] = panel(grain)
        tables[f"int_user_features_{suffix}"] = features(grain)
        tables[f"fct_cohort_retention_{suffix}"] = cohorts(grain)
    return run_checks(tables | {"fct_cohort_retention_combined": cohorts()})


def _dq_daily(spark: SparkSession, d: str) -> DataFrame:
    fct, du = fact(spark, d, "events"), users(spark, d, "events")
    grains = ("day", "week", "month")
    panel = grain_slices(growth_panel(fct, du, grains))
    tables = {
        "fct_growth_user_features_daily": panel("day"),
        "int_user_growth_status_daily": panel("day"),
        "int_user_features_daily": user_period_features(fct, "day"),
        "fct_growth_user_features_combined": panel(),
        "fct_user_features_performance": features_performance(user_period_features(fct, grains)),
    }
    return run_checks(tables)


def _retained_30d(spark: SparkSession, d: str) -> DataFrame:
    fct = fact(spark, d, "events")
    return trailing_active_users(fct, fct.select(F.max("event_date")).scalar(), 30, "transaction")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "stg_events": lambda s, d: staged(s, d, "events"),
        "fct_events": lambda s, d: fact(s, d, "events"),
        "dim_user": lambda s, d: users(s, d, "events"),
        "dim_user_orders": lambda s, d: users(s, d, "orders"),
        "event_detail_activity": lambda s, d: event_detail_activity(fact(s, d, "events")),
        "event_activity": lambda s, d: event_activity_report(event_detail_activity(fact(s, d, "events"))),
        "event_activity_orders": lambda s, d: event_activity_report(event_detail_activity(fact(s, d, "orders"))),
        "user_features_day": lambda s, d: user_period_features(fact(s, d, "events"), "day"),
        "user_features_week": lambda s, d: user_period_features(fact(s, d, "events"), "week"),
        "user_features_month": lambda s, d: user_period_features(fact(s, d, "orders"), "month"),
        "user_features_approx_month": _approx_tops,
        "user_features_sketch_month": _sketched_tops,
        "features_performance": lambda s, d: features_performance(user_period_features(fact(s, d, "events"), ("day", "week", "month"))),
        "features_performance_cells": lambda s, d: features_performance(user_period_features(fact(s, d, "events"), ("day", "week", "month"), primary="cells")),
        "growth_status_day": lambda s, d: growth_status(fact(s, d, "events"), "day"),
        "growth_status_week": lambda s, d: growth_status(fact(s, d, "events"), "week"),
        "growth_status_week_orders": lambda s, d: growth_status(fact(s, d, "orders"), "week"),
        "growth_status_month": lambda s, d: growth_status(fact(s, d, "orders"), "month"),
        "growth_status_week_monday": lambda s, d: growth_status(fact(s, d, "events"), "week", week_start="monday"),
        "growth_features_day": _growth_features("events", "day"),
        "growth_features_week": _growth_features("events", "week"),
        "growth_features_month": _growth_features("orders", "month"),
        "growth_features_combined": _growth_features("events", ("day", "week", "month")),
        "growth_report": lambda s, d: growth_report_from_events(fact(s, d, "events"), users(s, d, "events")),
        "growth_report_dense": lambda s, d: growth_report(_growth_features("events", ("day", "week", "month"))(s, d)),
        "growth_report_orders": lambda s, d: growth_report_from_events(fact(s, d, "orders"), users(s, d, "orders"), ("week", "month")),
        # Day grain over years of orders: the dense panel would be users x days;
        # the report from events only follows the active rows.
        "growth_report_orders_day": lambda s, d: growth_report_from_events(fact(s, d, "orders"), users(s, d, "orders"), ("day",)),
        "grouping_report_generic": _generic_grouping,
        "cohort_week": lambda s, d: cohort_retention(fact(s, d, "orders"), "week"),
        "cohort_month": lambda s, d: cohort_retention(fact(s, d, "orders"), "month"),
        "cohort_combined": lambda s, d: cohort_retention(fact(s, d, "orders"), ("month", "week")),
        "cohort_week_events": lambda s, d: cohort_retention(fact(s, d, "events"), "week"),
        "user_activity_day": lambda s, d: user_activity(fact(s, d, "events"), "day"),
        "user_activity_week": lambda s, d: user_activity(fact(s, d, "events"), "week"),
        "user_activity_month": lambda s, d: user_activity(fact(s, d, "orders"), "month"),
        "engagement_metrics_day": lambda s, d: engagement_metrics(user_activity(fact(s, d, "events"), "day"), "day"),
        "engagement_metrics_week": lambda s, d: engagement_metrics(user_activity(fact(s, d, "events"), "week"), "week"),
        "engagement_metrics_month": lambda s, d: engagement_metrics(user_activity(fact(s, d, "orders"), "month"), "month"),
        "miles_mix": lambda s, d: miles_mix(fact(s, d, "events")),
        "redemption_rate": lambda s, d: redemption_rate(fact(s, d, "orders")),
        "retention_curve_month": lambda s, d: retention_curve(cohort_retention(fact(s, d, "orders"), "month")),
        "user_trend": lambda s, d: user_trend(growth_report_from_events(fact(s, d, "orders"), users(s, d, "orders"), ("week", "month"))),
        "retained_users_30d": _retained_30d,
        "dq_core": _dq_core,
        "dq_marts": _dq_marts,
        "dq_daily": _dq_daily,
        "fact_incremental": _fact_incremental,
        "fact_backfill": _fact_backfill,
        "dim_user_merged": _dim_user_merged,
        "dim_user_incremental": _dim_user_incremental,
        "growth_status_week_incremental": _panel_incremental("week"),
        "growth_status_month_incremental": _panel_incremental("month"),
        "refresh_weekly": _refresh_weekly,
        "refresh_groups": _refresh_groups,
    }
    return q
