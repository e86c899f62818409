"""Build or refresh the marts: a fixed, ordered list of models.

Each model is a view (a lazy DataFrame, also registered as a temp view), a
table (parquet, rewritten) or the incremental event fact. A model selected
for this run is built from its upstream models; an upstream table that is
not selected is read from the warehouse as it was last written. Written
tables are read back, which cuts the lineage between steps. Models that don't
need each other are built at the same time, a few at once: Spark gives the cores
that one model's job leaves idle to the next one's.

Tags: models whose name ends in _daily/_weekly/_monthly get
refresh_daily/_weekly/_monthly; the other models carry the tags listed
below. The daily group also holds staging, the core tables and the event
activity report, so a daily run starts from fresh facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from growthloom.functions.codes import Values, few_values
from growthloom.functions.periods import GRAINS
from growthloom.operators.activity import event_detail_activity
from growthloom.operators.core import DIM_USER_COLUMNS, FACT_COLUMNS, dim_user, fact_events
from growthloom.operators.features import FEATURE_ATTRIBUTES, USER_CONSTANTS, features_performance, user_period_features
from growthloom.operators.growth import GROWTH_STATUS_COLUMNS, growth_status, growth_user_features
from growthloom.operators.quality import row_checks
from growthloom.operators.reporting import event_activity_report, growth_report_from_events
from growthloom.operators.retention import cohort_retention
from growthloom.operators.staging import stage_events
from growthloom.plans.dimension import refresh_dim_user
from growthloom.plans.loader import load_fact
from growthloom.plans.panel import refresh_panel
from growthloom.sources.published import Observed, current
from growthloom.sources.sinks import merge_table, read_target, write_table

SUFFIX = {"day": "daily", "week": "weekly", "month": "monthly"}
#: Models that are built at the same time.
AT_ONCE = 4


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    materialized: str  # view | table | fact | merge (by the first cluster column) | panel (from new days and a state)
    build: Callable[["Context"], DataFrame] | None
    tags: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    # Declared column order of a partitioned table (parquet lists partition
    # columns last when the table is read back).
    columns: tuple[str, ...] = ()
    grain: str | None = None
    # Models that are built before, if they are selected too.
    needs: tuple[str, ...] = ()

    def read(self, spark: SparkSession, path: str) -> DataFrame | None:
        df = read_target(spark, path)
        return df.select(*self.columns) if df is not None and self.columns else df

    @property
    def all_tags(self) -> tuple[str, ...]:
        for suffix in SUFFIX.values():
            if self.name.endswith(f"_{suffix}"):
                return (*self.tags, f"refresh_{suffix}")
        return self.tags


@dataclass
class Context:
    spark: SparkSession
    raw: DataFrame
    warehouse: str
    week_start: str = "sunday"
    frames: dict[str, DataFrame] = field(default_factory=dict)
    found: dict[str, Values] = field(default_factory=dict)
    finding: Lock = field(default_factory=Lock)

    def path(self, model: Model) -> str:
        return f"{self.warehouse.rstrip('/')}/{model.layer}/{model.name}"

    def ref(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        model = MODELS_BY_NAME[name]
        if model.materialized == "view":
            df = model.build(self)
        else:
            df = model.read(self.spark, self.path(model))
            if df is None:
                raise ValueError(f"{name} has not been built yet in {self.warehouse}")
        self.frames[name] = df
        return df

    def values(self, name: str = "fct_events") -> Values | None:
        """The values of a model's attributes that have few (see ``codes``), found in one pass and kept for the run."""
        with self.finding:
            if name not in self.found:
                self.found[name] = few_values(self.ref(name), [*FEATURE_ATTRIBUTES, *USER_CONSTANTS])
            return self.found[name]


FACT = ("fct_events",)
FEATURES = tuple(f"int_user_features_{SUFFIX[g]}" for g in GRAINS)
GROWTH_FEATURES = tuple(f"fct_growth_user_features_{SUFFIX[g]}" for g in GRAINS)
COHORTS = ("fct_cohort_retention_monthly", "fct_cohort_retention_weekly")


def _grain_models() -> list[Model]:
    out: list[Model] = []
    for g in GRAINS:
        s = SUFFIX[g]
        out.append(Model(f"int_user_features_{s}", "intermediate", "table",
                         lambda c, g=g: user_period_features(c.ref("fct_events"), g, week_start=c.week_start, values=c.values()), needs=FACT))
    for g in GRAINS:
        s = SUFFIX[g]
        out.append(Model(f"int_user_growth_status_{s}", "intermediate", "panel",
                         lambda c, g=g: growth_status(c.ref("fct_events"), g, c.week_start), grain=g, columns=GROWTH_STATUS_COLUMNS, needs=FACT))
    for g in GRAINS:
        s = SUFFIX[g]
        out.append(Model(f"fct_growth_user_features_{s}", "intermediate", "table",
                         lambda c, g=g: growth_user_features(c.ref("fct_events"), c.ref("dim_user"), g, c.week_start, c.values()), needs=(*FACT, "dim_user")))
    return out


def _union(names: Sequence[str]) -> Callable[[Context], DataFrame]:
    def build(c: Context) -> DataFrame:
        frames = [c.ref(n) for n in names]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return build


DAILY = ("refresh_daily",)

MODELS: list[Model] = [
    Model("stg_event_stream", "staging", "view", lambda c: stage_events(c.raw), DAILY),
    Model("fct_events", "core", "fact", None, DAILY, ("event_date",), ("user_id",), FACT_COLUMNS, needs=("stg_event_stream",)),
    Model("dim_user", "core", "merge", lambda c: dim_user(c.ref("stg_event_stream")), DAILY,
          ("first_seen_date",), ("user_id",), DIM_USER_COLUMNS, needs=("stg_event_stream",)),
    Model("int_event_detail_activity", "intermediate", "table",
          lambda c: event_detail_activity(c.ref("fct_events"), c.week_start), DAILY, needs=FACT),
    *_grain_models(),
    Model("fct_growth_user_features_combined", "marts", "view", _union(GROWTH_FEATURES), DAILY, needs=GROWTH_FEATURES),
    Model("fct_user_features_performance", "marts", "table", lambda c: features_performance(_union(FEATURES)(c)), DAILY, needs=FEATURES),
    # Equal to the report over the combined features, computed from the
    # active rows: the dense panel tables are not read again.
    Model("rpt_growth_reporting", "marts", "table",
          lambda c: growth_report_from_events(c.ref("fct_events"), c.ref("dim_user"), GRAINS, c.week_start, c.values()), DAILY, needs=(*FACT, "dim_user")),
    Model("fct_cohort_retention_weekly", "marts", "table",
          lambda c: cohort_retention(c.ref("fct_events"), "week", week_start=c.week_start, values=c.values()), needs=FACT),
    Model("fct_cohort_retention_monthly", "marts", "table",
          lambda c: cohort_retention(c.ref("fct_events"), "month", week_start=c.week_start, values=c.values()), needs=FACT),
    Model("fct_cohort_retention_combined", "marts", "view", _union(COHORTS), DAILY, needs=COHORTS),
    Model("rpt_event_activity", "marts", "table",
          lambda c: event_activity_report(c.ref("int_event_detail_activity"), values=c.values("int_event_detail_activity")), DAILY, needs=("int_event_detail_activity",)),
]
MODELS_BY_NAME = {m.name: m for m in MODELS}


@contextmanager
def _observed(model: Model, results: list | None) -> Iterator[Observed | None]:
    """What the write of ``model`` is to measure, put into ``results`` afterwards."""
    checks = row_checks(model.name) if results is not None else {}
    observed = Observed([failing for _, failing in checks.values()])
    yield observed if checks else None
    if results is not None:
        results += [(c.table, c.column, c.kind, observed.values[name]) for name, (c, _) in checks.items()]


def _build_all(spark: SparkSession, models: Sequence[Model], build: Callable[[Model], None], at_once: int) -> None:
    """``build`` of each model as soon as those it needs are built, ``at_once`` of them together, the first of the
    list first. After an error no model is begun; those at work are waited for."""
    names, left, done, running = {m.name for m in models}, list(models), set(), {}
    with ThreadPoolExecutor(at_once) as pool:
        while left or running:
            ready = [m for m in left if names.intersection(m.needs) <= done]
            for model in ready[: at_once - len(running)]:
                left.remove(model)
                running[pool.submit(inheritable_thread_target(spark)(build), model)] = model
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                future.result()
                done.add(running.pop(future).name)


def _as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def refresh(
    spark: SparkSession,
    raw: DataFrame,
    warehouse: str,
    tag: str | None = None,
    fact_mode: str = "incremental",
    backfill_start_date: str | dt.date | None = None,
    week_start: str = "sunday",
    models: Sequence[str] | None = None,
    dimension: str = "all",
    check_results: list[tuple[str, str, str, int]] | None = None,
    at_once: int = AT_ONCE,
) -> list[str]:
    """Build the models carrying ``tag`` (all models if None), or those named
    in ``models``, each after those it reads, up to ``at_once`` at the same time.

    The growth panels go on from their states and the fact's new days (see
    ``panel``). ``dimension`` says what the user dimension reads: ``all`` staged
    events, or the new ``days`` alone (see ``dimension``).

    A list given as ``check_results`` takes (table, column, check, failing rows)
    of every declared check of the merged and rebuilt tables that needs a
    table's rows alone: the write measures them, nothing is read again.

    The rebuilt marts are full rewrites and the user dimension is merged by
    user (users gone from the source stay), so running a refresh twice leaves
    the same tables as running it once. Returns the names built, in the models' order.
    """
    if dimension not in ("all", "days"):
        raise ValueError(f"Unknown dimension mode: {dimension}")
    ctx = Context(spark, raw, warehouse, week_start)
    selected = [m for m in MODELS if (tag is None or tag in m.all_tags) and (models is None or m.name in models)]
    results: dict[str, list | None] = {m.name: None if check_results is None else [] for m in selected}

    def build(model: Model) -> None:
        if model.materialized == "view":
            df = model.build(ctx)
            ctx.frames[model.name] = df
            df.createOrReplaceTempView(model.name)
            return
        if model.materialized == "fact":
            load_fact(spark, ctx.ref("stg_event_stream"), ctx.path(model), fact_mode, backfill_start_date)
        elif model.materialized == "panel":
            fact = current(spark, ctx.path(MODELS_BY_NAME["fct_events"]))
            refresh_panel(spark, ctx.ref("fct_events"), ctx.path(model), ctx.path(model) + "__state", model.grain, week_start, fact and fact.folders)
        elif model.materialized == "merge" and dimension == "days":
            since = None if backfill_start_date is None else _as_date(backfill_start_date)
            since = dt.date.min if fact_mode == "full" else since
            refresh_dim_user(spark, ctx.ref("stg_event_stream"), ctx.path(model), ctx.path(model) + "__days", since)
        elif model.materialized == "merge":
            with _observed(model, results[model.name]) as observed:
                merge_table(spark, model.build(ctx), ctx.path(model), model.cluster_by[:1], model.partition_by, model.cluster_by, observed)
        else:
            with _observed(model, results[model.name]) as observed:
                write_table(model.build(ctx), ctx.path(model), model.partition_by, model.cluster_by, observed=observed)
        ctx.frames[model.name] = model.read(spark, ctx.path(model))

    _build_all(spark, selected, build, at_once)
    if check_results is not None:
        check_results += [r for m in selected for r in results[m.name]]
    return [m.name for m in selected]


class _LazyContext(Context):
    """Context whose models are DataFrames built on demand, never written."""

    backfill_start_date: str | dt.date | None = None

    def values(self, name: str = "fct_events") -> Values | None:
        return None  # nothing is run before it is asked for

    def ref(self, name: str) -> DataFrame:
        if name not in self.frames:
            model = MODELS_BY_NAME[name]
            if model.materialized == "fact":
                df = fact_events(self.ref("stg_event_stream"), self.backfill_start_date)
            else:
                df = model.build(self)
            self.frames[name] = df
        return self.frames[name]


def lazy_models(
    spark: SparkSession,
    raw: DataFrame,
    backfill_start_date: str | dt.date | None = None,
    week_start: str = "sunday",
) -> dict[str, DataFrame]:
    """Every model as a lazy DataFrame over ``raw``, nothing written (the
    fact is the full load on or after ``backfill_start_date``)."""
    ctx = _LazyContext(spark, raw, "", week_start)
    ctx.backfill_start_date = backfill_start_date
    return {m.name: ctx.ref(m.name) for m in MODELS}

