"""The growth panel and the user dimension from new days and a stored state."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from growthloom.operators.core import DIM_USER_COLUMNS, dim_user, dim_user_from_days, fact_events, user_days
from growthloom.operators.growth import growth_status, sequenced_activity, spans, status_rows
from growthloom.plans import panel as panel_module
from growthloom.plans.catalog import staged
from growthloom.plans.dimension import days_to_read, refresh_dim_user
from growthloom.plans.loader import load_fact
from growthloom.plans.panel import closed_state, panel_from, refresh_panel
from growthloom.sources import published
from growthloom.sources.sinks import read_target
from tests.conftest import SF_SMALL


def _same(a, b) -> bool:
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def stg(spark):
    return staged(spark, SF_SMALL, "events")


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_panel_by_increments_equals_the_full_one(spark, stg, grain):
    base = tempfile.mkdtemp(prefix="panel-")
    fact, went_on = f"{base}/fct", []
    for day in (9, 15, 16, 31, 31):
        load_fact(spark, stg.where(F.col("event_date") <= dt.date(2024, 1, day)), fact, "incremental")
        fct = read_target(spark, fact)
        went_on.append(refresh_panel(spark, fct, f"{base}/panel", f"{base}/state", grain, source=published.current(spark, fact).folders))
        assert _same(read_target(spark, f"{base}/panel"), growth_status(fct, grain))
    assert went_on == [False, True, True, True, True]
    # A backfill changes days before the open period: all days are read again.
    load_fact(spark, stg.where(F.col("event_date") != dt.date(2024, 1, 4)), fact, "backfill", "2024-01-02")
    fct = read_target(spark, fact)
    again = refresh_panel(spark, fct, f"{base}/panel", f"{base}/state", grain, source=published.current(spark, fact).folders)
    assert again == (grain == "month") and _same(read_target(spark, f"{base}/panel"), growth_status(fct, grain))


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_panel_rows_are_made_after_what_is_moved(spark, stg, grain):
    """Spans of a few periods are shuffled, the rows are made of them by the tasks that write them."""
    fct = fact_events(stg).where((F.col("user_id") % 3 != 0) | (F.dayofmonth("event_date") % 11 == 2))
    # Days before 1970 too: their periods have numbers below zero.
    fct = fct.unionByName(fct.where("user_id < 20").withColumn("event_date", F.date_sub("event_date", 19_760)))
    act = sequenced_activity(fct, (grain,), "sunday", False).localCheckpoint()
    laid = panel_module.laid_out_panel(act, "sunday")
    assert _same(laid, growth_status(fct, grain))
    since = act.agg(F.max("_last")).first()[0] - 3
    assert _same(panel_module.laid_out_panel(act, "sunday", since), status_rows(act, "sunday", since))
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    moved = plan.index("RepartitionByExpression")
    assert plan.index("explode(sequence(_begin") < moved < plan.index("explode(", moved)
    assert spans(act, panel_module.STRETCH).count() < 0.6 * laid.count() or grain == "month"


def test_panel_files_are_ordered_by_user(spark, stg):
    base = tempfile.mkdtemp(prefix="panel-")
    refresh_panel(spark, fact_events(stg), f"{base}/panel", f"{base}/state", "day")
    rows = read_target(spark, f"{base}/panel").select("user_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    users: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r.i):
        users.setdefault(r.f, []).append(r.user_id)
    assert len(users) > 5 and all(u == sorted(u) for u in users.values())


def test_panel_after_a_run_lost_between_panel_and_state(spark, stg, monkeypatch):
    base = tempfile.mkdtemp(prefix="panel-")
    fct = fact_events(stg)
    refresh_panel(spark, fct.where("event_date <= '2024-01-12'"), f"{base}/panel", f"{base}/state", "day")
    with monkeypatch.context() as m:
        m.setattr(panel_module, "_store", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            refresh_panel(spark, fct.where("event_date <= '2024-01-20'"), f"{base}/panel", f"{base}/state", "day")
    assert refresh_panel(spark, fct.where("event_date <= '2024-01-22'"), f"{base}/panel", f"{base}/state", "day")
    assert _same(read_target(spark, f"{base}/panel"), growth_status(fct.where("event_date <= '2024-01-22'"), "day"))


def test_panel_of_another_week_start_and_of_nothing(spark, stg):
    base = tempfile.mkdtemp(prefix="panel-")
    fct = fact_events(stg)
    assert not refresh_panel(spark, fct.limit(0), f"{base}/panel", f"{base}/state", "week")
    assert read_target(spark, f"{base}/panel").count() == 0
    assert not refresh_panel(spark, fct, f"{base}/panel", f"{base}/state", "week")
    assert not refresh_panel(spark, fct, f"{base}/panel", f"{base}/state", "week", "monday")
    assert _same(read_target(spark, f"{base}/panel"), growth_status(fct, "week", "monday"))


def test_an_increment_reads_the_open_period_of_the_fact(spark, stg):
    base = tempfile.mkdtemp(prefix="panel-")
    load_fact(spark, stg, f"{base}/fct", "full")
    fct = read_target(spark, f"{base}/fct")
    state = spark.createDataFrame([], "user_id long, engagement_type string, first_pidx int, last_pidx int")
    active = panel_module.active_types(fct.where(F.col("event_date") >= F.lit(dt.date(2024, 1, 28))), "week")
    plan = panel_from(active, state, "week", 2821, 2821)._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert filters and all("2024-01-28" in f for f in filters)
    assert closed_state(active, state, 0).count() == 0


def test_dimension_from_days(spark, stg):
    odd = stg.withColumn("event_ts", F.when(F.minute("event_ts") != 13, F.col("event_ts"))).withColumn("event_date", F.to_date("event_ts"))
    odd = odd.withColumn("country", F.when(F.second("event_ts") % 3 == 0, F.col("country")))
    assert _same(dim_user_from_days(user_days(odd)), dim_user(odd))
    base = tempfile.mkdtemp(prefix="dim-")
    for day in (5, 20, 31, 31):
        refresh_dim_user(spark, odd.where(F.col("event_date").isNull() | (F.col("event_date") <= dt.date(2024, 1, day))), f"{base}/dim", f"{base}/days")
    assert _same(read_target(spark, f"{base}/dim").select(*DIM_USER_COLUMNS), dim_user(odd))
    # Events of an earlier day are read again if asked for; users gone from the source stay.
    fewer = odd.where((F.col("event_date") != dt.date(2024, 1, 10)) & (F.col("user_id") != 1))
    refresh_dim_user(spark, fewer, f"{base}/dim", f"{base}/days", since=dt.date(2024, 1, 10))
    users = {r.user_id: r for r in read_target(spark, f"{base}/dim").collect()}
    want = {r.user_id: r for r in dim_user(odd).collect()}
    assert set(users) == set(want) and sum(r.lifetime_events for r in users.values()) < sum(r.lifetime_events for r in want.values())


def test_new_days_reach_the_raw_scan(spark, stg):
    plan = user_days(days_to_read(stg, dt.date(2024, 1, 28)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts,2024-01-28 00:00:00.0),IsNull(ts))]" in plan


def test_slices_count_rows_of_unknown_grains(spark):
    from growthloom.operators.quality import Check, grain_slices, run_checks

    base = spark.createDataFrame([("week", 1), ("week", None), ("month", None), ("fortnight", 1), (None, None)], "period_grain string, v int")
    of = grain_slices(base)
    checks = [Check(t, "period_grain", "accepted_values", (g,)) for t, g in (("w", "week"), ("m", "month"))] + [Check(t, "v", "not_null") for t in ("w", "m", "both")]
    checks += [Check("w", "v", "unique")]
    got = {(r.table_name, r.column_name, r.check_name): r.failing_rows for r in run_checks({"w": of("week"), "m": of("month"), "both": of()}, checks).collect()}
    assert got == {("w", "period_grain", "accepted_values"): 1, ("m", "period_grain", "accepted_values"): 1, ("w", "v", "not_null"): 2, ("m", "v", "not_null"): 2, ("both", "v", "not_null"): 3, ("w", "v", "unique"): 2}


def test_checks_measured_by_the_writes(spark):
    """The refresh's own counts equal those of the check runner over the written tables."""
    from growthloom.operators.quality import run_checks
    from growthloom.plans.refresh import MODELS, refresh
    from growthloom.sources.adapters import raw_events

    raw = raw_events(spark, SF_SMALL, "events")
    raw = raw.withColumn("user_id", F.when(F.minute("event_time") != 7, F.col("user_id")))
    wh, found = tempfile.mkdtemp(prefix="wh-"), []
    refresh(spark, raw, wh, check_results=found)
    tables = {m.name: read_target(spark, f"{wh}/{m.layer}/{m.name}") for m in MODELS if m.materialized in ("table", "merge")}
    want = {(r.table_name, r.column_name, r.check_name): r.failing_rows for r in run_checks(tables).collect() if r.check_name in ("not_null", "accepted_values")}
    assert {(t, c, k): n for t, c, k, n in found} == want
    assert sum(want.values()) > 0 and len(want) > 40
