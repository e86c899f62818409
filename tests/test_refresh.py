from __future__ import annotations

import tempfile
import threading

import pytest

from growthloom.plans import refresh as plans
from growthloom.plans.catalog import queries
from growthloom.plans.refresh import MODELS, refresh
from growthloom.sources.adapters import raw_events
from growthloom.sources.sinks import read_target
from tests.conftest import SF_SMALL


def _same(a, b) -> bool:
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_full_build_then_daily_refresh(spark):
    wh = tempfile.mkdtemp(prefix="wh-")
    raw = raw_events(spark, SF_SMALL, "events")
    built = refresh(spark, raw, wh)
    assert built == [m.name for m in MODELS]
    report = read_target(spark, f"{wh}/marts/rpt_growth_reporting")
    assert _same(report, queries()["growth_report"](spark, SF_SMALL))
    first = report.cache()
    first.count()
    daily = refresh(spark, raw, wh, tag="refresh_daily")
    assert "fct_cohort_retention_weekly" not in daily and "int_user_growth_status_weekly" not in daily
    assert "fct_events" in daily and "rpt_event_activity" in daily
    # weekly cohorts are read back from the warehouse by the combined view
    combined = spark.table("fct_cohort_retention_combined")
    assert combined.filter("period_grain = 'week'").count() > 0
    assert _same(read_target(spark, f"{wh}/marts/rpt_growth_reporting"), first)
    weekly = refresh(spark, raw, wh, tag="refresh_weekly")
    assert weekly == [
        "int_user_features_weekly", "int_user_growth_status_weekly",
        "fct_growth_user_features_weekly", "fct_cohort_retention_weekly",
    ]
    assert _same(
        read_target(spark, f"{wh}/marts/fct_cohort_retention_weekly"),
        queries()["cohort_week_events"](spark, SF_SMALL),
    )


def test_the_registered_query_runs_whole_groups_by_tag(spark, monkeypatch):
    from growthloom.plans import catalog

    runs = []
    monkeypatch.setattr(catalog, "refresh", lambda s, raw, wh, **k: runs.append((k, refresh(s, raw, wh, **k))))
    queries()["refresh_weekly"](spark, SF_SMALL)
    assert [k for k, _ in runs] == [{}, {"tag": "refresh_daily"}, {"tag": "refresh_weekly"}]
    for k, built in runs:
        assert built == [m.name for m in MODELS if not k or k["tag"] in m.all_tags]


def test_tags_from_names():
    tags = {m.name: m.all_tags for m in MODELS}
    assert tags["int_user_growth_status_weekly"] == ("refresh_weekly",)
    assert tags["fct_cohort_retention_monthly"] == ("refresh_monthly",)
    assert tags["rpt_growth_reporting"] == ("refresh_daily",)


def test_command_line_build_and_test(spark, capsys):
    from growthloom.__main__ import main

    base = tempfile.mkdtemp(prefix="cli-")
    raw_events(spark, SF_SMALL, "events").write.parquet(f"{base}/raw")
    assert main(["build", "--raw", f"{base}/raw", "--warehouse", f"{base}/wh"], spark) == 0
    assert "rpt_growth_reporting" in capsys.readouterr().out
    # The events table has an "error" event type outside the accepted list.
    assert main(["test", "--warehouse", f"{base}/wh"], spark) == 1
    out = capsys.readouterr().out
    assert "108 checks" in out and "FAIL fct_events.event_type accepted_values" in out


def test_lazy_models_equal_registered_queries(spark):
    from growthloom.plans.refresh import lazy_models

    frames = lazy_models(spark, raw_events(spark, SF_SMALL, "events"))
    assert set(frames) == {m.name for m in MODELS}
    assert _same(frames["rpt_growth_reporting"], queries()["growth_report"](spark, SF_SMALL))
    assert _same(frames["rpt_event_activity"], queries()["event_activity"](spark, SF_SMALL))
    assert _same(frames["int_user_growth_status_daily"], queries()["growth_status_day"](spark, SF_SMALL))


def test_built_tables_keep_their_column_order(spark):
    from growthloom.operators.core import DIM_USER_COLUMNS, FACT_COLUMNS
    from growthloom.plans.refresh import Context

    wh = tempfile.mkdtemp(prefix="wh-")
    raw = raw_events(spark, SF_SMALL, "events")
    refresh(spark, raw, wh)
    # Plain parquet reads list the partition column last; tables and models are
    # read back in their declared order.
    assert tuple(read_target(spark, f"{wh}/core/dim_user").columns) == DIM_USER_COLUMNS
    ctx = Context(spark, raw, wh)
    assert tuple(ctx.ref("dim_user").columns) == DIM_USER_COLUMNS
    assert tuple(ctx.ref("fct_events").columns) == FACT_COLUMNS


def test_command_line_backfill(spark, capsys):
    import datetime as dt

    from pyspark.sql import functions as F

    from growthloom.__main__ import main

    base = tempfile.mkdtemp(prefix="cli-bf-")
    raw = raw_events(spark, SF_SMALL, "events")
    raw.filter(F.dayofmonth("event_time") != 25).write.parquet(f"{base}/raw_v1")
    raw.write.parquet(f"{base}/raw_v2")
    # A full build first: the daily group reads the weekly/monthly tables.
    assert main(["build", "--raw", f"{base}/raw_v1", "--warehouse", f"{base}/wh"], spark) == 0
    before = read_target(spark, f"{base}/wh/core/fct_events").count()
    args = ["build", "--raw", f"{base}/raw_v2", "--warehouse", f"{base}/wh", "--tag", "refresh_daily",
            "--fact-mode", "backfill", "--backfill-start-date", "2024-01-20"]
    assert main(args, spark) == 0
    fct = read_target(spark, f"{base}/wh/core/fct_events")
    assert fct.filter(F.col("event_date") == dt.date(2024, 1, 25)).count() > 0
    assert fct.count() == raw.count() > before


def _models(**needs) -> list:
    return [plans.Model(name, "core", "table", None, needs=tuple(n)) for name, n in needs.items()]


def test_models_that_do_not_need_each_other_are_built_at_the_same_time(spark):
    both, order = threading.Barrier(2, timeout=30), []

    def build(model) -> None:
        if model.name in ("b", "c"):
            both.wait()
        order.append(model.name)

    plans._build_all(spark, _models(d="bc", a="", b="a", c="a", e=("not selected",)), build, 2)
    assert sorted(order) == list("abcde") and order.index("a") < min(order.index("b"), order.index("c")) and order.index("d") > max(order.index("b"), order.index("c"))


def test_after_an_error_no_model_is_begun(spark):
    begun, failed = [], threading.Event()

    def build(model) -> None:
        begun.append(model.name)
        if model.name == "a":
            failed.set()
            raise ValueError("a")
        failed.wait(30)

    with pytest.raises(ValueError, match="a"):
        plans._build_all(spark, _models(a="", b="", c="a"), build, 2)
    assert sorted(begun) == ["a", "b"]


def test_every_model_names_the_models_it_reads(spark):
    """A model reads itself, through views too, only from those it needs; these stand before it."""
    ctx = plans._LazyContext(spark, raw_events(spark, SF_SMALL, "events"), "")
    names = [m.name for m in MODELS]
    views = {m.name: m.needs for m in MODELS if m.materialized == "view"}

    class Recorded(plans._LazyContext):
        def ref(self, name):
            read.add(name)
            return ctx.ref(name)

        def values(self, name="fct_events"):
            read.add(name)
            return None

    for m in MODELS:
        assert all(names.index(n) < names.index(m.name) for n in m.needs)
        if m.build is not None:
            read: set[str] = set()
            m.build(Recorded(spark, ctx.raw, ""))
            assert {t for n in read for t in (n, *views.get(n, ()))} <= set(m.needs) | {"stg_event_stream"}, m.name


def test_tables_built_at_once_equal_those_built_one_by_one(spark):
    raw = raw_events(spark, SF_SMALL, "events")
    one, many = tempfile.mkdtemp(prefix="wh-"), tempfile.mkdtemp(prefix="wh-")
    checks: tuple[list, list] = ([], [])
    for wh, at_once, found in ((one, 1, checks[0]), (many, 6, checks[1])):
        assert refresh(spark, raw, wh, check_results=found, at_once=at_once) == [m.name for m in MODELS]
        refresh(spark, raw, wh, tag="refresh_daily", at_once=at_once)
    assert checks[0] == checks[1] and checks[0]
    for m in MODELS:
        if m.materialized != "view":
            assert _same(*[read_target(spark, f"{wh}/{m.layer}/{m.name}") for wh in (one, many)]), m.name
