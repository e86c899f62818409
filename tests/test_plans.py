"""Plan checks for every registered query: no cartesian product, no
nested-loop join, no Python evaluation; the scan prunes columns."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF_SMALL
from tests.plan_audit import audit

# The training-data subpackage has tests of its own.
QUERIES = {n: q for n, q in entry_module.queries().items() if n != "pipeline" and not n.startswith("op")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    assert audit(QUERIES[name](spark, SF_SMALL))["forbidden"] == []


def test_growth_panel_plan_shape(spark):
    df = QUERIES["growth_status_month"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The events scan reads only the columns the panel needs.
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "orders.parquet" in line]
    assert scan and all("o_comment" not in s and "o_clerk" not in s for s in scan)
    # The panel is generated from the active rows, not by a range join.
    assert "explode(sequence(" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_backfill_date_reaches_the_scan(spark):
    from growthloom.operators.core import fact_events
    from growthloom.plans.catalog import staged

    df = fact_events(staged(spark, SF_SMALL, "events"), "2024-01-15").select("user_id", "event_date")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The bound, and the null test that keeps undated events.
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts,2024-01-15 00:00:00.0),IsNull(ts))]" in plan


def test_rows_of_sketches_are_not_broadcast(spark):
    # Their files are small, the user-months read from them grow with the users.
    df = QUERIES["user_features_sketch_month"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "coalesce(u#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_tasks_grow_in_number_with_the_source(spark):
    from growthloom.plans.catalog import staged
    from growthloom.session import ADVISORY, INITIAL, TASK_BYTES, apply_runtime_conf, leave_task_sizes

    staged(spark, SF_SMALL, "orders")
    assert int(spark.conf.get(ADVISORY)) == TASK_BYTES
    found = []
    for gb in (1, 6):
        apply_runtime_conf(spark, gb << 30)
        found.append(int(spark.conf.get(INITIAL)))
    assert found[1] == 6 * found[0] and (1 << 30) / found[0] <= TASK_BYTES
    # A smaller size that the session names stays.
    spark.conf.set(ADVISORY, "1k")
    apply_runtime_conf(spark, 1 << 30)
    assert spark.conf.get(ADVISORY) == "1k"
    leave_task_sizes(spark)
    assert spark.conf.get(INITIAL, None) is None
