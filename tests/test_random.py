"""Seeded random event tables against the oracle: NULL users, NULL
timestamps, NULL attributes, repeated timestamps, long gaps."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import tempfile

import pytest

import __spark_entry__ as entry_module
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

CHECKED = [
    "growth_status_day", "growth_status_week", "growth_status_week_monday", "growth_features_day",
    "growth_report", "growth_report_dense", "user_features_day", "user_features_week",
    "event_activity", "event_detail_activity", "dim_user", "cohort_week_events", "engagement_metrics_day",
    "dq_core",
]


def _events(seed: int, n: int = 400):
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    stamps = [start + dt.timedelta(days=rng.randint(0, 70), seconds=rng.randint(0, 86399)) for _ in range(n // 4)]
    rows = []
    for i in range(n):
        user = rng.choice([None] + list(range(1, 16))) if rng.random() < 0.1 else rng.randint(1, 15)
        ts = rng.choice(stamps) if rng.random() < 0.5 else start + dt.timedelta(days=rng.randint(0, 70), seconds=rng.randint(0, 86399))
        if rng.random() < 0.02:
            ts = None
        props = None if rng.random() < 0.1 else json.dumps({"k": rng.randint(0, 99)})
        rows.append((i, ts, user, rng.choice(["view", "click", "signup", "purchase", "error"]), round(rng.uniform(0, 50), 2), props))
    return rows


@pytest.fixture(scope="module", params=[1, 2, 3])
def random_dir(spark, request):
    d = tempfile.mkdtemp(prefix=f"rand{request.param}-")
    df = spark.createDataFrame(_events(request.param), "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    df.repartition(3).write.parquet(f"{d}/events.parquet")
    for t in ("customer", "nation", "orders"):
        os.symlink(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", CHECKED)
def test_random_tables_match_oracle(spark, random_dir, name):
    r = compare(spark, duck(random_dir), name, entry_module.queries()[name], entry_module.oracle_sql()[name], random_dir)
    assert r["cols_equal"] and r["rows"] == r["oracle_rows"], r
    assert r["exact"], (r.get("only_spark"), r.get("only_duck"))
