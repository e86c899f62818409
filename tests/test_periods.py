from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from growthloom.functions.periods import (
    engagement_bucket,
    period_from_index,
    period_index,
    period_start,
)

D = dt.date


@pytest.fixture(scope="module")
def days(spark):
    start = D(2023, 12, 24)
    return spark.createDataFrame([(start + dt.timedelta(days=i),) for i in range(0, 800, 3)], "d date")


@pytest.mark.parametrize("grain", ["day", "week", "month"])
@pytest.mark.parametrize("week_start", ["sunday", "monday"])
def test_index_round_trip(days, grain, week_start):
    rows = days.select(
        "d",
        period_start("d", grain, week_start).alias("ps"),
        period_from_index(period_index("d", grain, week_start), grain, week_start).alias("back"),
    ).collect()
    for r in rows:
        assert r.ps == r.back
        if grain == "week":
            assert r.ps.weekday() == (6 if week_start == "sunday" else 0)
            assert 0 <= (r.d - r.ps).days < 7
        if grain == "month":
            assert r.ps == r.d.replace(day=1)


def test_sunday_week_edges(spark):
    df = spark.createDataFrame([(D(2025, 3, 29),), (D(2025, 3, 30),), (D(2024, 1, 1),)], "d date")
    got = [r.w for r in df.select(period_start("d", "week").alias("w")).collect()]
    assert got == [D(2025, 3, 23), D(2025, 3, 30), D(2023, 12, 31)]
    got = [r.w for r in df.select(period_start("d", "week", "monday").alias("w")).collect()]
    assert got == [D(2025, 3, 24), D(2025, 3, 24), D(2024, 1, 1)]


def test_consecutive_indexes(spark):
    df = spark.createDataFrame([(D(2024, 12, 31), D(2025, 1, 1))], "a date, b date")
    r = df.select(
        (period_index("b", "month") - period_index("a", "month")).alias("m"),
        (period_index("b", "day") - period_index("a", "day")).alias("d"),
    ).collect()[0]
    assert (r.m, r.d) == (1, 1)


def test_engagement_bucket(spark):
    df = spark.createDataFrame([("like",), ("share",), ("reward_search",), ("miles_earned",), ("miles_redeemed",), ("x",), (None,)], "t string")
    got = [r.b for r in df.select(engagement_bucket("t").alias("b")).collect()]
    assert got == ["pre_engagement"] * 3 + ["transaction"] * 2 + ["other", "other"]


def test_invalid_grain():
    with pytest.raises(ValueError):
        period_start(F.col("d"), "year")
