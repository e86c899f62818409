from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from growthloom.session import RUNTIME_CONF

    scratch = tempfile.mkdtemp(prefix="growthloom-tests-")
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("growthloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", scratch)
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only because none is configured.
    if not (session.sparkContext.getConf().get("spark.checkpoint.dir", None) or session.sparkContext.getCheckpointDir()):
        session.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield session
    session.stop()


# The hand-made frame of FIXTURES.md §3 (traps): a Saturday/Sunday edge, two
# users' events at the same instant, an event type outside the buckets and
# an event without a user.
TRAP_ROWS = [
    ("u1", "2025-03-29 10:00:00", "like", None, None, "ios", "google", "SG", "F"),
    ("u1", "2025-03-30 09:00:00", "miles_earned", "shopping", "100.5", "web", "facebook", "SG", "F"),
    ("u1", "2025-04-01 08:00:00", "miles_redeemed", "flight", "40", "web", None, "SG", "F"),
    ("u2", "2025-03-30 09:00:00", "share", None, None, "android", "google", "ID", "M"),
    ("u2", "2025-04-02 00:00:00", "other_evt", None, None, None, None, "ID", "M"),
    (None, "2025-03-31 12:00:00", "like", None, None, None, None, None, None),
]


@pytest.fixture(scope="session")
def trap_raw(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        TRAP_ROWS,
        "user_id string, event_time string, event_type string, transaction_category string, "
        "miles_amount string, platform string, utm_source string, country string, gender string",
    )
    return df.select(
        F.col("event_time").cast("timestamp").alias("event_time"),
        "user_id", "gender", "event_type", "transaction_category",
        F.col("miles_amount").cast("decimal(38,9)").alias("miles_amount"),
        "platform", "utm_source", "country",
    )


@pytest.fixture(scope="session")
def trap_staged(trap_raw):
    from growthloom.operators.staging import stage_events

    return stage_events(trap_raw)


@pytest.fixture(scope="session")
def trap_fct(trap_staged):
    from growthloom.operators.core import fact_events

    return fact_events(trap_staged)
