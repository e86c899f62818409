"""A user holding a third of all events: AQE splits the hot partition and the
results stay equal to the oracle.

The skewed input is derived by Spark from the events table (every third
event is moved to one user) and written as several files, so the shuffle
has several map outputs to split.
"""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
HOT_USER = 7


@pytest.fixture(scope="module")
def skew_dir(spark):
    d = tempfile.mkdtemp(prefix="skew-")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT_USER).cast("bigint")).otherwise(F.col("user_id"))
    )
    hot.repartition(8).write.parquet(f"{d}/events.parquet")
    for t in ("customer", "nation", "orders", "region", "supplier", "part", "lineitem", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"):
        os.symlink(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    return d


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name",
    ["growth_status_day", "growth_features_day", "growth_report", "event_activity",
     "dim_user", "user_features_day", "cohort_week_events", "engagement_metrics_day"],
)
def test_hot_user_matches_oracle(spark, skew_dir, skew_conf, name):
    share = spark.read.parquet(f"{skew_dir}/events.parquet").agg(F.avg((F.col("user_id") == HOT_USER).cast("double"))).first()[0]
    assert share > 0.33
    r = compare(spark, duck(skew_dir), name, entry_module.queries()[name], entry_module.oracle_sql()[name], skew_dir)
    assert r["cols_equal"] and r["rows"] == r["oracle_rows"] and r["exact"]


def test_hot_partition_is_split(spark, skew_dir, skew_conf):
    df = entry_module.queries()["growth_status_day"](spark, skew_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
