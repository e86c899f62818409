"""The streaming ingest gives the same fact as the batch load."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from growthloom.operators.core import fact_events
from growthloom.operators.staging import stage_events
from growthloom.sources.adapters import raw_events
from growthloom.streaming.ingest import start_fact_ingest
from growthloom.sources.sinks import read_target
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    scratch = tempfile.mkdtemp(prefix="stream-")
    src, fact_path = f"{scratch}/raw", f"{scratch}/fct_events"
    raw = raw_events(spark, SF_SMALL, "events").cache()
    # Three arrivals: early days, later days, and a resend of some early rows.
    day = F.dayofmonth("event_time")
    raw.filter(day <= 10).write.mode("append").parquet(src)
    raw.filter(day > 10).write.mode("append").parquet(src)
    raw.filter(day <= 3).write.mode("append").parquet(src)

    q = start_fact_ingest(spark, src, raw.schema, fact_path, query_name="t_ingest",
                          checkpoint_location=f"{scratch}/ckpt", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = read_target(spark, fact_path)
    expected = fact_events(stage_events(raw))
    cols = sorted(expected.columns)
    try:
        assert got.count() == expected.count()
        assert got.select(*cols).exceptAll(expected.select(*cols)).count() == 0
    finally:
        # A cached plan would be substituted into later tests' reads of the
        # same tables and hide their scan-level pushdown.
        raw.unpersist()


def _ingest(spark, scratch, schema, name):
    q = start_fact_ingest(spark, f"{scratch}/raw", schema, f"{scratch}/fct", query_name=name, checkpoint_location=f"{scratch}/ckpt-{name}", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    return read_target(spark, f"{scratch}/fct")


def test_late_first_time_events_and_replays(spark):
    scratch = tempfile.mkdtemp(prefix="stream-")
    raw = raw_events(spark, SF_SMALL, "events")
    raw = raw.withColumn("user_id", F.when(F.minute("event_time") % 11 != 0, F.col("user_id")))
    day = F.dayofmonth("event_time")
    want = raw.filter((day <= 5) | day.between(11, 15)).distinct().count()
    raw.filter(day.between(11, 15)).write.mode("append").parquet(f"{scratch}/raw")
    _ingest(spark, scratch, raw.schema, "late")
    # Never-seen events of days long past.
    raw.filter(day <= 5).write.mode("append").parquet(f"{scratch}/raw")
    assert _ingest(spark, scratch, raw.schema, "late").count() == want
    # A new checkpoint replays every file, NULL users included.
    out = _ingest(spark, scratch, raw.schema, "replay")
    assert out.count() == want
    assert out.filter("user_id is null").count() > 0
