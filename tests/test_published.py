"""Published tables: a write that breaks at any point leaves the table as it was."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from growthloom.sources import published
from growthloom.sources.sinks import merge_table, read_target, replace_partitions, replace_partitions_from, upsert_partitions, write_table

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
SCHEMA = "k string, v int, d date"


def _rows(spark, values, broken=False):
    """Two keys a day and an undated one; ``broken``: a task fails while it writes."""
    rows = [(f"{k}{i}", values, d) for i, d in enumerate([*DAYS, None]) for k in "ab"]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4, "k")
    if broken:
        df = df.withColumn("v", F.when(F.col("k") == "b1", F.raise_error(F.lit("a task breaks")).cast("int")).otherwise(F.col("v")))
    return df


SINKS = {
    "write": lambda spark, df, path: write_table(df, path),
    "write_partitioned": lambda spark, df, path: write_table(df, path, ["d"], ["k"]),
    "replace": lambda spark, df, path: replace_partitions(df, path, ["d"]),
    "replace_from": lambda spark, df, path: replace_partitions_from(spark, df.where(f"d >= '{DAYS[1]}' or d is null"), path, "d", DAYS[1]),
    "merge": lambda spark, df, path: merge_table(spark, df, path, ["k"]),
    "merge_partitioned": lambda spark, df, path: merge_table(spark, df, path, ["k"], ["d"], ["k"]),
    "upsert": lambda spark, df, path: upsert_partitions(spark, df, path, ["k", "d"], ["d"]),
}


def _first(spark, name):
    path = tempfile.mkdtemp(prefix="pub-") + "/t"
    write_table(_rows(spark, 1), path, () if name in ("write", "merge") else ["d"])
    return path


def _content(spark, path):
    return sorted((r.k, r.v, str(r.d)) for r in read_target(spark, path).collect())


def _wanted(name, before):
    return [(k, 1 if name == "replace_from" and d == str(DAYS[0]) else 2, d) for k, _, d in before]


@pytest.mark.parametrize("name", SINKS)
def test_a_failing_task_leaves_the_table_and_a_rerun_finishes(spark, name):
    path = _first(spark, name)
    before = _content(spark, path)
    with pytest.raises(Exception, match="a task breaks"):
        SINKS[name](spark, _rows(spark, 2, broken=True), path)
    assert _content(spark, path) == before
    SINKS[name](spark, _rows(spark, 2), path)
    assert _content(spark, path) == _wanted(name, before)


@pytest.mark.parametrize("name", SINKS)
def test_a_driver_lost_before_the_switch_leaves_the_table(spark, name, monkeypatch):
    path = _first(spark, name)
    before = _content(spark, path)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(published, "publish", lost)
        with pytest.raises(KeyboardInterrupt):
            SINKS[name](spark, _rows(spark, 2), path)
    assert _content(spark, path) == before
    left = published.recover(spark, path)
    assert len(left) == 1 and left[0].startswith("__write=") and published.recover(spark, path) == []
    SINKS[name](spark, _rows(spark, 2), path)
    assert _content(spark, path) == _wanted(name, before)


def test_a_first_write_that_is_lost_is_no_table(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="pub-") + "/t"
    with monkeypatch.context() as m:
        m.setattr(published, "publish", lambda *_: None)
        write_table(_rows(spark, 1), path, ["d"])
    assert read_target(spark, path) is None
    write_table(_rows(spark, 2), path, ["d"])
    assert {r.v for r in read_target(spark, path).collect()} == {2}


def test_two_writers_from_one_version(spark):
    path = _first(spark, "write")
    base = published.current(spark, path)
    write_table(_rows(spark, 2), path)
    with pytest.raises(published.ConcurrentWrite):
        published.publish_change(spark, path, base, _rows(spark, 3), (), lambda _: False)
    assert {r.v for r in read_target(spark, path).collect()} == {2}
    assert published.recover(spark, path) == []


def test_a_reader_keeps_the_version_it_began_with_and_older_files_go(spark):
    path = _first(spark, "write_partitioned")
    reader = read_target(spark, path)
    upsert_partitions(spark, spark.createDataFrame([("c", 9, DAYS[0])], SCHEMA), path, ["k", "d"], ["d"])
    assert {r.v for r in reader.collect()} == {1}
    assert {r.v for r in read_target(spark, path).collect()} == {1, 9}
    for value in (10, 11):
        upsert_partitions(spark, spark.createDataFrame([("c", value, DAYS[0])], SCHEMA), path, ["k", "d"], ["d"])
    held = [f for f in os.listdir(path) if f.startswith("_manifest") and f.endswith(".json")]
    assert len(held) == 2
    # Each version but the last two has lost the day that was written again.
    day = f"d={DAYS[0]}"
    assert sum(day in os.listdir(f"{path}/{f}") for f in os.listdir(path) if f.startswith("__write=")) == 2


def test_a_plain_table_is_taken_over(spark):
    path = tempfile.mkdtemp(prefix="pub-") + "/t"
    _rows(spark, 1).write.partitionBy("d").parquet(path)
    before = _content(spark, path)
    SINKS["replace_from"](spark, _rows(spark, 2), path)
    assert _content(spark, path) == _wanted("replace_from", before)


def test_empty_tables_keep_their_schema(spark):
    for partitions in ((), ["d"]):
        path = tempfile.mkdtemp(prefix="pub-") + "/t"
        write_table(_rows(spark, 1).limit(0), path, partitions)
        assert read_target(spark, path).columns == ["k", "v", "d"] and read_target(spark, path).count() == 0
        merge_table(spark, _rows(spark, 1), path, ["k"], partitions)
        assert read_target(spark, path).count() == 8
