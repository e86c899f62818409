"""Loading the event fact: full, incremental (high-water mark) and backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.operators.core import as_date_column, fact_events
from growthloom.sources.sinks import (
    merge_by_key,
    read_target,
    replace_partitions_from,
    upsert_partitions,
    write_table,
)

# Events are told apart by their id where the source has one (its date is
# added so that a key lies in one partition). Without an id the timestamp
# alone would let two users' events at one instant collide, so user and type
# are added; events that still share a key are kept together, as a group.
DEFAULT_FACT_KEY = ("user_id", "event_ts", "event_type")
ID_FACT_KEY = ("event_id", "event_date")
FACT_PARTITION = ("event_date",)
FACT_CLUSTER = ("user_id",)
_FLOOR = dt.date(1970, 1, 1)


def fact_key(staged: DataFrame) -> tuple[str, ...]:
    """The merge key of a fact loaded from ``staged``."""
    return ID_FACT_KEY if "event_id" in staged.columns else DEFAULT_FACT_KEY


def high_water_mark(target: DataFrame | None) -> F.Column:
    """Latest loaded event date (1970-01-01 for an empty or missing target),
    as a scalar subquery column."""
    if target is None:
        return F.lit(_FLOOR)
    return F.coalesce(target.select(F.max("event_date")).scalar(), F.lit(_FLOOR))


def incremental_batch(
    staged: DataFrame,
    target: DataFrame | None,
    backfill_start_date: str | dt.date | None = None,
) -> DataFrame:
    """Rows an incremental run picks up: on or after ``backfill_start_date``
    and on or after the target's latest date (that day is reloaded, so
    late rows of the last loaded day are caught), and all undated rows."""
    fct = fact_events(staged, backfill_start_date)
    return fct.filter((F.col("event_date") >= high_water_mark(target)) | F.col("event_date").isNull())


def merged_fact(
    staged: DataFrame,
    target: DataFrame | None,
    backfill_start_date: str | dt.date | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """The fact after an incremental run, as a DataFrame (no write)."""
    batch = incremental_batch(staged, target, backfill_start_date)
    return batch if target is None else merge_by_key(target, batch, key or fact_key(staged))


def backfilled_fact(
    staged: DataFrame,
    target: DataFrame,
    backfill_start_date: str | dt.date | F.Column,
) -> DataFrame:
    """The fact after a backfill, as a DataFrame: rows before the date kept,
    everything from the date on, and undated, replaced by the staged events."""
    start = as_date_column(backfill_start_date)
    kept = target.filter(F.col("event_date") < start)
    return kept.unionByName(fact_events(staged, start))


def load_fact(
    spark: SparkSession,
    staged: DataFrame,
    path: str,
    mode: str = "incremental",
    backfill_start_date: str | dt.date | None = None,
    key: Sequence[str] | None = None,
) -> None:
    """Write the event fact at ``path`` (parquet, partitioned by event_date,
    clustered by user_id).

    * ``full``: rebuild from the staged events on/after the backfill date;
    * ``incremental``: upsert rows on/after the latest loaded date (and the
      backfill date) by ``key``, rewriting only those partitions; the first
      run is a full load;
    * ``backfill``: replace every partition on/after ``backfill_start_date``
      with the staged events, whatever was loaded before.

    No mode drops or repeats an event: rows with NULLs in the key, events that
    share a key and undated events (a partition of their own, part of every
    batch) come out alike in all of them.
    """
    if mode == "full":
        write_table(fact_events(staged, backfill_start_date), path, FACT_PARTITION, FACT_CLUSTER)
    elif mode == "incremental":
        target = read_target(spark, path)
        batch = incremental_batch(staged, target, backfill_start_date)
        upsert_partitions(spark, batch, path, key or fact_key(staged), FACT_PARTITION, FACT_CLUSTER)
    elif mode == "backfill":
        if backfill_start_date is None:
            raise ValueError("backfill needs backfill_start_date")
        fresh = fact_events(staged, backfill_start_date)
        if read_target(spark, path) is None:
            write_table(fresh, path, FACT_PARTITION, FACT_CLUSTER)
        else:
            start = backfill_start_date if isinstance(backfill_start_date, dt.date) else dt.date.fromisoformat(backfill_start_date)
            replace_partitions_from(spark, fresh, path, FACT_PARTITION[0], start, FACT_CLUSTER)
    else:
        raise ValueError(f"Unknown load mode: {mode}")
