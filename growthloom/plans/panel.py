"""The growth status panel kept up to date from new days and a small state.

The state has a row per user and engagement type: its first and last active
period among the closed ones, those before ``as_of``. A run reads
the fact from the first day of period ``as_of`` on (its partitions before are
pruned), puts the state in front of what it finds there, and gives every panel
row from ``as_of`` on; older rows can't change. The state then moves on to the
period that is open now.

The panel is published first and the state last, each in one switch. If a run
is lost between the two, the next one starts from the old state and writes the
same rows again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from growthloom.functions.periods import period_from_index, period_index
from growthloom.operators.growth import active_types, sequenced_activity, spans, status_rows
from growthloom.sources.published import current, read_version
from growthloom.sources.sinks import replace_partitions_from, write_table

STATE_KEY = ("user_id", "engagement_type")
PANEL_PARTITION = "period_start"
PANEL_CLUSTER = ("user_id",)
#: Periods whose rows a task makes and writes together.
STRETCH = 8


def closed_state(active: DataFrame, state: DataFrame | None, as_of: int) -> DataFrame:
    """The state of the periods before ``as_of``, from active periods (user,
    type, pidx) and the state before them: first and last merge."""
    pidx = F.col("pidx")
    rows = active.where(pidx < as_of).select(*STATE_KEY, pidx.alias("first_pidx"), pidx.alias("last_pidx"))
    if state is not None:
        rows = rows.unionByName(state.select(*rows.columns))
    return rows.groupBy(*STATE_KEY).agg(F.min("first_pidx").alias("first_pidx"), F.max("last_pidx").alias("last_pidx"))


def sequenced_from(active: DataFrame, state: DataFrame, grain: str, as_of: int, last: int) -> DataFrame:
    """Sequenced active periods from ``as_of`` on and the last one before, from the active
    periods (user, type, pidx) there and the state before."""
    known = state.select(*STATE_KEY, F.col("last_pidx").alias("pidx"), F.col("first_pidx").alias("_first"))
    new = active.where(F.col("pidx") >= as_of).select(*STATE_KEY, "pidx", F.col("pidx").alias("_first"))
    # A user's rows here are bounded by the number of open periods.
    rows = known.unionByName(new).repartition("user_id")
    by_seq = Window.partitionBy(*STATE_KEY).orderBy("pidx")
    return rows.select(
        *STATE_KEY, "pidx", F.lit(grain).alias("period_grain"),
        F.lag("pidx").over(by_seq).alias("_prev"),
        F.lead("pidx").over(by_seq).alias("_next"),
        F.min("_first").over(Window.partitionBy("user_id")).alias("_first_overall"),
        F.lit(last).alias("_last"),
    )


def panel_from(active: DataFrame, state: DataFrame, grain: str, as_of: int, last: int, week_start: str = "sunday") -> DataFrame:
    """Panel rows of the periods from ``as_of`` to ``last``, from the active
    periods (user, type, pidx) there and the state before."""
    return status_rows(sequenced_from(active, state, grain, as_of, last), week_start, as_of)


def laid_out_panel(act: DataFrame, week_start: str, since: int | None = None) -> DataFrame:
    """The panel rows of sequenced active periods, laid out for the writer: a task has a range of users in a
    stretch of STRETCH periods. What is sampled, moved and sorted by user are spans, which stand for several
    rows each; the task that writes the rows makes them, and sorts them by the period alone (one key that is a
    number, so that rows of a period keep their order by user while the sort fits in memory)."""
    cut = spans(act, STRETCH, since).repartitionByRange("_stretch", *PANEL_CLUSTER).sortWithinPartitions(*PANEL_CLUSTER)
    return status_rows(cut, week_start).sortWithinPartitions(PANEL_PARTITION)


def changed_before(seen: dict[str, str] | None, now: dict[str, str] | None, start: dt.date) -> bool:
    """Whether a dated partition before ``start`` was written since: the two
    manifests name another write for it, or only one has it."""
    if seen is None or now is None:
        return seen is not now

    def old(folders: dict[str, str]) -> set[tuple[str, str]]:
        # NULL's folder name is above any date: undated events have no period.
        return {(f, w) for f, w in folders.items() if f.partition("=")[2] < start.isoformat()}

    return old(seen) != old(now)


def refresh_panel(
    spark: SparkSession,
    fct: DataFrame,
    panel_path: str,
    state_path: str,
    grain: str,
    week_start: str = "sunday",
    source: dict[str, str] | None = None,
) -> bool:
    """Bring the panel at ``panel_path`` up to the last day of ``fct``; whether
    it went on from the state.

    ``source`` are the folders of the fact's manifest. The state notes those it
    was made from, so a run that finds a day before the open period written
    again (a backfill) starts from all days, as does a first run. Without it,
    days before the open period are taken to be as they were.
    """
    version = current(spark, state_path)
    note = (version.note if version is not None else None) or {}
    as_of = note.get("as_of")
    last_day: dt.date | None = fct.agg(F.max("event_date")).first()[0]
    days = spark.range(1).select(
        period_index(F.lit(last_day).cast("date"), grain, week_start).alias("last"),
        period_from_index(F.lit(as_of).cast("int"), grain, week_start).alias("start"),
    ).first()
    usable = as_of is not None and days.last is not None and days.last >= as_of and note["week_start"] == week_start
    if not usable or changed_before(note["source"], source, days.start):
        act = sequenced_activity(fct, (grain,), week_start, with_metrics=False)
        write_table(laid_out_panel(act, week_start), panel_path, [PANEL_PARTITION], laid_out=True)
        if days.last is not None:
            _store(closed_state(active_types(fct, grain, week_start), None, days.last), state_path, days.last, week_start, source)
        return False
    stored = read_version(spark, state_path, version)
    active = active_types(fct.where(F.col("event_date") >= F.lit(days.start)), grain, week_start)
    rows = laid_out_panel(sequenced_from(active, stored, grain, as_of, days.last), week_start, as_of)
    replace_partitions_from(spark, rows, panel_path, PANEL_PARTITION, days.start, laid_out=True)
    _store(closed_state(active, stored, days.last), state_path, days.last, week_start, source)
    return True


def _store(state: DataFrame, path: str, as_of: int, week_start: str, source: dict[str, str] | None) -> None:
    write_table(state, path, (), ("user_id",), {"as_of": as_of, "week_start": week_start, "source": source})
