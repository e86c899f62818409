"""Table sinks: full overwrite, partition replacement and keyed upsert on
parquet tables. Every sink publishes a new version in one switch (see
``published``): a write that fails leaves the table as it was."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.session import shared_folder
from growthloom.sources import published
from growthloom.sources.published import current, file_system, publish_change, read_version

#: Spark's folder name for the NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a table. Only a missing path or a folder without
    files means no; any other failure to read is raised as AnalysisException."""
    return read_target(spark, path) is not None


@contextmanager
def staged_copy(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back; the files go at the
    end. Reading it any number of times computes ``df`` once, and a lost
    executor costs a re-read. Never the only copy of a table's rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/growthloom-{label}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, target = file_system(spark, path)
        fs.delete(target, True)


def null_safe(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The current content of a table, or None on the first run."""
    return published.read_table(spark, path)


def _laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows ordered for the writer.

    With partition or cluster columns, rows are range-partitioned on
    (partition columns, cluster columns) and sorted within each task. Each
    task then writes a contiguous key range: a file per table partition it
    touches rather than a file per partition per task. A large date spreads
    over several tasks, and the files are sorted on the cluster columns so
    parquet min/max statistics can skip row groups.
    """
    keys = [*partition_by, *cluster_by]
    if not keys:
        return df
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    note: dict | None = None,
    observed: published.Observed | None = None,
    laid_out: bool = False,
) -> None:
    """Full rebuild: a new version that holds ``df`` alone. See ``_laid_out``
    for the file layout, unless ``df`` is laid out already; ``note`` is kept in the version's manifest. ``observed``
    is measured in the writing stage, after the layout's shuffle (which samples
    the rows first), so each row counts once."""
    spark = df.sparkSession
    rows = df if laid_out else _laid_out(df, partition_by, cluster_by)
    publish_change(spark, path, current(spark, path), rows, partition_by, lambda _: False, note, observed)


def _based(spark: SparkSession, path: str, partition_by: Sequence[str]):
    """The version to change, partitioned alike; None for a new table. A plain
    table becomes a first version before it is changed."""
    base = current(spark, path)
    if base is None and (files := published.plain_table(spark, path)) is not None:
        write_table(files, path, partition_by)
        base = current(spark, path)
    if base is not None and base.partition_by != tuple(partition_by):
        raise ValueError(f"{path} is partitioned by {base.partition_by}, not by {tuple(partition_by)}")
    return base


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> None:
    """A new version in which only the partitions present in ``df`` differ."""
    spark = df.sparkSession
    publish_change(spark, path, _based(spark, path, partition_by), _laid_out(df, partition_by, cluster_by), partition_by, lambda _: True)


def replace_partitions_from(
    spark: SparkSession,
    fresh: DataFrame,
    path: str,
    column: str,
    start: dt.date,
    cluster_by: Sequence[str] = (),
    laid_out: bool = False,
) -> None:
    """Make every partition with ``column >= start`` (dates), and the NULL
    partition, equal to ``fresh``; those that ``fresh`` doesn't have go. One
    switch: readers see all of it or nothing."""

    def before(folder: str) -> bool:
        value = folder.partition("=")[2]
        return value != NULL_PARTITION and value < start.isoformat()

    rows = fresh if laid_out else _laid_out(fresh, [column], cluster_by)
    publish_change(spark, path, _based(spark, path, [column]), rows, [column], before)


def merge_by_key(target: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert as a DataFrame: target rows whose key is not in ``updates``,
    plus all of ``updates``.

    A key stands for the group of rows that carry it: the group in ``updates``
    replaces the one in ``target``, so distinct rows that share a key are all
    kept and a repeated load changes nothing. NULLs in a key match each other.
    Both sides are shuffled on the key; no side is broadcast, so neither size
    is assumed.
    """
    keys = updates.select(*[F.col(k).alias(f"__{k}") for k in key]).distinct()
    kept = target.join(keys, null_safe([F.col(k) for k in key], [F.col(f"__{k}") for k in key]), "left_anti")
    return kept.unionByName(updates)


def merge_table(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    observed: published.Observed | None = None,
) -> None:
    """Keyed upsert into a table whose key does not determine the partition
    (a user's first day may change): the whole table is merged into a new
    version. Rows whose key is not in ``updates`` stay."""
    target = read_target(spark, path)
    merged = updates if target is None else merge_by_key(target.select(*updates.columns), updates, key)
    write_table(merged, path, partition_by, cluster_by, observed=observed)


def upsert_partitions(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> None:
    """Keyed upsert into a partitioned table.

    Only the partitions the updates touch are read and written anew: their
    values (a row per partition, e.g. per day) go to the driver and come back as
    a filter on the partition columns, which prunes the scan. ``key`` must
    determine the partition (e.g. contain ``event_ts`` for a table
    partitioned by ``event_date``), so every match lies in such a partition.
    Updates are staged in the shared folder, to be computed once.
    """
    with staged_copy(updates, "updates") as fresh:
        base = current(spark, path)
        target = read_target(spark, path)
        if target is None or base is None:
            merged = fresh if target is None else merge_by_key(target.select(*fresh.columns), fresh, key)
            write_table(merged, path, partition_by, cluster_by)
            return
        touched = fresh.select(*partition_by).distinct().collect()
        if not touched:
            return
        # The merge reads the very version that the change is based on.
        affected = read_version(spark, path, _based(spark, path, partition_by)).filter(touched_partitions(touched, partition_by))
        merged = merge_by_key(affected.select(*fresh.columns), fresh, key)
        publish_change(spark, path, base, _laid_out(merged, partition_by, cluster_by), partition_by, lambda _: True)


def touched_partitions(rows: Sequence, partition_by: Sequence[str]) -> Column:
    """A filter on the partition columns: the partitions in ``rows``, NULL included."""

    def one(column: str, values: set) -> Column:
        some = F.col(column).isin(*[v for v in values if v is not None]) if values - {None} else F.lit(False)
        return some | F.col(column).isNull() if None in values else some

    # Per column, so that each list prunes by itself; rows are then exact by the merge key.
    return reduce(lambda a, b: a & b, [one(c, {r[i] for r in rows}) for i, c in enumerate(partition_by)])
