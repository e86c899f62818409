"""Session settings the transforms rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs: calendar dates are taken in UTC, as the
# warehouse semantics require; AQE re-plans joins and splits skewed
# partitions at run time. The user lookup joins shuffle events by user_id
# and the aggregates above them reuse that partitioning, so AQE would not
# split a hot user's partition without ``forceOptimizeSkewedJoin`` (it then
# adds a shuffle above the split join, after the map-side partial
# aggregate). Partition overwrite mode is set per write (static for full
# rebuilds, dynamic for partition replacement), never session-wide.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# A task reads this much of a shuffle. Events are small there (a compressed MB
# holds a hundred thousand) and multiply inside the task: by grains, engagement
# types, idle periods and sets, into sorts and hash tables of a hundred times
# their size and more. So what a task holds is bounded by what it reads.
TASK_BYTES = 2 << 20
# MB shuffled of a MB of the source's files (compressed columns), for the number
# of shuffle partitions that are merged up to TASK_BYTES.
SHUFFLED = 6

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _size(text: str) -> int:
    """Bytes of a Spark size, like ``64MB`` or ``1k``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def apply_runtime_conf(spark: SparkSession, source_bytes: int = 0) -> SparkSession:
    """Set the session-level SQL settings above on an existing session.

    ``source_bytes``, the size of the source's files, makes the number of tasks
    after a shuffle grow with the input, so that one task's share does not. A
    smaller advisory size that the session names stays."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if _size(spark.conf.get(ADVISORY)) > TASK_BYTES:
        spark.conf.set(ADVISORY, str(TASK_BYTES))
    wanted = -(-source_bytes * SHUFFLED // TASK_BYTES)
    # Few for a small input: every one costs each task before it a file.
    spark.conf.set(INITIAL, str(max(wanted, 2 * spark.sparkContext.defaultParallelism)))
    return spark


def build_session(
    master: str = "local[*]",
    app_name: str = "growthloom",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def leave_task_sizes(spark: SparkSession) -> SparkSession:
    """Task sizes as the session started with them: for runs of many writes, where smaller tasks mean more files."""
    for key in (ADVISORY, INITIAL):
        spark.conf.unset(key)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Jobs cut lineage and stage writes there; it must be on shared storage so a
    lost executor does not lose the data. In local mode, where driver and
    executors are one process, a new temporary folder serves if it is unset.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set on this session")
    path = "file://" + tempfile.mkdtemp(prefix="growthloom-")
    sc.setCheckpointDir(path)
    return path
