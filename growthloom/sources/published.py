"""Published tables: versions of a parquet table, switched by a manifest.

A write never touches what readers see. Its files go into a new folder
``__write=<id>`` of the table; then a manifest, ``_manifest-<version>.json``,
names for every partition the write that holds it, and is renamed into place
last. The table is what the highest manifest names, so a write that fails, or
whose driver is lost, at any point before the rename leaves the table as it
was, and running it again finishes it; a replaced partition, a deleted one and
a whole rewrite are one switch each. Two writers that start from one version
can't both publish: the second one fails.

The version before the current one is kept for readers that began with it;
what only older versions had is deleted by the next write. What interrupted
writes have left is never read; ``recover`` deletes it.

A folder of plain parquet files without a manifest is read as it is and becomes
a published table by its first write (its files then count for nothing).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

WRITE = "__write"
_PREFIX, _SUFFIX = "_manifest-", ".json"


class ConcurrentWrite(RuntimeError):
    """Another writer has published a version meanwhile; nothing was changed."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


@dataclass(frozen=True)
class Manifest:
    """A version: ``folders`` maps a partition's folder ("" without partitions)
    to its write; ``note`` is what the writer has to say about it."""

    version: int
    schema: StructType
    partition_by: tuple[str, ...]
    folders: dict[str, str] = field(default_factory=dict)
    note: dict | None = None

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "schema": json.loads(self.schema.json()), "partition_by": self.partition_by, "folders": self.folders, "note": self.note})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["version"], StructType.fromJson(raw["schema"]), tuple(raw["partition_by"]), raw["folders"], raw.get("note"))

    def places(self) -> set[tuple[str, str]]:
        return {(write, folder) for folder, write in self.folders.items()}


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _load(spark: SparkSession, path: str, version: int) -> Manifest | None:
    fs, file = file_system(spark, f"{path}/{_PREFIX}{version:010d}{_SUFFIX}")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return Manifest.from_json(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The table's manifest, or None for a path that was never published to."""
    versions = [int(n[len(_PREFIX) : -len(_SUFFIX)]) for n in _names(spark, path) if n.startswith(_PREFIX) and n.endswith(_SUFFIX)]
    return _load(spark, path, max(versions)) if versions else None


def plain_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A folder of plain parquet files, without what unpublished writes have
    left beside them. Only a missing path or a folder without files means None;
    any other failure to read is raised as AnalysisException."""
    names = _names(spark, path)
    own = [n for n in names if not n.startswith(f"{WRITE}=") and (n[0] not in "_." or "=" in n)]
    if names and not own:
        return None
    try:
        if len(own) == len(names):
            df = spark.read.parquet(path)
        else:
            df = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in own])
        df.schema
        return df
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    except Py4JJavaError as error:
        # A footer that can't be read fails in a task, as a Java error.
        raise AnalysisException(f"{path} can't be read as a table: {error.java_exception.getMessage()}") from error


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's current version in its declared column order; None if there is no table."""
    manifest = current(spark, path)
    return plain_table(spark, path) if manifest is None else read_version(spark, path, manifest)


def read_version(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    if not manifest.folders:
        return spark.createDataFrame([], manifest.schema)
    places = [f"{path}/{WRITE}={write}" + (f"/{folder}" if folder else "") for folder, write in sorted(manifest.folders.items())]
    schema = StructType([*manifest.schema.fields, StructField(WRITE, StringType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*places).select(*[f"`{c}`" for c in manifest.schema.names])


def _partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``a=1/b=2`` below a write, ``depth`` levels deep; [""] for none."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}" if f else n for f in found for n in _names(spark, f"{path}/{f}" if f else path) if "=" in n]
    return found


class Observed:
    """Aggregates (named columns) of the rows that a write takes, measured by the write itself."""

    def __init__(self, columns: Sequence[Column]):
        self.columns = list(columns)
        self.values: dict = {}


def write_files(df: DataFrame, path: str, partition_by: Sequence[str], observed: Observed | None = None) -> dict[str, str]:
    """Write ``df`` to a new folder of the table: {partition folder: write}. A failure leaves nothing behind."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/{WRITE}={write}"
    watch = Observation(f"write-{write}") if observed is not None and observed.columns else None
    if watch is not None:
        df = df.observe(watch, *observed.columns)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(folder)
    except BaseException:
        _delete(spark, folder)
        raise
    if watch is not None:
        observed.values = watch.get
    return {f: write for f in _partition_folders(spark, folder, len(partition_by))}


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make ``manifest`` the current version; then delete what only versions
    before the last one had."""
    name = f"{_PREFIX}{manifest.version:010d}{_SUFFIX}"
    fs, final = file_system(spark, f"{path}/{name}")
    _, draft = file_system(spark, f"{path}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(manifest.to_json().encode())
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentWrite(f"version {manifest.version} of {path} is there already")
    last, old = (_load(spark, path, manifest.version - n) for n in (1, 2))
    if old is not None:
        kept = manifest.places() | (last.places() if last else set())
        for write, folder in old.places() - kept:
            _delete(spark, f"{path}/{WRITE}={write}" + (f"/{folder}" if folder else ""))
        _delete(spark, f"{path}/{_PREFIX}{old.version:010d}{_SUFFIX}")


def publish_change(
    spark: SparkSession,
    path: str,
    base: Manifest | None,
    fresh: DataFrame,
    partition_by: Sequence[str],
    keep: Callable[[str], bool],
    note: dict | None = None,
    observed: Observed | None = None,
) -> None:
    """One new version: the partitions in ``fresh``, and those of ``base`` whose
    folder ``keep`` accepts and ``fresh`` doesn't have."""
    written = write_files(fresh, path, partition_by, observed)
    kept = {f: w for f, w in (base.folders if base else {}).items() if keep(f) and f not in written}
    try:
        publish(spark, path, Manifest(base.version + 1 if base else 1, fresh.schema, tuple(partition_by), kept | written, note))
    except ConcurrentWrite:
        for write in set(written.values()):
            _delete(spark, f"{path}/{WRITE}={write}")
        raise


def recover(spark: SparkSession, path: str) -> list[str]:
    """Delete what interrupted writes have left (no writer may be at work); the folders deleted."""
    names = _names(spark, path)
    versions = [_load(spark, path, int(n[len(_PREFIX) : -len(_SUFFIX)])) for n in names if n.startswith(_PREFIX) and n.endswith(_SUFFIX)]
    used = {f"{WRITE}={write}" for v in versions for write in v.folders.values()}
    left = [n for n in names if (n.startswith(f"{WRITE}=") and n not in used) or n.startswith("_draft-")]
    for name in left:
        _delete(spark, f"{path}/{name}")
    return left
