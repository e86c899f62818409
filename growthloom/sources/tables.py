"""Readers for the input tables (one parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType


def zoned(schema: StructType) -> StructType:
    """``schema`` with its zone-less timestamps as instants (of the session's zone, UTC here).

    Read as instants, they need no cast on the way to ``event_ts``, and both a
    date bound and a null test reach the scan.
    """
    return StructType([StructField(f.name, TimestampType() if isinstance(f.dataType, TimestampNTZType) else f.dataType, f.nullable, f.metadata) for f in schema.fields])


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet``; Spark prunes columns and pushes
    filters into this scan."""
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    schema = zoned(df.schema)
    return df if schema == df.schema else spark.read.schema(schema).parquet(path)


def table_bytes(spark: SparkSession, base_dir: str, name: str) -> int:
    """Size of the files of ``<base_dir>/<name>.parquet``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base_dir.rstrip('/')}/{name}.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
