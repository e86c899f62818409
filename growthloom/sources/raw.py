"""Reading a raw event table from files in any built-in Spark format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampType

from growthloom.sources.adapters import RAW_COLUMNS
from growthloom.sources.tables import zoned

# Raw columns and the types the staging casts accept; user_id is kept as the
# input gives it (string here, for text formats).
RAW_SCHEMA = StructType(
    [
        StructField("event_time", TimestampType()),
        StructField("user_id", StringType()),
        StructField("gender", StringType()),
        StructField("event_type", StringType()),
        StructField("transaction_category", StringType()),
        StructField("miles_amount", DecimalType(38, 9)),
        StructField("platform", StringType()),
        StructField("utm_source", StringType()),
        StructField("country", StringType()),
    ]
)

_SELF_DESCRIBING = ("parquet", "orc", "avro", "delta", "iceberg")


def read_raw_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw events at ``path``. Text formats (csv, json) are read with an
    explicit schema (``RAW_SCHEMA`` by default), never inferred; columnar
    formats use the file schema unless one is given. Missing required
    columns raise before any job runs."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt not in _SELF_DESCRIBING:
        reader = reader.schema(RAW_SCHEMA)
    df = reader.load(path)
    if schema is None and fmt == "parquet" and zoned(df.schema) != df.schema:
        df = reader.schema(zoned(df.schema)).load(path)  # instants, see ``zoned``
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"raw events at {path} lack columns: {missing}")
    return df.select(*RAW_COLUMNS)
