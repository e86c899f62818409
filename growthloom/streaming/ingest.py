"""Streaming front end for the event fact.

Raw event files arriving in a folder are read as a stream and staged, and each
micro-batch is upserted into the partitioned fact. The upsert itself tells
known events from new ones, NULLs included, so the stream keeps no state and
needs no watermark: an event that arrives late for the first time is added,
however late, and a replayed file or micro-batch leaves the same table.

Without an ``event_id`` an event is its whole row: rows alike in all columns
count once. With one, a later batch's row stands for an earlier one's.

The growth, retention and report tables stay batch jobs over the fact: they
need row-ordered windows over each user's whole history, which streaming
aggregations do not offer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from growthloom.operators.core import fact_events
from growthloom.operators.staging import stage_events
from growthloom.plans.loader import FACT_CLUSTER, FACT_PARTITION, ID_FACT_KEY
from growthloom.session import shared_folder
from growthloom.sources.sinks import upsert_partitions


def raw_event_stream(spark: SparkSession, source_dir: str, schema: StructType, max_files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of raw events as a stream (explicit schema, no inference)."""
    return (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(source_dir)
    )


def fact_stream(raw: DataFrame) -> DataFrame:
    """Staged fact rows of a raw event stream."""
    return fact_events(stage_events(raw))


def upsert_batch(batch: DataFrame, fact_path: str, key: Sequence[str] | None = None) -> None:
    """Upsert one micro-batch; ``key`` defaults to the event id with its date, else the whole row."""
    key = tuple(key or (ID_FACT_KEY if "event_id" in batch.columns else batch.columns))
    upsert_partitions(batch.sparkSession, batch.dropDuplicates(list(key)), fact_path, key, FACT_PARTITION, FACT_CLUSTER)


def start_fact_ingest(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    fact_path: str,
    key: Sequence[str] | None = None,
    query_name: str = "fact_ingest",
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = "1 minute",
) -> StreamingQuery:
    """Start the ingest stream; its checkpoint lives in the shared checkpoint
    folder of the session unless ``checkpoint_location`` is given."""
    location = checkpoint_location or f"{shared_folder(spark)}/streams/{query_name}"
    stream = fact_stream(raw_event_stream(spark, source_dir, schema))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, fact_path, key)

    writer = stream.writeStream.queryName(query_name).option("checkpointLocation", location).foreachBatch(upsert)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
