"""Continuous loading of raw weather into the first-generation daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from pampero.operators.incremental import upsert
from pampero.plans import legacy, staging
from pampero.sources.schemas import RAW_WEATHER

CLUSTER_BY = ["location_id"]
VERSION = ["_sdc_extracted_at", "_sdc_sequence"]


def read_raw_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw weather snapshots as they arrive in a folder of Parquet files."""
    return (
        spark.readStream.schema(RAW_WEATHER)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def load_batch(raw: DataFrame, table: str) -> None:
    """Merge one batch of raw snapshots into the daily table; the newest extract of a day wins."""
    daily = legacy.daily(staging.flattened_weather(raw))
    upsert(daily, table, legacy.KEY, CLUSTER_BY, version=VERSION)


def daily_upsert(stream: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """Writer that merges each micro-batch; the stream's own progress is the high-water mark.

    A batch interrupted half-way is replayed by Spark, and merging it again changes nothing.
    The state is the table itself: only months touched by a batch are read and rewritten.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda raw, _: load_batch(raw, table))
    )


def run_available(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Load what has arrived, then stop: the daily schedule."""
    return daily_upsert(stream, table, checkpoint).trigger(availableNow=True).start()
