"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: what ``spark.checkpoint.dir`` names.

    A session without the setting is an error: a folder of one machine would lose data with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path for one intermediate table."""
    return f"{shared_folder(spark)}/pampero/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a relation once and return it as a table scan.

    For relations that several later steps read: parsing, deduplication and shuffle happen
    once, later readers prune columns in Parquet, and a lost executor costs a re-read rather
    than a recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Have the files of finished shuffles deleted: Spark does so once the driver has noticed that
    nothing refers to them, which it otherwise may not for long."""
    # Spark's listeners hold the execution they were last told of, until they are told of another.
    spark.range(1).count()
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`stage` for one use: the table is deleted at the end, whether that went well or not."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)
