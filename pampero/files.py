"""Small files and folders through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another: readers see the old one or the new one.

    It is written beside and renamed over the old one in one step.
    """
    draft, store = _place(spark, f"{path}.{uuid.uuid4().hex}")
    stream = store.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    qualified = store.makeQualified(target)
    conf = spark._jsc.hadoopConfiguration()
    context = hadoop.FileContext.getFileContext(qualified.toUri(), conf)
    context.rename(store.makeQualified(draft), qualified, how)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place) if s.isDirectory())
