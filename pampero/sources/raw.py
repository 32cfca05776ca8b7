"""Readers of raw snapshot tables and reference CSVs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw snapshots stored as Parquet; no rows, with the same schema, if nothing is there yet.

    The empty relation lets every downstream model resolve before the first load. Any other
    failure (no permission, a broken file) is raised, not taken for an empty source.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reference CSV with a header line, read under its declared schema.

    Surrounding whitespace is kept: cleaning is the staging models' work.
    """
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


def catalog_as_raw(catalog: DataFrame, extracted_at: str) -> DataFrame:
    """Location catalogue CSV rows in the shape of the raw locations table."""
    stamp = F.lit(extracted_at).cast("timestamp")
    return catalog.select(
        stamp.alias("_sdc_extracted_at"),
        stamp.alias("_sdc_received_at"),
        stamp.alias("_sdc_batched_at"),
        F.lit(None).cast("timestamp").alias("_sdc_deleted_at"),
        F.lit(0).cast("bigint").alias("_sdc_sequence"),
        F.lit(0).cast("bigint").alias("_sdc_table_version"),
        F.struct(*catalog.columns).alias("data"),
    )
