"""Stored relations: views, tables, and tables partitioned by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.operators.monthly import MONTH, read_table, write_months
from pampero.plans import marts
from pampero.plans.models import Models
from pampero.sources.schemas import documented


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Lazy named relation."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, cluster_by: list[str]) -> None:
    """Full rebuild, dealt by a hash of the cluster columns and sorted by them within files.

    Row groups then cover narrow ranges of the first column, and the others share out a value
    of it that holds much of the table. The input is worked out once.
    """
    clustered = documented(df)
    if cluster_by:
        clustered = clustered.repartition(*cluster_by).sortWithinPartitions(*cluster_by)
    clustered.write.option("compression", "zstd").mode("overwrite").parquet(path)


def _finished_fact(rows: DataFrame) -> DataFrame:
    """The fact of rows in the order of its files, which their own month and span say."""
    kept = rows.withColumn("_month", F.col(MONTH))
    fact = marts.fct_weather_daily(kept, ["span", "_month"])
    return documented(fact.drop(MONTH).withColumnRenamed("_month", MONTH))


def build(models: Models, out: str) -> dict[str, str]:
    """Write the marts under `out`; returns the path of each.

    Facts read by later marts are read back from their stored form, as tables.
    """
    spark = models.stg_weather.sparkSession
    paths = {}

    def table(name: str, df: DataFrame, cluster_by: list[str]) -> DataFrame:
        paths[name] = f"{out}/{name}"
        write_table(df, paths[name], cluster_by)
        return spark.read.schema(df.schema).parquet(paths[name])

    models.dim_location = table(
        "dim_location", models.dim_location, ["province_key", "location_id"]
    )
    models.dim_province = table("dim_province", models.dim_province, [])
    paths["fct_weather_daily"] = f"{out}/fct_weather_daily"
    fact, cluster_by = paths["fct_weather_daily"], ["province_key", "location_id"]
    columns = models.fct_weather.columns
    write_months(models.fct_rows, fact, cluster_by, whole=True, finish=_finished_fact)
    models.fct_weather = read_table(spark, fact).select(*columns)
    models.fct_tax = table("fct_tax_province", models.fct_tax, [])
    models.fct_yield = table("fct_yield_province_campaign", models.fct_yield, [])
    table("mart_province_campaign", models.mart_province_campaign, [])
    table("location_snapshot", models.location_snapshot, ["province_key", "location_id"])
    return paths
