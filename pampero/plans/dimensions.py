"""Location and province dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.operators.ranking import best_row, newest
from pampero.plans.weather import LOAD_ORDER, record_loaded_at
from pampero.sources.schemas import REPLICATION

LOCATION_COLUMNS = [
    "location_id",
    "location_name",
    "province_name",
    "province_key",
    "department_name",
    "department_key",
    "municipality_name",
    "latitude",
    "longitude",
    "elevation_m",
    "country_code",
    "is_active",
    "source_catalog",
    "source_type",
    "source_loaded_at",
    "record_loaded_at",
]


def current_locations(staged: DataFrame) -> DataFrame:
    """Newest live snapshot of each location.

    Deletions rank last and are dropped after ranking: a location whose newest snapshot is a
    deletion keeps its newest earlier version, and only one deleted throughout disappears.
    """
    ranked = best_row(
        staged.withColumn("record_loaded_at", record_loaded_at()),
        ["location_id"],
        [F.col("_sdc_deleted_at").isNotNull().asc(), *newest(*LOAD_ORDER)],
        tiebreak=[c for c in staged.columns if c not in ("location_id", *LOAD_ORDER)],
    )
    live = ranked.filter(F.col("_sdc_deleted_at").isNull())
    return live.select(*LOCATION_COLUMNS, *REPLICATION)


def weather_only_locations(best_daily: DataFrame, current: DataFrame) -> DataFrame:
    """Locations seen in weather rows but not in the catalogue, from their newest row.

    Unmatched rows carry only what the payload says: country is the default, activity unknown.
    """
    unlisted = best_daily.join(current.select("location_id"), "location_id", "left_anti")
    newest_row = best_row(unlisted, ["location_id"], newest("record_loaded_at", "date"), [])
    absent = F.lit(None).cast("string")
    return newest_row.select(
        "location_id",
        "location_name",
        "province_name",
        "province_key",
        absent.alias("department_name"),
        absent.alias("department_key"),
        absent.alias("municipality_name"),
        "latitude",
        "longitude",
        F.lit(None).cast("double").alias("elevation_m"),
        F.lit("AR").alias("country_code"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.lit("weather_fallback").alias("source_catalog"),
        "source_type",
        "source_loaded_at",
        "record_loaded_at",
    )


def dim_location(current: DataFrame, weather_only: DataFrame) -> DataFrame:
    """Catalogue locations and, flagged, those known from weather alone."""
    listed = current.select(*LOCATION_COLUMNS).withColumn("is_catalog_location", F.lit(True))
    return listed.unionByName(weather_only.withColumn("is_catalog_location", F.lit(False)))


# Source of a province name, best first.
PROVINCE_SOURCES = ["weather", "tax", "yield"]


def province_mentions(current: DataFrame, tax: DataFrame, yields: DataFrame) -> DataFrame:
    """Distinct (key, name, source rank) of every province named anywhere.

    Reduced to distinct spellings per source before any shuffle, so a province that holds much
    of a source weighs no more than the others.
    """
    tagged = [
        df.select("province_key", "province_name", F.lit(rank).alias("source_rank"))
        for rank, df in enumerate([current, tax, yields])
    ]
    return reduce(DataFrame.unionByName, tagged).distinct()


def province_coverage(mentions: DataFrame) -> DataFrame:
    """Which sources know each province key."""
    return mentions.groupBy("province_key").agg(
        *[
            F.bool_or(F.col("source_rank") == rank).alias(f"has_{source}_data")
            for rank, source in enumerate(PROVINCE_SOURCES)
        ]
    )


def dim_province(mentions: DataFrame) -> DataFrame:
    """One row per province: the name from the best source, and which sources know it.

    One aggregation gives both the name and the coverage.
    """
    named = mentions.filter(F.col("province_key") != "")
    best_name = F.min(F.struct("source_rank", "province_name"))["province_name"]
    coverage = [
        F.bool_or(F.col("source_rank") == rank).alias(f"has_{source}_data")
        for rank, source in enumerate(PROVINCE_SOURCES)
    ]
    return named.groupBy("province_key").agg(best_name.alias("province_name"), *coverage)
