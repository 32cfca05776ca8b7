"""First-generation daily table: raw rows to metrics in one chain, loaded by increments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.functions import legacy
from pampero.functions.safe import safe_date, safe_double, safe_timestamp
from pampero.operators.ranking import best_row, newest
from pampero.sources.schemas import REPLICATION, WEATHER_VARIABLES

KEY = ["location_id", "date"]
VARIABLES = [name for _, _, name, _ in WEATHER_VARIABLES]


def newest_extracts(flattened: DataFrame) -> DataFrame:
    """Newest extract of each location and date *text*.

    The text is compared before it is cast: ``2024-1-1`` and ``2024-01-01`` are two keys here
    and both survive.
    """
    rest = [c for c in flattened.columns if c not in (*KEY, "_sdc_extracted_at")]
    tiebreak = ["_sdc_sequence", *[c for c in rest if c != "_sdc_sequence"]]
    return best_row(flattened, KEY, newest("_sdc_extracted_at"), tiebreak)


def cleaned(extracts: DataFrame) -> DataFrame:
    return extracts.select(
        "location_id",
        "location_name",
        "province_name",
        safe_double(F.col("latitude")).alias("latitude"),
        safe_double(F.col("longitude")).alias("longitude"),
        safe_date(F.col("date")).alias("date"),
        *[safe_double(F.col(v)).alias(name) for v, _, name, _ in WEATHER_VARIABLES],
        "x_source",
        "x_source_type",
        safe_timestamp(F.col("x_loaded_at")).alias("loaded_at"),
        *REPLICATION,
    )


def with_derived(clean: DataFrame) -> DataFrame:
    return clean.withColumns({**legacy.metrics(), **legacy.risk_flags(), **legacy.quality()})


def daily(flattened: DataFrame) -> DataFrame:
    """First-generation daily rows; keys are checked after deduplication, not before."""
    date = F.col("date")
    derived = with_derived(cleaned(newest_extracts(flattened)))
    keyed = derived.filter(F.col("location_id").isNotNull() & date.isNotNull())
    return keyed.select(
        "location_id",
        "location_name",
        "province_name",
        "latitude",
        "longitude",
        "date",
        F.year(date).cast("bigint").alias("year"),
        F.month(date).cast("bigint").alias("month"),
        F.quarter(date).cast("bigint").alias("quarter"),
        F.trunc(date, "week").alias("week_start"),
        F.trunc(date, "month").alias("month_start"),
        *VARIABLES,
        *legacy.metrics(),
        *legacy.risk_flags(),
        *legacy.quality(),
        "x_source",
        "x_source_type",
        "loaded_at",
        *REPLICATION,
    )
