"""Daily weather: best row per location and day, location enrichment, metrics and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.functions import climate
from pampero.functions.calendar import with_calendar
from pampero.functions.safe import non_null_count, null_count
from pampero.operators.ranking import best_row, newest
from pampero.sources.schemas import MEASURES, REPLICATION

DAY = ["location_id", "date"]
LOAD_ORDER = ["record_loaded_at", "_sdc_received_at", "_sdc_extracted_at", "_sdc_sequence"]


def record_loaded_at() -> Column:
    return F.coalesce("source_loaded_at", "_sdc_extracted_at", "_sdc_received_at")


def live_rows(staged: DataFrame) -> DataFrame:
    """Snapshots that name a location and a day and are not deletions."""
    return staged.filter(
        F.col("location_id").isNotNull()
        & F.col("date").isNotNull()
        & F.col("_sdc_deleted_at").isNull()
    )


def counted_rows(staged: DataFrame) -> DataFrame:
    """Live snapshots with their load time and number of measures present."""
    return live_rows(staged).withColumns(
        {
            "record_loaded_at": record_loaded_at(),
            "weather_variable_non_null_count": non_null_count(MEASURES),
        }
    )


def best_daily_rows(staged: DataFrame) -> DataFrame:
    """Fullest, then newest snapshot of each location and day.

    Whatever the number of copies loaded, at most one row per day is left of a location. So
    `location_id`, hot as it may be in the raw table, is safe to join and rank on from here.
    """
    described = ["location_name", "province_name", "latitude", "longitude", "source_name"]
    remaining = ["source_type", "source_loaded_at", "_sdc_batched_at", "_sdc_table_version"]
    return best_row(
        counted_rows(staged),
        DAY,
        newest("weather_variable_non_null_count", *LOAD_ORDER),
        tiebreak=[*MEASURES, *described, *remaining],
    )


def daily_base(best: DataFrame, locations: DataFrame) -> DataFrame:
    """Best rows completed from the location catalogue, which wins over the payload.

    ``locations`` are the catalogue's current ones or the location dimension. Of the dimension,
    only rows of the catalogue complete a day; the names it gives every location are carried
    along as ``_dim_<name>``, so that the fact need not be joined with it again.

    Locations grow with the network of stations, so no broadcast is forced: Spark
    broadcasts them while they measure small and otherwise joins by shuffling on the key.
    """
    is_dimension = "is_catalog_location" in locations.columns
    listed = F.col("is_catalog_location") if is_dimension else F.lit(True)
    carried = {f"_dim_{c}": c for c in DIMENSION_NAMES} if is_dimension else {}
    catalog = locations.select(
        "location_id",
        F.when(listed, F.lit(True)).alias("_matched"),
        *[
            F.when(listed, F.col(c)).alias(f"_{c}")
            for c in [*_DESCRIBED, "country_code", "is_active"]
        ],
        *[F.col(c).alias(name) for name, c in carried.items()],
    )
    joined = best.join(catalog, "location_id", "left")
    return joined.select(
        "location_id",
        F.col("_is_active").alias("is_active_location"),
        "date",
        "source_name",
        "source_type",
        "source_loaded_at",
        "record_loaded_at",
        *MEASURES,
        "weather_variable_non_null_count",
        *REPLICATION,
        *[F.coalesce(f"_{c}", c).alias(c) for c in _DESCRIBED],
        F.coalesce("_country_code", F.lit("AR")).alias("country_code"),
        F.col("_matched").isNotNull().alias("has_location_dimension"),
        *carried,
    )


#: What the location dimension says of a fact row's place.
DIMENSION_NAMES = ["location_name", "province_name", "province_key"]

_DESCRIBED = ["location_name", "province_name", "province_key", "latitude", "longitude"]

METRICS = {
    "temp_range_c": lambda: F.col("max_air_temp_c") - F.col("min_air_temp_c"),
    "clear_sky_radiation_gap_mj_m2_day": lambda: (
        F.col("solar_radiation_clearsky_mj_m2_day") - F.col("solar_radiation_allsky_mj_m2_day")
    ),
    "heat_index_c": lambda: climate.heat_index(
        F.col("avg_air_temp_c"), F.col("relative_humidity_pct")
    ),
    "wind_chill_c": lambda: climate.wind_chill(
        F.col("avg_air_temp_c"), F.col("wind_speed_mps")
    ),
    "vpd_kpa": lambda: climate.vapour_pressure_deficit(
        F.col("avg_air_temp_c"), F.col("dew_point_temp_c")
    ),
    "gdd_base_10_c_days": lambda: climate.growing_degree_days(
        F.col("max_air_temp_c"), F.col("min_air_temp_c")
    ),
}


def with_metrics(base: DataFrame) -> DataFrame:
    """Add calendar columns and the derived metrics."""
    return with_calendar(base).withColumns({n: make() for n, make in METRICS.items()})


def latest_day(staged: DataFrame) -> DataFrame:
    """Newest live day of the whole table, as one row.

    Deduplication keeps at least one row of every day, so the maximum is taken before it: the
    scan needs three columns and no shuffle of the data.
    """
    return live_rows(staged).agg(F.max("date").alias("latest_date"))


def with_quality_flags(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn(
        "critical_null_count", null_count(climate.CRITICAL_MEASURES)
    ).withColumns(climate.quality_flags())


def approved() -> Column:
    raised = F.lit(False)
    for name in climate.quality_flags():
        raised = raised | F.col(name)
    return ~raised


def beside_latest_day(df: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows with the newest day of the table, ``latest_date``."""
    # `latest` is one row, whatever the size of the table.
    return df.crossJoin(F.broadcast(latest))


def with_partial_latest_day(flagged: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Mark rows of the newest day that still lack a critical measure. Without ``latest`` the rows
    carry it."""
    paired = flagged if latest is None else beside_latest_day(flagged, latest)
    partial = (F.col("date") == F.col("latest_date")) & (F.col("critical_null_count") > 0)
    return paired.withColumn(
        "is_partial_latest_day", F.coalesce(partial, F.lit(False))
    ).drop("latest_date")


def with_quality(metrics: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Add quality flags, risk flags, the partial-day mark and the approval."""
    flagged = with_quality_flags(metrics).withColumns(climate.risk_flags())
    return with_partial_latest_day(flagged, latest).withColumn("is_quality_approved", approved())
