"""Facts, the province-campaign mart and the location snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.functions import climate
from pampero.functions.safe import safe_divide
from pampero.operators.ranking import best_row, newest
from pampero.plans.weather import (
    DIMENSION_NAMES,
    LOAD_ORDER,
    METRICS,
    beside_latest_day,
    with_metrics,
    with_quality,
)
from pampero.sources.schemas import MEASURES, REPLICATION

CALENDAR = [
    "calendar_year",
    "calendar_month",
    "calendar_quarter",
    "week_start",
    "month_start",
    "campaign_start_year",
    "campaign_name",
]
QUALITY = [
    "has_high_missing_data",
    "temperature_inconsistent",
    "temperature_outlier",
    "precipitation_outlier",
    "wind_outlier",
    "radiation_inconsistent",
]
RISKS = ["frost_day", "heat_stress_day", "heavy_rain_day", "dry_day", "fungal_risk_day"]
LOADED = ["source_name", "source_type", "source_loaded_at", "record_loaded_at"]
TAX_RATES = [
    "rural_property_tax_usd_ha_min",
    "rural_property_tax_usd_ha_max",
    "rural_property_tax_usd_ha_avg",
    "rural_property_tax_usd_ha_spread",
    "gross_turnover_tax_pct",
]
YIELD_MEASURES = [
    "department_count",
    "sown_area_ha",
    "harvested_area_ha",
    "harvested_share_pct",
    "production_tonnes",
    "yield_kg_ha",
]


def fct_rows(base: DataFrame, latest: DataFrame) -> DataFrame:
    """What the fact is worked out from, row by row: days completed from the location dimension,
    which names the place, with their month and the table's newest day.

    About half as wide as the fact, so it is these rows that are shuffled and sorted.
    """
    named = base.withColumns(
        {
            **{c: F.coalesce(f"_dim_{c}", c) for c in DIMENSION_NAMES},
            "month_start": F.trunc("date", "month"),
        }
    )
    return beside_latest_day(named.drop(*[f"_dim_{c}" for c in DIMENSION_NAMES]), latest)


def fct_weather_daily(rows: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """Daily weather fact, and columns of the rows carried along as they are.

    Position and country keep what the base resolved.
    """
    return with_quality(with_metrics(rows)).select(
        "location_id",
        "latitude",
        "longitude",
        "country_code",
        "is_active_location",
        "date",
        *CALENDAR,
        *MEASURES,
        *METRICS,
        "weather_variable_non_null_count",
        "critical_null_count",
        *QUALITY,
        *RISKS,
        "is_partial_latest_day",
        "is_quality_approved",
        "has_location_dimension",
        *LOADED,
        *REPLICATION,
        *DIMENSION_NAMES,
        *(carried or []),
    )


def tax_by_province(staged_tax: DataFrame) -> DataFrame:
    """Tax rates with the spread between the land tax bounds."""
    spread = F.col("rural_property_tax_usd_ha_max") - F.col("rural_property_tax_usd_ha_min")
    return staged_tax.withColumn("rural_property_tax_usd_ha_spread", spread)


def yields_by_province(staged_yields: DataFrame) -> DataFrame:
    """Departments summed to province, campaign and crop.

    Names are part of the grain: two spellings of one province stay two rows, which the
    uniqueness check reports.
    """
    grain = [
        "crop_name",
        "crop_key",
        "campaign_name",
        "campaign_start_year",
        "campaign_end_year",
        "harvest_year",
        "province_name",
        "province_key",
    ]
    totals = staged_yields.groupBy(*grain).agg(
        F.count_distinct("department_id").alias("department_count"),
        F.sum("sown_area_ha").alias("sown_area_ha"),
        F.sum("harvested_area_ha").alias("harvested_area_ha"),
        F.sum("production_tonnes").alias("production_tonnes"),
    )
    harvested, kilos = F.col("harvested_area_ha"), F.col("production_tonnes") * F.lit(1000.0)
    return totals.withColumns(
        {
            "yield_kg_ha": safe_divide(kilos, harvested),
            "harvested_share_pct": safe_divide(harvested, F.col("sown_area_ha")),
        }
    )


def _conformed(fact: DataFrame, dim_province: DataFrame) -> DataFrame:
    """Fact rows of known provinces under the province's canonical name."""
    names = dim_province.select("province_key", "province_name")
    return fact.drop("province_name").join(names, "province_key", "inner")


def fct_tax_province(tax: DataFrame, dim_province: DataFrame) -> DataFrame:
    return _conformed(tax, dim_province).select("province_name", "province_key", *TAX_RATES)


def fct_yield_province_campaign(yields: DataFrame, dim_province: DataFrame) -> DataFrame:
    return _conformed(yields, dim_province).select(
        "province_name",
        "province_key",
        "crop_name",
        "crop_key",
        "campaign_name",
        "campaign_start_year",
        "campaign_end_year",
        "harvest_year",
        *YIELD_MEASURES,
    )


def weather_by_campaign(fact: DataFrame) -> DataFrame:
    """Campaign weather of each province, over approved and unapproved days alike.

    The distinct location count makes Spark aggregate by location first, so the largest
    province is summed by many tasks before its partial results meet.
    """
    def days(flag: str):
        return F.count_if(F.col(flag))

    return fact.groupBy("province_key", "campaign_name", "campaign_start_year").agg(
        F.count("*").alias("weather_day_count"),
        days("is_quality_approved").alias("usable_weather_day_count"),
        F.count_distinct("location_id").alias("weather_location_count"),
        F.sum("precipitation_mm").alias("campaign_precipitation_mm"),
        F.avg("avg_air_temp_c").alias("avg_campaign_temp_c"),
        F.max("max_air_temp_c").alias("max_campaign_temp_c"),
        F.min("min_air_temp_c").alias("min_campaign_temp_c"),
        F.avg("relative_humidity_pct").alias("avg_relative_humidity_pct"),
        F.avg("vpd_kpa").alias("avg_vpd_kpa"),
        F.sum("gdd_base_10_c_days").alias("total_gdd_base_10"),
        days("frost_day").alias("frost_days"),
        days("heat_stress_day").alias("heat_days"),
        days("heavy_rain_day").alias("heavy_rain_days"),
        days("dry_day").alias("dry_days"),
        days("fungal_risk_day").alias("fungal_risk_days"),
    )


CAMPAIGN_WEATHER = [
    "weather_day_count",
    "usable_weather_day_count",
    "weather_location_count",
    "campaign_precipitation_mm",
    "avg_campaign_temp_c",
    "max_campaign_temp_c",
    "min_campaign_temp_c",
    "avg_relative_humidity_pct",
    "avg_vpd_kpa",
    "total_gdd_base_10",
    "frost_days",
    "heat_days",
    "heavy_rain_days",
    "dry_days",
    "fungal_risk_days",
]


def mart_province_campaign(
    yield_fact: DataFrame, campaign_weather: DataFrame, tax_fact: DataFrame
) -> DataFrame:
    """Yields next to the weather of their campaign and the taxes of their province.

    Both sides are aggregates of provinces, campaigns and crops; weather is aggregated before
    it is joined.
    """
    weather = campaign_weather.drop("campaign_start_year").withColumn(
        "has_weather_campaign_data", F.lit(True)
    )
    tax = tax_fact.drop("province_name").withColumn("has_tax_data", F.lit(True))
    joined = yield_fact.join(weather, ["province_key", "campaign_name"], "left").join(
        tax, "province_key", "left"
    )
    ratio = safe_divide(F.col("usable_weather_day_count"), F.col("weather_day_count"))
    return joined.select(
        *yield_fact.columns,
        *CAMPAIGN_WEATHER,
        *TAX_RATES,
        ratio.alias("usable_weather_day_ratio"),
        F.col("has_weather_campaign_data").isNotNull().alias("has_weather_campaign_data"),
        F.col("has_tax_data").isNotNull().alias("has_tax_data"),
    )


def _is_usable():
    return F.col("is_quality_approved") & ~F.col("is_partial_latest_day")


def snapshot_rows(fact: DataFrame) -> DataFrame:
    """Newest usable day of each location, or its newest day if none is usable."""
    chosen = best_row(
        fact,
        ["location_id"],
        [_is_usable().desc_nulls_last(), *newest("date", *LOAD_ORDER)],
        tiebreak=[],
    )
    strategy = F.when(_is_usable(), F.lit("usable")).otherwise(F.lit("fallback"))
    return chosen.withColumn("selection_strategy", strategy)


def with_climate_scores(snapshot: DataFrame) -> DataFrame:
    """Add the three climate signals (0-100) and their index (0-1)."""
    signals = snapshot.withColumns(
        {
            "climate_rain_signal": climate.rain_signal(F.col("precipitation_mm")),
            "climate_water_stress_signal": climate.water_stress_signal(
                F.col("vpd_kpa"), F.col("relative_humidity_pct"), F.col("dry_day")
            ),
            "climate_temperature_signal": climate.temperature_signal(
                F.col("heat_stress_day"),
                F.col("frost_day"),
                F.col("temp_range_c"),
                F.col("max_air_temp_c"),
                F.col("min_air_temp_c"),
            ),
        }
    )
    index = climate.climate_index(
        F.col("climate_rain_signal"),
        F.col("climate_water_stress_signal"),
        F.col("climate_temperature_signal"),
    )
    return signals.withColumn("climate_index_total", index)


def location_snapshot(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """One scored row per location that has weather.

    Ranking comes first: one row per location is left to be joined and scored.
    """
    dim_first = ["location_name", "province_name", "province_key", "latitude", "longitude"]
    dim_only = [
        "department_name",
        "department_key",
        "municipality_name",
        "elevation_m",
        "source_catalog",
        "is_catalog_location",
    ]
    dim = dim_location.select(
        "location_id",
        *dim_only,
        *[F.col(c).alias(f"_{c}") for c in [*dim_first, "country_code", "is_active", "source_type"]],
    )
    joined = snapshot_rows(fact).join(dim, "location_id", "left")
    scored = with_climate_scores(joined)
    return scored.select(
        "location_id",
        *[F.coalesce(f"_{c}", c).alias(c) for c in dim_first],
        F.coalesce("_country_code", "country_code", F.lit("AR")).alias("country_code"),
        F.coalesce("_is_active", "is_active_location", F.lit(True)).alias("is_active"),
        *dim_only[:5],
        # The weather row knows best where its own data came from.
        F.coalesce("source_type", "_source_type").alias("source_type"),
        "source_name",
        "source_loaded_at",
        "record_loaded_at",
        F.col("date").alias("snapshot_date"),
        "campaign_name",
        "is_catalog_location",
        "has_location_dimension",
        "weather_variable_non_null_count",
        "critical_null_count",
        "has_high_missing_data",
        "is_quality_approved",
        "is_partial_latest_day",
        "selection_strategy",
        *MEASURES,
        *METRICS,
        *QUALITY[1:],
        *RISKS,
        "climate_rain_signal",
        "climate_water_stress_signal",
        "climate_temperature_signal",
        "_sdc_received_at",
        "_sdc_extracted_at",
        "_sdc_sequence",
        "climate_index_total",
    )
