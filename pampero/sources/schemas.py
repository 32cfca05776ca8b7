"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weather variables as (name in the source payload, canonical column, column of
# the first-generation table, meaning).
WEATHER_VARIABLES = [
    ("T2M_MAX", "max_air_temp_c", "t2m_max", "Daily maximum air temperature at 2 m, Celsius"),
    ("T2M_MIN", "min_air_temp_c", "t2m_min", "Daily minimum air temperature at 2 m, Celsius"),
    ("T2M", "avg_air_temp_c", "t2m", "Daily mean air temperature at 2 m, Celsius"),
    ("T2MDEW", "dew_point_temp_c", "t2m_dew", "Dew point at 2 m, Celsius"),
    ("T2MWET", "wet_bulb_temp_c", "t2m_wet", "Wet bulb temperature at 2 m, Celsius"),
    ("TS", "soil_surface_temp_c", "soil_temperature", "Surface temperature, Celsius"),
    ("PRECTOTCORR", "precipitation_mm", "precipitation_corrected", "Precipitation, mm a day"),
    ("RH2M", "relative_humidity_pct", "relative_humidity_2m", "Relative humidity at 2 m, %"),
    ("QV2M", "specific_humidity_kg_kg", "specific_humidity_2m", "Specific humidity at 2 m"),
    (
        "ALLSKY_SFC_SW_DWN",
        "solar_radiation_allsky_mj_m2_day",
        "solar_radiation_allsky",
        "Radiation under the actual sky, MJ per square metre and day",
    ),
    (
        "CLRSKY_SFC_SW_DWN",
        "solar_radiation_clearsky_mj_m2_day",
        "solar_radiation_clearsky",
        "Radiation under a clear sky, MJ per square metre and day",
    ),
    ("WS2M", "wind_speed_mps", "wind_speed_2m", "Wind speed at 2 m, m/s"),
    ("WS2M_MAX", "wind_speed_max_mps", "wind_speed_2m_max", "Maximum wind speed at 2 m, m/s"),
    ("WD2M", "wind_direction_deg", "wind_direction_2m", "Wind direction at 2 m, degrees"),
    ("PS", "surface_pressure_kpa", "surface_pressure", "Surface pressure, kPa"),
    ("CLOUD_AMT", "cloud_cover_pct", "cloud_amount", "Cloud cover, %"),
]
MEASURES = [canonical for _, canonical, _, _ in WEATHER_VARIABLES]

REPLICATION = [
    "_sdc_extracted_at",
    "_sdc_received_at",
    "_sdc_batched_at",
    "_sdc_deleted_at",
    "_sdc_sequence",
    "_sdc_table_version",
]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Payload members. All text: the values are cast afterwards, with guards.
LOCATION_PAYLOAD = _strings(
    [
        "location_id",
        "location_name",
        "province_name",
        "department_name",
        "municipality_name",
        "latitude",
        "longitude",
        "elevation",
        "country_code",
        "is_active",
        "source_catalog",
        "x_source_type",
        "x_loaded_at",
    ]
)
WEATHER_PAYLOAD = _strings(
    [
        "location_id",
        "location_name",
        "province_name",
        "latitude",
        "longitude",
        "date",
        "x_source",
        "x_source_type",
        "x_loaded_at",
        *[source for source, _, _, _ in WEATHER_VARIABLES],
    ]
)

_REPLICATION_FIELDS = [
    T.StructField(n, T.TimestampType() if n.endswith("_at") else T.LongType())
    for n in REPLICATION
]
RAW_LOCATIONS = T.StructType([*_REPLICATION_FIELDS, T.StructField("data", LOCATION_PAYLOAD)])
RAW_WEATHER = T.StructType([*_REPLICATION_FIELDS, T.StructField("data", WEATHER_PAYLOAD)])

# CSV files, read as text and cast afterwards.
TAX_CSV = _strings(
    [
        "province_name",
        "rural_property_tax_usd_ha_min",
        "rural_property_tax_usd_ha_max",
        "rural_property_tax_usd_ha_avg",
        "gross_turnover_tax_pct",
    ]
)
YIELD_CSV = _strings(
    [
        "crop_name",
        "harvest_year",
        "campaign_name",
        "province_name",
        "province_id",
        "department_name",
        "department_id",
        "sown_area_ha",
        "harvested_area_ha",
        "production_tonnes",
        "yield_kg_ha",
    ]
)
CATALOG_CSV = _strings(
    [
        "location_id",
        "location_name",
        "province_name",
        "latitude",
        "longitude",
        "country_code",
        "is_active",
    ]
)

COMMENTS = {
    **{canonical: meaning for _, canonical, _, meaning in WEATHER_VARIABLES},
    **{old: meaning for _, _, old, meaning in WEATHER_VARIABLES},
    "location_id": "Stable location identifier",
    "province_key": "Accent-free upper-case province name, the join key",
    "date": "Observation date",
    "campaign_name": "July-June farming campaign, YYYY/YYYY",
    "weather_variable_non_null_count": "Weather variables present, of 16",
    "is_quality_approved": "No quality flag is raised",
    "is_partial_latest_day": "Newest day of the table with a critical variable missing",
    "record_loaded_at": "Load time: source, else extraction, else reception",
    "yield_kg_ha": "Production over harvested area, kg per hectare",
    "selection_strategy": "usable row, or fallback when the location has none",
    "climate_index_total": "Mean of the three climate signals, 0-1",
}


#: What the stored relations are.
RELATIONS = {
    "best_weather": "Fullest, then newest snapshot of each location and day",
    "current_locations": "Newest live snapshot of each catalogued location",
    "dim_location": "Every location, from the catalogue or known from weather alone",
    "dim_province": "Every province, with the sources that know it",
    "fct_weather_daily": "One row a location and day: measures, metrics, quality and risks",
    "fct_tax_province": "Land and turnover tax of each known province",
    "fct_yield_province_campaign": "Crop yields by province, campaign and crop",
    "mart_province_campaign": "Yields next to weather of their campaign and taxes",
    "location_snapshot": "Newest usable day of each location, scored",
    "legacy_daily": "First-generation daily weather, in its own column names",
}


def documented(df: DataFrame, comments: dict[str, str] = COMMENTS) -> DataFrame:
    """Attach column comments, kept by tables saved from the result."""

    def column(name: str) -> Column:
        if name in comments:
            return F.col(name).alias(name, metadata={"comment": comments[name]})
        return F.col(name)

    return df.select([column(n) for n in df.columns])
