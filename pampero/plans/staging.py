"""Typed views of the raw snapshots and reference CSVs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.functions.safe import (
    safe_bool,
    safe_date,
    safe_double,
    safe_long,
    safe_timestamp,
)
from pampero.functions.text import normalize_text, trim_whitespace
from pampero.operators.payload import raw_member, text_member, with_payload
from pampero.sources.schemas import (
    LOCATION_PAYLOAD,
    REPLICATION,
    WEATHER_PAYLOAD,
    WEATHER_VARIABLES,
)


def _replication_columns(raw: DataFrame) -> list[Column]:
    """Replication metadata cast to its types; text a loader wrote has to look like them."""
    texts = dict(raw.dtypes)

    def typed(name: str) -> Column:
        is_time = name.endswith("_at")
        if texts.get(name) == "string":
            return (safe_timestamp if is_time else safe_long)(F.col(name))
        return F.col(name).try_cast("timestamp" if is_time else "bigint")

    return [typed(n).alias(n) for n in REPLICATION]


def locations(raw: DataFrame) -> DataFrame:
    """One row per raw snapshot of a location."""
    return with_payload(raw, LOCATION_PAYLOAD).select(
        text_member("location_id").alias("location_id"),
        text_member("location_name").alias("location_name"),
        text_member("province_name").alias("province_name"),
        normalize_text(text_member("province_name")).alias("province_key"),
        text_member("department_name").alias("department_name"),
        normalize_text(text_member("department_name")).alias("department_key"),
        text_member("municipality_name").alias("municipality_name"),
        safe_double(raw_member("latitude")).alias("latitude"),
        safe_double(raw_member("longitude")).alias("longitude"),
        safe_double(raw_member("elevation")).alias("elevation_m"),
        text_member("country_code").alias("country_code"),
        safe_bool(raw_member("is_active")).alias("is_active"),
        text_member("source_catalog").alias("source_catalog"),
        text_member("x_source_type").alias("source_type"),
        safe_timestamp(raw_member("x_loaded_at")).alias("source_loaded_at"),
        *_replication_columns(raw),
    )


def weather(raw: DataFrame) -> DataFrame:
    """One row per raw snapshot of a location's day, with 16 renamed measures."""
    return with_payload(raw, WEATHER_PAYLOAD).select(
        text_member("location_id").alias("location_id"),
        text_member("location_name").alias("location_name"),
        text_member("province_name").alias("province_name"),
        normalize_text(text_member("province_name")).alias("province_key"),
        safe_double(raw_member("latitude")).alias("latitude"),
        safe_double(raw_member("longitude")).alias("longitude"),
        safe_date(raw_member("date")).alias("date"),
        text_member("x_source").alias("source_name"),
        text_member("x_source_type").alias("source_type"),
        safe_timestamp(raw_member("x_loaded_at")).alias("source_loaded_at"),
        *[safe_double(raw_member(v)).alias(name) for v, name, _, _ in WEATHER_VARIABLES],
        *_replication_columns(raw),
    )


def tax(csv: DataFrame) -> DataFrame:
    """Land and turnover tax per province."""
    return csv.select(
        "province_name",
        normalize_text(F.col("province_name")).alias("province_key"),
        *[safe_double(F.col(c)).alias(c) for c in csv.columns if c != "province_name"],
    )


def yields(csv: DataFrame) -> DataFrame:
    """Crop yield per department and campaign."""
    years = F.split("campaign_name", "/")
    measures = ["sown_area_ha", "harvested_area_ha", "production_tonnes", "yield_kg_ha"]
    return csv.select(
        F.lower(trim_whitespace(F.col("crop_name"))).alias("crop_name"),
        normalize_text(F.col("crop_name")).alias("crop_key"),
        safe_long(F.col("harvest_year")).alias("harvest_year"),
        "campaign_name",
        safe_long(F.get(years, F.lit(0))).alias("campaign_start_year"),
        safe_long(F.get(years, F.lit(1))).alias("campaign_end_year"),
        "province_name",
        normalize_text(F.col("province_name")).alias("province_key"),
        "province_id",
        "department_name",
        normalize_text(F.col("department_name")).alias("department_key"),
        "department_id",
        *[safe_double(F.col(c)).alias(c) for c in measures],
    )


def legacy_locations(raw: DataFrame) -> DataFrame:
    """First-generation view: every raw column but the payload, then the extracted ones."""
    return with_payload(raw, LOCATION_PAYLOAD).select(
        *[c for c in raw.columns if c != "data"],
        text_member("location_id").alias("location_id"),
        text_member("location_name").alias("location_name"),
        text_member("province_name").alias("province_name"),
        safe_double(raw_member("latitude")).alias("latitude"),
        safe_double(raw_member("longitude")).alias("longitude"),
        text_member("country_code").alias("country_code"),
        safe_bool(raw_member("is_active")).alias("is_active"),
    )


def legacy_weather(raw: DataFrame) -> DataFrame:
    """First-generation view of weather snapshots."""
    return with_payload(raw, WEATHER_PAYLOAD).select(
        *[c for c in raw.columns if c != "data"],
        text_member("location_id").alias("location_id"),
        safe_date(raw_member("date")).alias("date"),
        text_member("x_source").alias("x_source"),
        text_member("x_source_type").alias("x_source_type"),
        safe_timestamp(raw_member("x_loaded_at")).alias("x_loaded_at"),
        *[safe_double(raw_member(v)).alias(name) for v, _, name, _ in WEATHER_VARIABLES],
    )


def flattened_weather(raw: DataFrame) -> DataFrame:
    """Raw weather with the payload members at top level, still as text; nested ones are NULL."""
    members = [text_member(n).alias(n) for n in WEATHER_PAYLOAD.fieldNames()]
    return with_payload(raw, WEATHER_PAYLOAD).select(*members, *REPLICATION)
