"""The same results in DuckDB SQL, computed without the package.

Each query is a chain of common table expressions picked by name from `STEPS`, then one
SELECT. Source rows are derived here by their own arithmetic, as typed values, not through
payload text. Doubles that depend on EXP, POW or the order of a sum are cut to six decimals on
both sides. The cut lies off the middle between two results: exact halves do occur, and there
the last bit would decide.
"""

from __future__ import annotations

from pampero.sources.schemas import COMMENTS, RELATIONS

# Source variable, name of the measure, its first-generation name.
VARIABLES = [
    ("T2M_MAX", "max_air_temp_c", "t2m_max"),
    ("T2M_MIN", "min_air_temp_c", "t2m_min"),
    ("T2M", "avg_air_temp_c", "t2m"),
    ("T2MDEW", "dew_point_temp_c", "t2m_dew"),
    ("T2MWET", "wet_bulb_temp_c", "t2m_wet"),
    ("TS", "soil_surface_temp_c", "soil_temperature"),
    ("PRECTOTCORR", "precipitation_mm", "precipitation_corrected"),
    ("RH2M", "relative_humidity_pct", "relative_humidity_2m"),
    ("QV2M", "specific_humidity_kg_kg", "specific_humidity_2m"),
    ("ALLSKY_SFC_SW_DWN", "solar_radiation_allsky_mj_m2_day", "solar_radiation_allsky"),
    ("CLRSKY_SFC_SW_DWN", "solar_radiation_clearsky_mj_m2_day", "solar_radiation_clearsky"),
    ("WS2M", "wind_speed_mps", "wind_speed_2m"),
    ("WS2M_MAX", "wind_speed_max_mps", "wind_speed_2m_max"),
    ("WD2M", "wind_direction_deg", "wind_direction_2m"),
    ("PS", "surface_pressure_kpa", "surface_pressure"),
    ("CLOUD_AMT", "cloud_cover_pct", "cloud_amount"),
]
MEASURES = [measure for _, measure, _ in VARIABLES]

REPLICATION = [
    "_sdc_extracted_at",
    "_sdc_received_at",
    "_sdc_batched_at",
    "_sdc_deleted_at",
    "_sdc_sequence",
    "_sdc_table_version",
]

# What tells the newer of two snapshots of a day.
VERSION = ["_sdc_extracted_at", "_sdc_sequence"]

CUT = 0.3137

ROUNDED = {
    "heat_index_c",
    "wind_chill_c",
    "vpd_kpa",
    "avg_campaign_temp_c",
    "avg_relative_humidity_pct",
    "avg_vpd_kpa",
    "total_gdd_base_10",
    "campaign_precipitation_mm",
    "production_tonnes",
    "sown_area_ha",
    "harvested_area_ha",
    "yield_kg_ha",
    "harvested_share_pct",
    "rural_property_tax_usd_ha_avg",
    "rural_property_tax_usd_ha_spread",
    "usable_weather_day_ratio",
    "heat_index",
    "wind_chill",
    "vapor_pressure_deficit",
    "coverage_ratio",
}


def norm(text: str) -> str:
    """normalize_text in SQL."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"
    folded = (
        f"translate(upper(trim({text}, {blank})), 'ÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇ', "
        "'AAAAAEEEEIIIIOOOOOUUUUNC')"
    )
    return rf"regexp_replace({folded}, '\s+', ' ', 'g')"


def newest(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


def _gap(k: int, value: str, source: str, name: str) -> str:
    rule = f"(31 * o + 7 * n + p + 5 * {k}) % 29 = 0"
    if k >= 5:
        rule += " OR o % 97 = 0"
    if source == "CLOUD_AMT":
        rule += " OR o % 89 = 0"
    return f"CASE WHEN {rule} THEN NULL ELSE CAST({value} AS DOUBLE) END AS {name}"


# Source variable -> (position in the gap rule, value).
_VALUES = {
    "T2M_MAX": (0, "CASE WHEN o % 211 = 0 THEN t - 9 ELSE t + 2 + n END"),
    "T2M_MIN": (1, "t - 2 - p % 7"),
    "T2M": (2, "t"),
    "T2MDEW": (3, "t - (100 - rh) / 5e0"),
    "PRECTOTCORR": (
        4,
        "CASE WHEN n <= 3 THEN 0 ELSE floor(x / 2000) END + CASE WHEN o % 503 = 0 THEN 450 ELSE 0 END",
    ),
    "RH2M": (5, "rh"),
    "ALLSKY_SFC_SW_DWN": (
        6,
        "CASE WHEN o % 307 = 0 THEN 11 + p % 20 ELSE 0.75e0 * (10 + p % 20) END",
    ),
    "CLRSKY_SFC_SW_DWN": (7, "10 + p % 20"),
    "WS2M": (8, "w"),
    "T2MWET": (9, "t"),
    "TS": (10, "t"),
    "QV2M": (11, "rh / 5000e0"),
    "WS2M_MAX": (12, "w + 1 + p % 5"),
    "WD2M": (13, "(7 * o) % 360"),
    "PS": (14, "90 + p % 12"),
    "CLOUD_AMT": (15, "(3 * p) % 101"),
}


def _measures(names: dict[str, str]) -> str:
    return ",\n".join(
        _gap(k, value, source, names[source]) for source, (k, value) in _VALUES.items()
    )


_CANONICAL = {source: canonical for source, canonical, _ in VARIABLES}
_LEGACY = {source: old for source, _, old in VARIABLES}
LEGACY_MEASURES = list(_LEGACY.values())

_STAMPS = """
    shipped + to_hours(p % 24) AS _sdc_extracted_at,
    shipped + to_hours(p % 24) + to_minutes(1) AS _sdc_received_at,
    shipped + to_hours(p % 24) + to_minutes(2) AS _sdc_batched_at,
    CASE WHEN o % 101 = 0 THEN shipped + to_hours(p % 24) END AS _sdc_deleted_at,
    10 * o + n AS _sdc_sequence,
    CAST(1 AS BIGINT) AS _sdc_table_version"""

_PLACE = """
    CASE WHEN o % 1013 = 0 THEN NULL ELSE 'loc_' || s END AS location_id,
    'Punto ' || s AS location_name,
    CASE WHEN s % 4 = 3 THEN NULL ELSE 'NATION_' || (s % 25) END AS province_name,
    CAST(-20 - (s % 350) / 10e0 AS DOUBLE) AS latitude,
    CAST(-55 - (s % 180) / 10e0 AS DOUBLE) AS longitude"""

_DATE = "CASE WHEN o % 1009 = 0 THEN NULL ELSE CAST(shipped AS DATE) END"
_LOADED = "CASE WHEN o % 13 = 0 THEN NULL ELSE shipped + to_hours(n) END"
_SOURCE_TYPE = "CASE WHEN o % 17 = 0 THEN NULL ELSE 'satellite' END"


def _province(second: str) -> str:
    return (
        "CASE n_nationkey % 3 WHEN 0 THEN n_name "
        f"WHEN 1 THEN {second} ELSE lower(n_name) END"
    )


_PRESENT = " + ".join(f"({m} IS NOT NULL)::BIGINT" for m in MEASURES)
_ORDER = ["record_loaded_at", "_sdc_received_at", "_sdc_extracted_at", "_sdc_sequence"]
_TIES = [
    *MEASURES,
    "location_name",
    "province_name",
    "latitude",
    "longitude",
    "source_name",
    "source_type",
    "source_loaded_at",
    "_sdc_batched_at",
]
_TF = "(avg_air_temp_c * 9 / 5e0 + 32)"
_RH = "relative_humidity_pct"
_KPH = "(wind_speed_mps * 3.6e0)"


# The published heat index regression and wind chill formula.
def _regression(t: str, r: str) -> str:
    return (
        f"-42.379e0 + 2.04901523e0 * {t} + 10.14333127e0 * {r} - 0.22475541e0 * {t} * {r}"
        f" - 0.00683783e0 * pow({t}, 2) - 0.05481717e0 * pow({r}, 2)"
        f" + 0.00122874e0 * pow({t}, 2) * {r} + 0.00085282e0 * {t} * pow({r}, 2)"
        f" - 0.00000199e0 * pow({t}, 2) * pow({r}, 2)"
    )


def _chill(t: str, v: str) -> str:
    return (
        f"13.12e0 + 0.6215e0 * {t} - 11.37e0 * pow({v}, 0.16e0)"
        f" + 0.3965e0 * {t} * pow({v}, 0.16e0)"
    )


def _pressure(t: str, scale: str, slope: str, offset: str) -> str:
    return f"{scale} * exp({slope} * {t} / ({t} + {offset}))"


def _tetens(t: str) -> str:
    return _pressure(t, "0.6108e0", "17.27e0", "237.3e0")


def _magnus(t: str) -> str:
    return _pressure(t, "6.1094e0", "17.625e0", "243.04e0")


FLAGS = [
    "has_high_missing_data",
    "temperature_inconsistent",
    "temperature_outlier",
    "precipitation_outlier",
    "wind_outlier",
    "radiation_inconsistent",
]
RISKS = ["frost_day", "heat_stress_day", "heavy_rain_day", "dry_day", "fungal_risk_day"]
METRICS = [
    "temp_range_c",
    "clear_sky_radiation_gap_mj_m2_day",
    "heat_index_c",
    "wind_chill_c",
    "vpd_kpa",
    "gdd_base_10_c_days",
]
CALENDAR = [
    "calendar_year",
    "calendar_month",
    "calendar_quarter",
    "week_start",
    "month_start",
    "campaign_start_year",
    "campaign_name",
]
TAXES = [
    "rural_property_tax_usd_ha_min",
    "rural_property_tax_usd_ha_max",
    "rural_property_tax_usd_ha_avg",
    "rural_property_tax_usd_ha_spread",
    "gross_turnover_tax_pct",
]
_PLACE_COLUMNS = ["location_name", "province_name", "province_key", "latitude", "longitude"]
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
]
BASE_COLUMNS = [
    "location_id",
    "is_active_location",
    "date",
    "source_name",
    "source_type",
    "source_loaded_at",
    "record_loaded_at",
    *MEASURES,
    "weather_variable_non_null_count",
    *REPLICATION,
    *_PLACE_COLUMNS,
    "country_code",
    "has_location_dimension",
]
LEGACY_DERIVED = [
    "heat_index",
    "wind_chill",
    "vapor_pressure_deficit",
    "growing_degree_days_10c",
    "frost_risk",
    "frost_severity_degrees",
    "heat_stress_risk",
    "drought_stress_risk",
    "fungal_disease_risk",
    "excessive_moisture_risk",
    "critical_null_count",
    "has_high_missing_data",
    "temperature_inconsistent",
    "temperature_outlier",
    "precipitation_outlier",
]
LEGACY_COLUMNS = [
    "location_id",
    "location_name",
    "province_name",
    "latitude",
    "longitude",
    "date",
    "year",
    "month",
    "quarter",
    "week_start",
    "month_start",
    *LEGACY_MEASURES,
    *LEGACY_DERIVED,
    "x_source",
    "x_source_type",
    "loaded_at",
    *REPLICATION,
]


def _number_of_nulls(columns: list[str]) -> str:
    return " + ".join(f"({c} IS NULL)::BIGINT" for c in columns)


def _three_valued(condition: str) -> str:
    return f"CAST({condition} AS BIGINT)"


def _first(order: str, keys: str, source: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


def _unsure_false(condition: str) -> str:
    return f"coalesce({condition}, FALSE)"


# Name -> (names it reads, SELECT).
STEPS: dict[str, tuple[list[str], str]] = {
    "lines": (
        [],
        """SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n,
    CAST(l_extendedprice AS DOUBLE) AS x, CAST(l_shipdate AS TIMESTAMP) AS shipped,
    CAST(l_quantity - 8 + CASE WHEN l_orderkey % 997 = 0 THEN 60 ELSE 0 END AS DOUBLE) AS t,
    CAST(15 + l_partkey % 85 AS DOUBLE) AS rh,
    (l_orderkey % 40) / 4e0 + CASE WHEN l_orderkey % 499 = 0 THEN 55 ELSE 0 END AS w
FROM lineitem""",
    ),
    "stg": (
        ["lines"],
        f"""SELECT {_PLACE},
    CASE WHEN s % 4 = 3 THEN NULL ELSE 'NATION_' || (s % 25) END AS province_key,
    {_DATE} AS date, 'NASA POWER' AS source_name, {_SOURCE_TYPE} AS source_type,
    {_LOADED} AS source_loaded_at,
    {_measures(_CANONICAL)}, {_STAMPS}
FROM lines""",
    ),
    "live": (
        ["stg"],
        f"""SELECT *, coalesce(source_loaded_at, _sdc_extracted_at, _sdc_received_at) AS record_loaded_at,
    {_PRESENT} AS weather_variable_non_null_count
FROM stg WHERE location_id IS NOT NULL AND date IS NOT NULL AND _sdc_deleted_at IS NULL""",
    ),
    "best": (
        ["live"],
        _first(
            newest("weather_variable_non_null_count", *_ORDER, *_TIES), "location_id, date", "live"
        ),
    ),
    "located": (
        [],
        """SELECT s_suppkey AS s, n_name, n_nationkey, r_name FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "loc_versions": (
        ["located"],
        f"""SELECT *, TIMESTAMP '2001-01-01 00:00:00' + to_days(CAST(30 * v AS INTEGER)) + to_hours(s % 24) AS taken,
    {_province("'  Río  ' || n_name || chr(9)")} AS province
FROM located CROSS JOIN (VALUES (1), (2)) AS versions(v)""",
    ),
    "stg_loc": (
        ["loc_versions"],
        f"""SELECT 'loc_' || s AS location_id, 'Estación ' || s || ' ' || v AS location_name,
    province AS province_name, {norm("province")} AS province_key,
    r_name AS department_name, {norm("r_name")} AS department_key,
    CASE WHEN s % 5 = 0 THEN NULL ELSE 'Municipio ' || (s % 17) END AS municipality_name,
    CAST(-21 - (s % 340) / 10e0 AS DOUBLE) AS latitude,
    CAST(-54 - (s % 170) / 10e0 AS DOUBLE) AS longitude,
    CASE WHEN s % 11 = 0 THEN NULL ELSE CAST(s % 2500 AS DOUBLE) END AS elevation_m,
    CASE WHEN s % 9 = 0 THEN NULL ELSE 'AR' END AS country_code,
    CASE WHEN s % 23 = 0 THEN NULL ELSE s % 4 <> 0 END AS is_active,
    'supplier' AS source_catalog, 'catalog' AS source_type,
    CASE WHEN s % 13 = 0 THEN NULL ELSE taken END AS source_loaded_at,
    taken AS _sdc_extracted_at, taken + to_minutes(1) AS _sdc_received_at,
    taken + to_minutes(2) AS _sdc_batched_at,
    CASE WHEN s % 10 = 0 OR s % 21 = 0 OR (s % 7 = 0 AND v = 2) THEN taken END AS _sdc_deleted_at,
    CAST(10 * s + v AS BIGINT) AS _sdc_sequence, CAST(1 AS BIGINT) AS _sdc_table_version
FROM loc_versions""",
    ),
    "loc_ranked": (
        ["stg_loc"],
        _first(
            "CASE WHEN _sdc_deleted_at IS NULL THEN 0 ELSE 1 END, " + newest(*_ORDER),
            "location_id",
            "(SELECT *, coalesce(source_loaded_at, _sdc_extracted_at, _sdc_received_at) "
            "AS record_loaded_at FROM stg_loc)",
        ),
    ),
    "current": (["loc_ranked"], "SELECT * FROM loc_ranked WHERE _sdc_deleted_at IS NULL"),
    "base": (
        ["best", "current"],
        f"""SELECT b.* EXCLUDE ({", ".join(_PLACE_COLUMNS)}),
    {", ".join(f"coalesce(c.{k}, b.{k}) AS {k}" for k in _PLACE_COLUMNS)},
    c.is_active AS is_active_location, coalesce(c.country_code, 'AR') AS country_code,
    c.location_id IS NOT NULL AS has_location_dimension
FROM best AS b LEFT JOIN current AS c ON b.location_id = c.location_id""",
    ),
    "dated": (
        ["base"],
        """SELECT *, CAST(year(date) AS BIGINT) AS calendar_year,
    CAST(month(date) AS BIGINT) AS calendar_month, CAST(quarter(date) AS BIGINT) AS calendar_quarter,
    CAST(date_trunc('week', date) AS DATE) AS week_start,
    CAST(date_trunc('month', date) AS DATE) AS month_start,
    CAST(year(date - INTERVAL 6 MONTH) AS BIGINT) AS campaign_start_year,
    year(date - INTERVAL 6 MONTH) || '/' || (year(date - INTERVAL 6 MONTH) + 1) AS campaign_name
FROM base""",
    ),
    "metrics": (
        ["dated"],
        f"""SELECT *, max_air_temp_c - min_air_temp_c AS temp_range_c,
    solar_radiation_clearsky_mj_m2_day - solar_radiation_allsky_mj_m2_day
        AS clear_sky_radiation_gap_mj_m2_day,
    CASE WHEN avg_air_temp_c IS NULL OR {_RH} IS NULL OR {_TF} < 80 OR {_RH} < 40
        THEN avg_air_temp_c ELSE ({_regression(_TF, _RH)} - 32) * 5 / 9e0 END AS heat_index_c,
    CASE WHEN avg_air_temp_c IS NULL OR wind_speed_mps IS NULL OR avg_air_temp_c > 10
        OR {_KPH} < 4.8e0 THEN avg_air_temp_c
        ELSE {_chill("avg_air_temp_c", _KPH)} END AS wind_chill_c,
    CASE WHEN avg_air_temp_c IS NULL OR dew_point_temp_c IS NULL THEN NULL
        WHEN avg_air_temp_c <= dew_point_temp_c THEN 0e0
        ELSE {_tetens("avg_air_temp_c")} - {_tetens("dew_point_temp_c")} END AS vpd_kpa,
    CASE WHEN max_air_temp_c IS NULL OR min_air_temp_c IS NULL THEN NULL
        WHEN max_air_temp_c + min_air_temp_c < 20 THEN 0e0
        ELSE (max_air_temp_c + min_air_temp_c) / 2 - 10 END AS gdd_base_10_c_days
FROM dated""",
    ),
    "quality": (
        ["metrics"],
        f"""SELECT *, NOT ({" OR ".join(FLAGS)}) AS is_quality_approved
FROM (SELECT *,
    {_number_of_nulls(["avg_air_temp_c", "min_air_temp_c", "max_air_temp_c", "precipitation_mm"])}
        AS critical_null_count,
    weather_variable_non_null_count < 8 AS has_high_missing_data,
    {_unsure_false("min_air_temp_c > max_air_temp_c")} AS temperature_inconsistent,
    {_unsure_false("avg_air_temp_c NOT BETWEEN -50 AND 50")} AS temperature_outlier,
    {_unsure_false("precipitation_mm > 400")} AS precipitation_outlier,
    {_unsure_false("wind_speed_mps > 50")} AS wind_outlier,
    {_unsure_false("solar_radiation_allsky_mj_m2_day > solar_radiation_clearsky_mj_m2_day")}
        AS radiation_inconsistent,
    min_air_temp_c < 0 AS frost_day, max_air_temp_c > 35 AS heat_stress_day,
    precipitation_mm > 25 AS heavy_rain_day,
    CASE WHEN precipitation_mm IS NOT NULL AND {_RH} IS NOT NULL
        THEN precipitation_mm < 1 AND {_RH} < 35 END AS dry_day,
    CASE WHEN {_RH} IS NOT NULL AND avg_air_temp_c IS NOT NULL
        THEN {_RH} >= 80 AND avg_air_temp_c >= 15 AND avg_air_temp_c <= 30
            AND precipitation_mm IS NOT NULL AND precipitation_mm > 0 END AS fungal_risk_day
FROM metrics)""",
    ),
    "partial": (
        ["quality"],
        """SELECT *, critical_null_count > 0 AND date = (SELECT max(date) FROM quality)
    AS is_partial_latest_day FROM quality""",
    ),
    "weather_only": (
        ["best", "current"],
        _first(
            newest("record_loaded_at", "date"),
            "location_id",
            "(SELECT * FROM best WHERE location_id NOT IN (SELECT location_id FROM current))",
        ),
    ),
    "dim_loc": (
        ["current", "weather_only"],
        f"""SELECT {", ".join(LOCATION_COLUMNS)}, record_loaded_at, TRUE AS is_catalog_location FROM current
UNION ALL SELECT location_id, location_name, province_name, province_key, NULL, NULL, NULL,
    latitude, longitude, NULL, 'AR', NULL, 'weather_fallback', source_type, source_loaded_at,
    record_loaded_at, FALSE FROM weather_only""",
    ),
    "fact": (
        ["partial", "dim_loc"],
        """SELECT q.* EXCLUDE (location_name, province_name, province_key),
    coalesce(d.location_name, q.location_name) AS location_name,
    coalesce(d.province_name, q.province_name) AS province_name,
    coalesce(d.province_key, q.province_key) AS province_key
FROM partial AS q LEFT JOIN dim_loc AS d USING (location_id)""",
    ),
    "tax_rows": (
        [],
        f"""SELECT CASE WHEN n_nationkey = 24 THEN '   '
        ELSE upper({_province("'Río ' || n_name")}) END AS province_name,
    min(c_acctbal) AS rural_property_tax_usd_ha_min,
    max(c_acctbal) AS rural_property_tax_usd_ha_max,
    round(avg(c_acctbal), 4) AS rural_property_tax_usd_ha_avg,
    (n_nationkey % 5) * 0.25e0 AS gross_turnover_tax_pct
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""",
    ),
    "tax": (
        ["tax_rows"],
        f"""SELECT *, {norm("province_name")} AS province_key,
    rural_property_tax_usd_ha_max - rural_property_tax_usd_ha_min
        AS rural_property_tax_usd_ha_spread FROM tax_rows""",
    ),
    "yield_rows": (
        [],
        f"""SELECT crop, began, province, n_nationkey, segment, sum(l_quantity) AS sown,
    sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS harvested,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100000 AS tonnes
FROM (SELECT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'soja'
            WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'maíz' ELSE 'trigo' END AS crop,
        CAST(year(o_orderdate - INTERVAL 6 MONTH) AS BIGINT) AS began,
        {_province("'Río ' || n_name")} AS province, n_nationkey, c_mktsegment AS segment,
        l_quantity, l_extendedprice, l_linestatus
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE p_type IN ('ECONOMY', 'MEDIUM', 'SMALL', 'STANDARD', 'LARGE', 'PROMO'))
GROUP BY ALL""",
    ),
    "stg_yields": (
        ["yield_rows"],
        f"""SELECT crop AS crop_name, {norm("crop")} AS crop_key, began + 1 AS harvest_year,
    began || '/' || (began + 1) AS campaign_name, began AS campaign_start_year,
    began + 1 AS campaign_end_year, province AS province_name, {norm("province")} AS province_key,
    CAST(n_nationkey AS VARCHAR) AS province_id, segment AS department_name,
    {norm("segment")} AS department_key, substring(segment, 1, 4) AS department_id,
    sown AS sown_area_ha, harvested AS harvested_area_ha, tonnes AS production_tonnes,
    CASE WHEN harvested > 0 THEN tonnes * 1000 / harvested END AS yield_kg_ha FROM yield_rows""",
    ),
    "yields": (
        ["stg_yields"],
        """SELECT *, production_tonnes * 1000 / nullif(harvested_area_ha, 0) AS yield_kg_ha,
    harvested_area_ha / nullif(sown_area_ha, 0) AS harvested_share_pct
FROM (SELECT crop_name, crop_key, campaign_name, campaign_start_year, campaign_end_year,
        harvest_year, province_name, province_key,
        count(DISTINCT department_id) AS department_count, sum(sown_area_ha) AS sown_area_ha,
        sum(harvested_area_ha) AS harvested_area_ha, sum(production_tonnes) AS production_tonnes
    FROM stg_yields GROUP BY ALL)""",
    ),
    "mentions": (
        ["current", "tax", "yields"],
        """SELECT province_key, province_name, 1 AS rank FROM current
UNION ALL SELECT province_key, province_name, 2 FROM tax
UNION ALL SELECT province_key, province_name, 3 FROM yields""",
    ),
    "coverage": (
        ["mentions"],
        """SELECT province_key, bool_or(rank = 1) AS has_weather_data, bool_or(rank = 2) AS has_tax_data,
    bool_or(rank = 3) AS has_yield_data FROM mentions GROUP BY province_key""",
    ),
    "dim_prov": (
        ["mentions", "coverage"],
        """SELECT province_key, province_name, has_weather_data, has_tax_data, has_yield_data
FROM (SELECT *, row_number() OVER (PARTITION BY province_key ORDER BY rank, province_name) AS rn
    FROM mentions WHERE province_key IS NOT NULL AND province_key <> '')
JOIN coverage USING (province_key) WHERE rn = 1""",
    ),
    "fct_tax": (
        ["tax", "dim_prov"],
        f"""SELECT d.province_name, t.province_key, {", ".join(TAXES)}
FROM tax AS t JOIN dim_prov AS d ON t.province_key = d.province_key""",
    ),
    "fct_yield": (
        ["yields", "dim_prov"],
        """SELECT y.* EXCLUDE (province_name), d.province_name
FROM yields AS y JOIN dim_prov AS d ON y.province_key = d.province_key""",
    ),
    "campaigns": (
        ["fact"],
        """SELECT province_key, campaign_name, campaign_start_year, count(*) AS weather_day_count,
    count(*) FILTER (WHERE is_quality_approved) AS usable_weather_day_count,
    count(DISTINCT location_id) AS weather_location_count,
    sum(precipitation_mm) AS campaign_precipitation_mm, avg(avg_air_temp_c) AS avg_campaign_temp_c,
    max(max_air_temp_c) AS max_campaign_temp_c, min(min_air_temp_c) AS min_campaign_temp_c,
    avg(relative_humidity_pct) AS avg_relative_humidity_pct, avg(vpd_kpa) AS avg_vpd_kpa,
    sum(gdd_base_10_c_days) AS total_gdd_base_10,
    count(*) FILTER (WHERE frost_day) AS frost_days,
    count(*) FILTER (WHERE heat_stress_day) AS heat_days,
    count(*) FILTER (WHERE heavy_rain_day) AS heavy_rain_days,
    count(*) FILTER (WHERE dry_day) AS dry_days,
    count(*) FILTER (WHERE fungal_risk_day) AS fungal_risk_days
FROM fact GROUP BY ALL""",
    ),
    "mart": (
        ["fct_yield", "campaigns", "fct_tax"],
        f"""SELECT y.*, w.* EXCLUDE (province_key, campaign_name, campaign_start_year),
    {", ".join(f"x.{c}" for c in TAXES)},
    w.usable_weather_day_count / CAST(w.weather_day_count AS DOUBLE) AS usable_weather_day_ratio,
    w.weather_day_count IS NOT NULL AS has_weather_campaign_data,
    x.province_key IS NOT NULL AS has_tax_data
FROM fct_yield AS y
LEFT JOIN campaigns AS w ON y.province_key = w.province_key AND y.campaign_name = w.campaign_name
LEFT JOIN fct_tax AS x ON y.province_key = x.province_key""",
    ),
    "ranked": (
        ["fact"],
        _first(
            "CASE WHEN is_quality_approved AND NOT is_partial_latest_day THEN 0 ELSE 1 END, "
            + newest("date", *_ORDER),
            "location_id",
            "fact",
        ),
    ),
    "chosen": (
        ["ranked"],
        """SELECT *, CASE WHEN is_quality_approved AND NOT is_partial_latest_day THEN 'usable'
    ELSE 'fallback' END AS selection_strategy FROM ranked""",
    ),
    "snapshot": (
        ["scored", "dim_loc"],
        f"""SELECT s.* EXCLUDE ({", ".join(_PLACE_COLUMNS)}, country_code, source_type, date),
    s.date AS snapshot_date, {", ".join(f"coalesce(d.{k}, s.{k}) AS {k}" for k in _PLACE_COLUMNS)},
    coalesce(d.country_code, s.country_code, 'AR') AS country_code,
    coalesce(d.is_active, s.is_active_location, TRUE) AS is_active,
    coalesce(s.source_type, d.source_type) AS source_type, d.department_name, d.department_key,
    d.municipality_name, d.elevation_m, d.source_catalog, d.is_catalog_location
FROM scored AS s LEFT JOIN dim_loc AS d ON s.location_id = d.location_id""",
    ),
    "flat": (
        ["lines"],
        f"""SELECT {_PLACE}, CASE WHEN o % 1009 = 0 THEN 'sin fecha'
        WHEN o % 211 = 0 THEN strftime(shipped, '%Y-%-m-%-d')
        ELSE strftime(shipped, '%Y-%m-%d') END AS raw_date,
    {_DATE} AS date, 'NASA POWER' AS x_source, {_SOURCE_TYPE} AS x_source_type,
    {_LOADED} AS loaded_at, {_measures(_LEGACY)}, {_STAMPS}
FROM lines""",
    ),
    "extracts": (
        ["flat"],
        _first(
            newest("_sdc_extracted_at", "_sdc_sequence", *LEGACY_MEASURES),
            "location_id, raw_date",
            "flat",
        ),
    ),
}


def legacy_steps(source: str, prefix: str) -> dict[str, tuple[list[str], str]]:
    """First-generation chain from newest extracts to the daily table."""
    return {
        f"{prefix}derived": (
            [source],
            f"""SELECT *, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
    CAST(quarter(date) AS BIGINT) AS quarter, CAST(date_trunc('week', date) AS DATE) AS week_start,
    CAST(date_trunc('month', date) AS DATE) AS month_start,
    CASE WHEN t2m > 26.7e0 AND relative_humidity_2m IS NOT NULL
        THEN {_regression("t2m", "relative_humidity_2m")} ELSE t2m END AS heat_index,
    CASE WHEN t2m < 10 AND wind_speed_2m IS NOT NULL THEN {_chill("t2m", "wind_speed_2m")}
        ELSE t2m END AS wind_chill,
    {_magnus("t2m_dew")} - {_magnus("t2m")} AS vapor_pressure_deficit,
    CASE WHEN t2m IS NULL OR t2m_min IS NULL OR t2m_max IS NULL THEN NULL
        WHEN t2m_max + t2m_min < 20 THEN 0e0
        ELSE (t2m_max + t2m_min) / 2 - 10 END AS growing_degree_days_10c,
    {_three_valued("t2m_min < 0")} AS frost_risk,
    CASE WHEN t2m_min IS NOT NULL THEN abs(least(t2m_min, 0e0)) END AS frost_severity_degrees,
    {_three_valued("t2m_max > 35")} AS heat_stress_risk,
    {_three_valued("relative_humidity_2m < 30")} AS drought_stress_risk,
    CASE WHEN relative_humidity_2m IS NOT NULL AND t2m IS NOT NULL
        THEN {_three_valued("relative_humidity_2m > 80 AND t2m > 15")} END AS fungal_disease_risk,
    {_three_valued("precipitation_corrected > 25")} AS excessive_moisture_risk,
    {_number_of_nulls(["t2m", "t2m_min", "t2m_max", "precipitation_corrected"])}
        AS critical_null_count,
    {_three_valued("(" + _number_of_nulls(["t2m", "t2m_min", "t2m_max", "t2m_dew", "soil_temperature", "precipitation_corrected", "relative_humidity_2m", "wind_speed_2m"]) + ") > 4")}
        AS has_high_missing_data,
    {_three_valued(_unsure_false("t2m_max < t2m_min"))} AS temperature_inconsistent,
    {_three_valued(_unsure_false("t2m NOT BETWEEN -50 AND 50"))} AS temperature_outlier,
    {_three_valued(_unsure_false("precipitation_corrected > 400"))} AS precipitation_outlier
FROM {source}""",
        ),
        f"{prefix}daily": (
            [f"{prefix}derived"],
            f"SELECT * FROM {prefix}derived WHERE location_id IS NOT NULL AND date IS NOT NULL",
        ),
    }


STEPS.update(legacy_steps("extracts", "legacy_"))

def with_scores(name: str, source: str) -> dict[str, tuple[list[str], str]]:
    """The steps plus one that scores the rows of `source`."""
    body = f"""SELECT *, round((climate_rain_signal + climate_water_stress_signal
    + climate_temperature_signal) / 300, 4) AS climate_index_total
FROM (SELECT *,
    CASE WHEN precipitation_mm >= 25 THEN 100e0
        ELSE round(coalesce(precipitation_mm, 0) / 25 * 100, 2) END AS climate_rain_signal,
    round(least(100e0,
        CASE WHEN vpd_kpa IS NULL THEN 0 ELSE least(greatest(vpd_kpa, 0), 4) / 4 * 60 END
        + CASE WHEN relative_humidity_pct IS NULL THEN 0
            ELSE (100 - least(greatest(relative_humidity_pct, 0), 100)) * 0.25e0 END
        + CASE WHEN dry_day THEN 15 ELSE 0 END), 2) AS climate_water_stress_signal,
    round(least(100e0, CASE WHEN heat_stress_day THEN 50 ELSE 0 END
        + CASE WHEN frost_day THEN 50 ELSE 0 END
        + CASE WHEN temp_range_c IS NULL THEN 0
            ELSE least(greatest(temp_range_c, 0), 20) / 20 * 25 END
        + CASE WHEN max_air_temp_c >= 30 THEN 15 ELSE 0 END
        + CASE WHEN min_air_temp_c <= 2 THEN 10 ELSE 0 END), 2) AS climate_temperature_signal
FROM {source})"""
    return {**STEPS, name: ([source], body)}


STEPS = with_scores("scored", "chosen")


def with_corrections() -> dict[str, tuple[list[str], str]]:
    """The steps plus the first-generation rows of a later batch of corrections."""
    return {
        **STEPS,
        "corr_flat": (
            ["flat"],
            """SELECT * REPLACE (40e0 AS t2m_max, _sdc_extracted_at + INTERVAL 3 YEAR AS _sdc_extracted_at)
FROM flat WHERE year(_sdc_extracted_at) = 2000 AND (_sdc_sequence // 10) % 50 = 0""",
        ),
        "corr_extracts": (
            ["corr_flat"],
            _first(
                newest("_sdc_extracted_at", "_sdc_sequence", *LEGACY_MEASURES),
                "location_id, raw_date",
                "corr_flat",
            ),
        ),
        **legacy_steps("corr_extracts", "corr_"),
    }



def chain(*wanted: str, steps: dict[str, tuple[list[str], str]] = STEPS) -> str:
    """WITH clause holding the wanted steps and everything they read, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dependency in steps[name][0]:
                visit(dependency)
            ordered.append(name)

    for name in wanted:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({steps[n][1]})" for n in ordered) + "\n"


def cut(value: str) -> str:
    return f"CAST(floor({value} * 1e6 + {CUT}e0) / 1e6 AS DOUBLE)"


def columns(names: list[str]) -> str:
    return ", ".join(f"{cut(n)} AS {n}" if n in ROUNDED else n for n in names)


def select(step: str, names: list[str], where: str = "", also: list[str] | None = None) -> str:
    tail = f" WHERE {where}" if where else ""
    return chain(step, *(also or [])) + f"SELECT {columns(names)} FROM {step}{tail}"


def suite(declared: dict, relations: dict[str, str]) -> str:
    """Failures of every declared check, each counted by itself."""
    counts = []
    for relation, step in relations.items():
        for check in declared[relation]:
            if hasattr(check, "holds"):
                label = check.label
                count = f"count(*) FILTER (WHERE ({check.where}) AND NOT ({check.holds})) FROM {step}"
            elif hasattr(check, "columns"):
                label = f"unique {', '.join(check.columns)}"
                keys = ", ".join(check.columns)
                lone = f"WHERE {keys} IS NOT NULL" if len(check.columns) == 1 else ""
                count = f"count(*) FROM (SELECT 1 FROM {step} {lone} GROUP BY {keys} HAVING count(*) > 1)"
            else:
                label, key = f"known {check.column}", check.column
                count = (
                    f"count(DISTINCT {key}) FROM {step} AS c WHERE NOT EXISTS "
                    f"(SELECT 1 FROM {relations[check.parent]} AS p WHERE p.{key} = c.{key})"
                )
            counts.append(f"SELECT '{relation}' AS relation, '{label}' AS \"check\", {count}")
    head = chain(*dict.fromkeys(relations.values()))
    return head + "SELECT relation, \"check\", n AS failures FROM (" + "\nUNION ALL ".join(counts) + ") AS t(relation, \"check\", n)"


def documented(relations: dict[str, str]) -> str:
    """The comments set on stored relations, and how many rows these hold."""
    listed = []
    names = {"dim_loc": [*LOCATION_COLUMNS, "record_loaded_at", "is_catalog_location"], "legacy_daily": LEGACY_COLUMNS}
    for step, relation in relations.items():
        for name in names[step]:
            if name in COMMENTS:
                listed.append(
                    f"SELECT '{relation}' AS relation, '{RELATIONS[relation]}' AS relation_comment, "
                    f"'{name}' AS \"column\", '{COMMENTS[name]}' AS column_comment, "
                    f"(SELECT count(*) FROM {step}) AS row_count"
                )
    return chain(*relations) + "\nUNION ALL ".join(listed)
