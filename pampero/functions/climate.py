"""Daily agro-climate metrics, quality and risk flags, and map scores.

Every formula is a plain column expression: no Python runs per row, and whole-stage code
generation covers all of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pampero.functions.safe import at_least, clamp, safe_divide, strict_least

# Rothfusz heat-index regression, coefficient of T^row * R^column
# (T in Fahrenheit, R in percent).
HEAT_INDEX_COEFFICIENTS = [
    [-42.379, 10.14333127, -0.05481717],
    [2.04901523, -0.22475541, 0.00085282],
    [-0.00683783, 0.00122874, -0.00000199],
]
HEAT_INDEX_MIN_F = 80.0
HEAT_INDEX_MIN_HUMIDITY = 40.0

# Wind-chill formula (Celsius, km/h).
WIND_CHILL_BASE = 13.12
WIND_CHILL_TEMP = 0.6215
WIND_CHILL_WIND = 11.37
WIND_CHILL_BOTH = 0.3965
WIND_CHILL_EXPONENT = 0.16
WIND_CHILL_MAX_C = 10.0
WIND_CHILL_MIN_KPH = 4.8

# Tetens saturation vapour pressure (kPa, Celsius).
TETENS_SCALE = 0.6108
TETENS_SLOPE = 17.27
TETENS_OFFSET = 237.3


def heat_index_polynomial(temp: Column, humidity: Column) -> Column:
    """Heat-index regression, nested so that no power function is called."""
    total = None
    for row in reversed(HEAT_INDEX_COEFFICIENTS):
        c0, c1, c2 = (F.lit(c) for c in row)
        in_humidity = c0 + humidity * (c1 + humidity * c2)
        total = in_humidity if total is None else in_humidity + temp * total
    return total


def heat_index(temp_c: Column, humidity: Column) -> Column:
    """Felt temperature in heat, in Celsius; the air temperature itself below the thresholds."""
    temp_f = temp_c * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)
    hot_and_humid = (temp_f >= HEAT_INDEX_MIN_F) & (humidity >= HEAT_INDEX_MIN_HUMIDITY)
    felt = (heat_index_polynomial(temp_f, humidity) - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
    return F.when(hot_and_humid, felt).otherwise(temp_c)


def wind_chill_formula(temp_c: Column, wind: Column) -> Column:
    force = F.pow(wind, F.lit(WIND_CHILL_EXPONENT))
    return (
        F.lit(WIND_CHILL_BASE)
        + F.lit(WIND_CHILL_TEMP) * temp_c
        + force * (F.lit(WIND_CHILL_BOTH) * temp_c - F.lit(WIND_CHILL_WIND))
    )


def wind_chill(temp_c: Column, wind_mps: Column) -> Column:
    """Felt temperature in cold wind, in Celsius; the air temperature outside the thresholds."""
    wind_kph = wind_mps * F.lit(3.6)
    cold_and_windy = (temp_c <= WIND_CHILL_MAX_C) & (wind_kph >= WIND_CHILL_MIN_KPH)
    return F.when(cold_and_windy, wind_chill_formula(temp_c, wind_kph)).otherwise(temp_c)


def saturation_pressure(temp_c: Column) -> Column:
    exponent = safe_divide(F.lit(TETENS_SLOPE) * temp_c, temp_c + F.lit(TETENS_OFFSET))
    return F.lit(TETENS_SCALE) * F.exp(exponent)


def vapour_pressure_deficit(temp_c: Column, dew_c: Column) -> Column:
    """Drying power of the air in kPa, never negative."""
    return at_least(saturation_pressure(temp_c) - saturation_pressure(dew_c), 0.0)


def growing_degree_days(max_c: Column, min_c: Column, base_c: float = 10.0) -> Column:
    return at_least((max_c + min_c) / F.lit(2.0) - F.lit(base_c), 0.0)


# --- quality and risk -----------------------------------------------------------------

CRITICAL_MEASURES = ["avg_air_temp_c", "min_air_temp_c", "max_air_temp_c", "precipitation_mm"]
REQUIRED_MEASURES = 8


def _certainly(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def quality_flags() -> dict[str, Column]:
    """Reasons to distrust a day; never NULL."""
    temp = F.col("avg_air_temp_c")
    return {
        "has_high_missing_data": _certainly(
            F.col("weather_variable_non_null_count") < REQUIRED_MEASURES
        ),
        "temperature_inconsistent": _certainly(
            F.col("min_air_temp_c") > F.col("max_air_temp_c")
        ),
        "temperature_outlier": _certainly(F.abs(temp) > 50),
        "precipitation_outlier": _certainly(F.col("precipitation_mm") > 400),
        "wind_outlier": _certainly(F.col("wind_speed_mps") > 50),
        "radiation_inconsistent": _certainly(
            F.col("solar_radiation_allsky_mj_m2_day")
            > F.col("solar_radiation_clearsky_mj_m2_day")
        ),
    }


def risk_flags() -> dict[str, Column]:
    """Agronomic risks of a day; NULL where the inputs do not say."""
    rain, humidity, temp = (
        F.col("precipitation_mm"),
        F.col("relative_humidity_pct"),
        F.col("avg_air_temp_c"),
    )
    fungal = (humidity >= 80) & temp.between(15, 30) & (F.coalesce(rain, F.lit(0.0)) > 0)
    dry = (rain < 1) & (humidity < 35)
    return {
        "frost_day": F.col("min_air_temp_c") < 0,
        "heat_stress_day": F.col("max_air_temp_c") > 35,
        "heavy_rain_day": rain > 25,
        # SQL's AND is false when either side is false, so unknown inputs are masked first.
        "dry_day": F.when(rain.isNotNull() & humidity.isNotNull(), dry),
        "fungal_risk_day": F.when(humidity.isNotNull() & temp.isNotNull(), fungal),
    }


# --- map scores -----------------------------------------------------------------------


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def _known(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def rain_signal(rain: Column) -> Column:
    """0 for a dry day, 100 from 25 mm on."""
    return strict_least(F.round(_known(rain) / F.lit(25.0) * F.lit(100.0), 2), F.lit(100.0))


def water_stress_signal(vpd: Column, humidity: Column, dry_day: Column) -> Column:
    """Air dryness: up to 60 points by vapour deficit, 25 by humidity, 15 for a dry day."""
    by_deficit = clamp(vpd, 0.0, 4.0) / F.lit(4.0) * F.lit(60.0)
    by_humidity = (F.lit(100.0) - clamp(humidity, 0.0, 100.0)) * F.lit(0.25)
    points = _known(by_deficit) + _known(by_humidity) + _points(dry_day, 15.0)
    return F.round(strict_least(F.lit(100.0), points), 2)


def temperature_signal(
    heat_day: Column, frost_day: Column, spread: Column, max_c: Column, min_c: Column
) -> Column:
    """Thermal stress: heat and frost 50 points each, spread up to 25, extremes 15 and 10."""
    points = (
        _points(heat_day, 50.0)
        + _points(frost_day, 50.0)
        + _known(clamp(spread, 0.0, 20.0) / F.lit(20.0) * F.lit(25.0))
        + _points(max_c >= 30, 15.0)
        + _points(min_c <= 2, 10.0)
    )
    return F.round(strict_least(F.lit(100.0), points), 2)


def climate_index(rain: Column, water: Column, temperature: Column) -> Column:
    """Mean of the three signals on a 0-1 scale."""
    return F.round((rain + water + temperature) / F.lit(300.0), 4)


