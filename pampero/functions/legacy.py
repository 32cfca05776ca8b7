"""First-generation formulas, kept apart because they give other numbers than `climate`.

They use the same names with different maths (units, thresholds, signs). Results must stay
as they are for users of the older daily table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pampero.functions.climate import heat_index_polynomial, wind_chill_formula
from pampero.functions.safe import at_least, null_count, safe_divide

# Magnus vapour pressure in hPa.
MAGNUS_SCALE = 6.1094
MAGNUS_SLOPE = 17.625
MAGNUS_OFFSET = 243.04

CRITICAL_MEASURES = ["t2m", "t2m_min", "t2m_max", "precipitation_corrected"]
WATCHED_MEASURES = [
    *CRITICAL_MEASURES,
    "t2m_dew",
    "soil_temperature",
    "relative_humidity_2m",
    "wind_speed_2m",
]


def heat_index() -> Column:
    """The Fahrenheit regression fed with Celsius, above 26.7 degrees."""
    temp, humidity = F.col("t2m"), F.col("relative_humidity_2m")
    applies = (temp > 26.7) & humidity.isNotNull()
    return F.when(applies, heat_index_polynomial(temp, humidity)).otherwise(temp)


def wind_chill() -> Column:
    """The km/h formula fed with m/s, below 10 degrees and without a minimum wind."""
    temp, wind = F.col("t2m"), F.col("wind_speed_2m")
    applies = (temp < 10) & wind.isNotNull()
    return F.when(applies, wind_chill_formula(temp, wind)).otherwise(temp)


def _magnus(temp: Column) -> Column:
    exponent = safe_divide(F.lit(MAGNUS_SLOPE) * temp, temp + F.lit(MAGNUS_OFFSET))
    return F.lit(MAGNUS_SCALE) * F.exp(exponent)


def vapour_pressure_deficit() -> Column:
    """Dew-point pressure minus air pressure in hPa: negative for dry air, not clamped."""
    return _magnus(F.col("t2m_dew")) - _magnus(F.col("t2m"))


def growing_degree_days() -> Column:
    """NULL also when the mean temperature is missing, though it does not enter the sum."""
    days = at_least((F.col("t2m_max") + F.col("t2m_min")) / F.lit(2.0) - F.lit(10.0), 0.0)
    return F.when(F.col("t2m").isNotNull(), days)


def _flag(condition: Column) -> Column:
    """1, 0, or NULL where the condition is unknown."""
    return condition.cast("bigint")


def metrics() -> dict[str, Column]:
    return {
        "heat_index": heat_index(),
        "wind_chill": wind_chill(),
        "vapor_pressure_deficit": vapour_pressure_deficit(),
        "growing_degree_days_10c": growing_degree_days(),
    }


def risk_flags() -> dict[str, Column]:
    low, humidity, temp = F.col("t2m_min"), F.col("relative_humidity_2m"), F.col("t2m")
    # Unlike the canonical flag, a missing input always leaves this one unknown.
    fungal = F.when(humidity.isNotNull() & temp.isNotNull(), (humidity > 80) & (temp > 15))
    return {
        "frost_risk": _flag(low < 0),
        "frost_severity_degrees": F.when(low < 0, F.abs(low)).when(low >= 0, F.lit(0.0)),
        "heat_stress_risk": _flag(F.col("t2m_max") > 35),
        "drought_stress_risk": _flag(humidity < 30),
        "fungal_disease_risk": _flag(fungal),
        "excessive_moisture_risk": _flag(F.col("precipitation_corrected") > 25),
    }


def quality() -> dict[str, Column]:
    def certain(condition: Column) -> Column:
        return F.coalesce(_flag(condition), F.lit(0).cast("bigint"))

    return {
        "critical_null_count": null_count(CRITICAL_MEASURES),
        "has_high_missing_data": certain(null_count(WATCHED_MEASURES) > 4),
        "temperature_inconsistent": certain(F.col("t2m_max") < F.col("t2m_min")),
        "temperature_outlier": certain(F.abs(F.col("t2m")) > 50),
        "precipitation_outlier": certain(F.col("precipitation_corrected") > 400),
    }
