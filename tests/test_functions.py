"""Hand-computed rows for every formula, with their NULL cases."""

import math

import pytest
from pyspark.sql import functions as F

from pampero.functions import climate, legacy, safe
from pampero.functions.calendar import with_calendar
from pampero.functions.text import normalize_text
from pampero.plans.weather import METRICS, approved, with_quality_flags
from pampero.sources.schemas import MEASURES, WEATHER_VARIABLES


def values(spark, data, schema, *columns):
    """Rows of the columns, in the order given."""
    rows = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(data)], f"i int, {schema}"
    ).select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)])
    return [tuple(r)[1:] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def column(spark, data, schema, expression):
    return [r[0] for r in values(spark, data, schema, expression)]


def test_normalize_text(spark):
    texts = ["\t Córdoba  del  Sur\n", " ñandú ", None, "", "Tucumán", "São\tPaulo"]
    assert column(spark, [(t,) for t in texts], "t string", normalize_text(F.col("t"))) == [
        "CORDOBA DEL SUR",
        "NANDU",
        None,
        "",
        "TUCUMAN",
        "SAO PAULO",
    ]


def test_safe_double(spark):
    texts = ["1.5", " -2e3 ", "abc", "1.5d", "2F", "NaN", "", None, '{"a":1}', "inf"]
    assert column(spark, [(t,) for t in texts], "t string", safe.safe_double(F.col("t"))) == [
        1.5,
        -2000.0,
        None,
        None,
        None,
        None,
        None,
        None,
        None,
        math.inf,
    ]


def test_safe_casts_are_stricter_than_try_cast(spark):
    t = F.col("t")
    rows = values(
        spark,
        [("2024",), ("2024-1-1",), ("2024-02-30",), ("yes",), ("TRUE",), ("false",), ("12",), ("12.7",)],
        "t string",
        safe.safe_date(t).cast("string"),
        safe.safe_bool(t),
        safe.safe_long(t),
    )
    assert rows == [
        (None, None, 2024),
        ("2024-01-01", None, None),
        (None, None, None),
        (None, None, None),
        (None, True, None),
        (None, False, None),
        (None, None, 12),
        (None, None, None),
    ]
    stamps = ["2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "2024", "10:00", None]
    assert column(
        spark, [(s,) for s in stamps], "t string", safe.safe_timestamp(t).cast("string")
    ) == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None, None, None]


def test_strict_extremes_are_null_when_an_argument_is(spark):
    a, b = F.col("a"), F.col("b")
    rows = values(
        spark,
        [(1.0, 2.0), (None, 0.0), (5.0, None)],
        "a double, b double",
        safe.strict_greatest(a, b),
        safe.strict_least(a, b),
        safe.clamp(a, 0.0, 2.0),
        safe.safe_divide(a, F.lit(0.0)),
    )
    assert rows == [(2.0, 1.0, 1.0, None), (None, None, None, None), (None, None, 2.0, None)]


def test_campaign_starts_in_july(spark):
    dates = [("2020-06-30",), ("2020-07-01",), ("2024-06-02",), (None,)]
    df = spark.createDataFrame(dates, "d string").select(F.col("d").cast("date").alias("date"))
    rows = {str(r["date"]): r for r in with_calendar(df).collect()}
    assert rows["2020-06-30"]["campaign_name"] == "2019/2020"
    assert rows["2020-06-30"]["campaign_start_year"] == 2019
    assert rows["2020-07-01"]["campaign_name"] == "2020/2021"
    assert str(rows["2024-06-02"]["week_start"]) == "2024-05-27"
    assert str(rows["2024-06-02"]["month_start"]) == "2024-06-01"
    assert rows["2024-06-02"]["calendar_quarter"] == 2
    assert rows["None"]["campaign_name"] is None


# The published heat index regression.
def rothfusz(t, r):
    return (
        -42.379
        + 2.04901523 * t
        + 10.14333127 * r
        - 0.22475541 * t * r
        - 0.00683783 * t**2
        - 0.05481717 * r**2
        + 0.00122874 * t**2 * r
        + 0.00085282 * t * r**2
        - 0.00000199 * t**2 * r**2
    )


def test_heat_index(spark):
    got = column(
        spark,
        [(35.0, 60.0), (35.0, None), (None, 60.0), (35.0, 39.0), (20.0, 90.0), (35.0, 40.0)],
        "t double, r double",
        climate.heat_index(F.col("t"), F.col("r")),
    )
    assert got[0] == pytest.approx((rothfusz(95.0, 60.0) - 32) * 5 / 9)
    assert got[1:5] == [35.0, None, 35.0, 20.0]
    assert got[5] == pytest.approx((rothfusz(95.0, 40.0) - 32) * 5 / 9)


def test_wind_chill(spark):
    got = column(
        spark,
        [(0.0, 10.0), (10.0, 0.5), (10.0, 5.0), (11.0, 9.0), (None, 9.0), (5.0, None)],
        "t double, v double",
        climate.wind_chill(F.col("t"), F.col("v")),
    )

    def chill(t, kph):
        return 13.12 + 0.6215 * t - 11.37 * kph**0.16 + 0.3965 * t * kph**0.16

    assert got[0] == pytest.approx(chill(0.0, 36.0))
    assert got[1] == 10.0
    assert got[2] == pytest.approx(chill(10.0, 18.0))
    assert got[3:] == [11.0, None, 5.0]


def test_vapour_pressure_deficit(spark):
    got = column(
        spark,
        [(20.0, 10.0), (10.0, 20.0), (None, 1.0), (1.0, None), (-237.3, 1.0)],
        "t double, d double",
        climate.vapour_pressure_deficit(F.col("t"), F.col("d")),
    )

    def es(x):
        return 0.6108 * math.exp(17.27 * x / (x + 237.3))

    assert got[0] == pytest.approx(es(20) - es(10))
    assert got[1:] == [0.0, None, None, None]


def test_growing_degree_days(spark):
    got = column(
        spark,
        [(30.0, 10.0), (10.0, 2.0), (None, 5.0), (5.0, None)],
        "a double, b double",
        climate.growing_degree_days(F.col("a"), F.col("b")),
    )
    assert got == [10.0, 0.0, None, None]


SCORE_INPUT = (
    "precipitation_mm double, vpd_kpa double, relative_humidity_pct double, dry_day boolean"
)


def test_rain_and_water_signals(spark):
    got = values(
        spark,
        [
            (None, 2.0, None, False),
            (10.0, None, 40.0, False),
            (100.0, 9.0, 20.0, True),
            (0.0, None, None, None),
            (5.0, 4.0, 0.0, True),
        ],
        SCORE_INPUT,
        climate.rain_signal(F.col("precipitation_mm")),
        climate.water_stress_signal(
            F.col("vpd_kpa"), F.col("relative_humidity_pct"), F.col("dry_day")
        ),
    )
    assert got == [(0.0, 30.0), (40.0, 15.0), (100.0, 95.0), (0.0, 0.0), (20.0, 100.0)]


def test_temperature_signal_and_index(spark):
    got = column(
        spark,
        [
            (True, False, 15.0, 40.0, 25.0),
            (False, True, 30.0, 10.0, -20.0),
            (None, None, None, None, None),
            (True, True, 40.0, 38.0, -2.0),
        ],
        "h boolean, f boolean, s double, hi double, lo double",
        climate.temperature_signal(*[F.col(c) for c in ["h", "f", "s", "hi", "lo"]]),
    )
    assert got == [50 + 18.75 + 15, 50 + 25 + 10.0, 0.0, 100.0]
    index = climate.climate_index(F.lit(40.0), F.lit(15.0), F.lit(83.75))
    assert spark.range(1).select(index).first()[0] == 0.4625


WEATHER_SCHEMA = ", ".join(f"{m} double" for m in MEASURES)


def weather_rows(spark, *rows):
    """Rows given as {measure: value}; the others are NULL."""
    data = [[float(r[m]) if r.get(m) is not None else None for m in MEASURES] for r in rows]
    present = F.lit(0)
    for m in MEASURES:
        present = present + F.col(m).isNotNull().cast("int")
    return spark.createDataFrame(data, WEATHER_SCHEMA).withColumn(
        "weather_variable_non_null_count", present
    )


def test_seven_measures_are_too_few(spark):
    full = {m: 1.0 for m in MEASURES}
    seven = dict(list(full.items())[:7])
    rows = with_quality_flags(weather_rows(spark, full, seven)).withColumn("ok", approved())
    assert [(r["has_high_missing_data"], r["ok"]) for r in rows.collect()] == [
        (False, True),
        (True, False),
    ]


def test_risk_flags_keep_unknown(spark):
    rows = weather_rows(
        spark,
        {"avg_air_temp_c": 20, "relative_humidity_pct": 85},
        {"avg_air_temp_c": 20, "relative_humidity_pct": 85, "precipitation_mm": 1},
        {"precipitation_mm": 5},
        {"precipitation_mm": 0, "relative_humidity_pct": 20, "min_air_temp_c": -1},
    )
    got = rows.select(*[c.alias(n) for n, c in climate.risk_flags().items()]).collect()
    assert [(r["heavy_rain_day"], r["fungal_risk_day"], r["dry_day"]) for r in got] == [
        (None, False, None),
        (False, True, False),
        (False, None, None),
        (False, None, True),
    ]
    assert [r["frost_day"] for r in got] == [None, None, None, True]


def legacy_frame(spark, *rows):
    names = [old for _, _, old, _ in WEATHER_VARIABLES]
    data = [[float(r[n]) if r.get(n) is not None else None for n in names] for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))


def test_legacy_formulas(spark):
    df = legacy_frame(
        spark,
        {"t2m": 30, "t2m_min": 20, "relative_humidity_2m": 50, "wind_speed_2m": 2, "t2m_dew": 10},
        {"t2m": 5, "t2m_min": -3, "t2m_max": 13, "wind_speed_2m": 4, "precipitation_corrected": 26},
        {"t2m_max": 40, "t2m_min": 10},
        {"t2m": 16, "relative_humidity_2m": 81},
    )
    a, b, c, d = df.withColumns(
        {**legacy.metrics(), **legacy.risk_flags(), **legacy.quality()}
    ).collect()

    def magnus(x):
        return 6.1094 * math.exp(17.625 * x / (x + 243.04))

    assert a["heat_index"] == pytest.approx(rothfusz(30.0, 50.0))
    assert a["vapor_pressure_deficit"] == pytest.approx(magnus(10) - magnus(30))
    assert a["growing_degree_days_10c"] is None  # no maximum: unknown, not zero
    assert b["wind_chill"] == pytest.approx(
        13.12 + 0.6215 * 5 - 11.37 * 4**0.16 + 0.3965 * 5 * 4**0.16
    )
    assert (b["frost_risk"], b["frost_severity_degrees"], b["excessive_moisture_risk"]) == (1, 3, 1)
    assert b["growing_degree_days_10c"] == 0.0
    assert c["growing_degree_days_10c"] is None  # no mean: the guard asks for it
    assert (c["heat_stress_risk"], c["frost_severity_degrees"], c["frost_risk"]) == (1, 0, 0)
    assert (c["critical_null_count"], c["has_high_missing_data"]) == (2, 1)
    assert (d["fungal_disease_risk"], d["drought_stress_risk"], d["heat_stress_risk"]) == (1, 0, None)


def test_generations_differ(spark):
    t, r = 30.0, 50.0
    new = column(spark, [(t, r)], "t double, r double", climate.heat_index(F.col("t"), F.col("r")))
    old = legacy_frame(spark, {"t2m": t, "relative_humidity_2m": r}).select(legacy.heat_index())
    assert abs(new[0] - old.first()[0]) > 1


def test_metric_names_cover_the_table():
    assert list(METRICS) == [
        "temp_range_c",
        "clear_sky_radiation_gap_mj_m2_day",
        "heat_index_c",
        "wind_chill_c",
        "vpd_kpa",
        "gdd_base_10_c_days",
    ]
