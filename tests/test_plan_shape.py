"""Physical plans: what must be in them at scale, and what must not."""

import re

import pytest

from pampero import session
from pampero.operators.incremental import new_rows
from pampero.plans import marts, weather
from pampero.plans.models import Models, lazy, locations_only
from pampero.sources import adapter
from pampero.sources.raw import read_raw
from pampero.sources.schemas import RAW_WEATHER
from verification.catalog import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def models(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return Models(
        lambda: adapter.raw_weather(spark, DATA, "flat"),
        lambda: adapter.raw_locations(spark, DATA),
        keep=lazy,
    )


def test_best_row_is_limited_before_the_shuffle(models):
    text = physical(models.best_weather)
    partial, exchange, final = (
        text.rindex("WindowGroupLimit"),
        text.index("Exchange hashpartitioning(location_id"),
        text.index("WindowGroupLimit"),
    )
    assert final < exchange < partial and "Partial" in text[partial:].splitlines()[0]


def test_splits_are_small_enough_to_sort_in_memory(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, kept in (("128m", str(session.SPLIT_BYTES)), ("1m", "1m")):
            spark.conf.set(key, given)
            session.prepare(spark)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)


def test_unlisted_locations_are_told_before_days_are_ranked(models):
    # Plans are printed from the last step to the first.
    text = physical(models.weather_only)
    by_day = re.search(r"WindowGroupLimit \[location_id#\d+, date#\d+\]", text).start()
    assert text.rindex("LeftAnti") > by_day


def test_days_are_not_shuffled_to_find_unlisted_locations(spark):
    sources = lambda: adapter.raw_weather(spark, DATA, "flat"), lambda: adapter.raw_locations(spark, DATA)
    text = physical(Models(*sources, keep=locations_only).weather_only)
    by_day = re.search(r"WindowGroupLimit \[location_id#\d+, date#\d+\]", text).start()
    below = text[by_day:]
    assert below.count("Exchange hashpartitioning(") == 1
    assert below.index("LeftAnti") > below.index("Exchange hashpartitioning(")
    assert "BroadcastHashJoin" in below


def read_columns(df) -> str:
    return re.search(r"ReadSchema: struct<(.*)>", physical(df)).group(1)


def test_one_metric_reads_only_its_columns(spark, models, tmp_path):
    picked = ["_sdc_sequence", "precipitation_mm"]
    derived = read_columns(models.stg_weather.select(*picked))
    assert "l_extendedprice" in derived and "l_quantity" not in derived
    # The same from a stored table with a struct payload: one member of it is fetched.
    raw = str(tmp_path / "raw")
    adapter.raw_weather(spark, DATA).write.parquet(raw)
    stored = Models(read_raw(spark, raw, RAW_WEATHER), read_raw(spark, raw, RAW_WEATHER))
    columns = read_columns(stored.stg_weather.select(*picked))
    assert columns == "_sdc_sequence:bigint,data:struct<PRECTOTCORR:string>"


def test_high_water_mark_reaches_the_scan(spark, tmp_path):
    raw = str(tmp_path / "raw")
    adapter.raw_weather(spark, DATA).write.parquet(raw)
    source = read_raw(spark, raw, RAW_WEATHER)
    newer = new_rows(source, source.filter("_sdc_sequence < 1000"), "_sdc_extracted_at")
    assert "GreaterThan(_sdc_extracted_at" in physical(newer)


def test_json_is_parsed_once_per_row(spark):
    raw = adapter.raw_weather(spark, DATA, "json")
    staged = Models(raw, raw, keep=lazy).stg_weather
    text = weather.counted_rows(staged)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField(location_id,StringType") == 1
    # The others read one member each, in a branch for values that begin like an object or array.
    assert text.count("from_json(") - 1 == text.count("VariantType") > 0
    asked = [m.start() for m in re.finditer(r"SchemaOfVariant.schemaOfVariant\(", text)]
    assert asked and all("THEN CASE WHEN" in text[at - 120 : at] for at in asked)


def test_no_python_runs_per_row(models):
    for df in [models.weather_quality, models.dim_location]:
        assert "Python" not in physical(df) and "ArrowEval" not in physical(df)


def test_anti_join_is_one(models):
    assert "LeftAnti" in physical(models.weather_only)


def test_only_single_rows_meet_without_a_key(models):
    text = models.weather_quality._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Cross") == 1
    assert "latest_date" in text


def test_the_largest_province_is_summed_by_location_first(spark, models):
    text = re.sub(r"#\d+L?", "", physical(marts.weather_by_campaign(models.fct_weather)))
    exchange = text.index("Exchange hashpartitioning(province_key, campaign_name")
    by_location = "keys=[province_key, campaign_name, campaign_start_year, location_id]"
    assert by_location in text[exchange:] and by_location not in text[:exchange]


def test_nothing_is_broadcast_by_hint_but_single_rows():
    from pathlib import Path

    package = Path(__file__).resolve().parents[1] / "pampero"
    hints = [
        line.strip()
        for path in package.rglob("*.py")
        for line in path.read_text(encoding="utf-8").splitlines()
        if "F.broadcast(" in line and "llm" not in path.parts
    ]
    assert len(hints) == 2  # newest day, one count


def test_every_query_has_sql():
    from verification.catalog import ORACLES

    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 55
