"""The model graph, its stored form, export and streaming."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pampero.operators import incremental, monthly
from pampero.plans import legacy, marts, staging, weather
from pampero.plans.models import Models, lazy
from pampero.plans.suite import SUITE, Row, run_suite
from pampero.sinks import export, tables
from pampero.sources import adapter
from pampero.streaming import upsert as streaming
from pampero.workspace import new_path, shared_folder
from test_operators import FULL, location, raw_readings, reading, rows
from pampero.sources.schemas import RAW_LOCATIONS

DATA = "/root/testdata/sf0.001"


def small(spark, *readings, locations=()):
    raw = spark.createDataFrame(list(locations), RAW_LOCATIONS)
    return Models(raw_readings(spark, *readings), raw, keep=lazy)


def test_partial_day_falls_back_to_an_older_usable_one(spark):
    partial = {**FULL}
    del partial["PRECTOTCORR"]
    models = small(
        spark,
        reading("a", "2024-06-02", 2, **partial),
        reading("a", "2024-06-01", 1, **FULL),
        reading("b", "2024-06-02", 2, **partial),
        locations=[location("a", 1), location("unseen", 1)],
    )
    days = models.fct_weather.select(
        "location_id", "date", "is_partial_latest_day", "is_quality_approved"
    )
    assert [r[2:] for r in rows(days)] == [(False, True), (True, True), (True, True)]
    picked = models.location_snapshot.select(
        "location_id", "selection_strategy", F.col("snapshot_date").cast("string"), "is_catalog_location"
    )
    # A catalogued location without weather has no snapshot.
    assert rows(picked) == [
        ("a", "usable", "2024-06-01", True),
        ("b", "fallback", "2024-06-02", False),
    ]


def test_weather_only_location_is_active_in_the_snapshot_only(spark):
    models = small(spark, reading("x", "2024-06-01", 1, **FULL))
    assert models.dim_location.select("is_active").first()[0] is None
    assert models.location_snapshot.select("is_active", "country_code").first() == (True, "AR")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    models = Models(
        lambda: adapter.raw_weather(spark, DATA),
        lambda: adapter.raw_locations(spark, DATA),
        lambda: adapter.tax_csv(spark, DATA),
        lambda: adapter.yield_csv(spark, DATA),
    )
    expected = {
        "fct": models.fct_weather.count(),
        "mart": models.mart_province_campaign.count(),
    }
    fresh = Models(
        models.raw_weather, models.raw_locations, models.tax_csv, models.yield_csv
    )
    paths = tables.build(fresh, str(tmp_path_factory.mktemp("marts")))
    return fresh, paths, expected


def test_build_stores_what_the_plans_give(spark, built):
    models, paths, expected = built
    fact = monthly.read_table(spark, paths["fct_weather_daily"])
    assert fact.count() == expected["fct"]
    assert spark.read.parquet(paths["mart_province_campaign"]).count() == expected["mart"]
    months = monthly.read_state(spark, paths["fct_weather_daily"]).months
    assert len(months) == fact.select("month_start").distinct().count()
    plan = fact.filter("month_start = date'2000-03-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan


def test_suite_on_stored_marts(spark, built):
    models, _, _ = built
    relations = {n: getattr(models, n) for n in SUITE if hasattr(models, n) and "csv" not in n}
    relations["legacy_daily"] = legacy.daily(adapter.observations(spark, DATA))
    found = {(r["relation"], r["check"]): r["failures"] for r in run_suite(relations).collect()}
    assert len(found) == sum(len(checks) for n, checks in SUITE.items() if n in relations)
    # What the sources get wrong on purpose shows, and only that.
    clean = [k for k in found if k[0] in ("fct_weather", "location_snapshot", "weather_base")]
    wrong = {k for k in clean if found[k]}
    assert wrong <= {
        ("fct_weather", "not_null province_key"),
        ("fct_weather", "known province_key"),
        ("location_snapshot", "not_null province_key"),
    }
    assert found[("stg_weather", "not_null date")] > 0
    assert found[("legacy_daily", "range precipitation_corrected")] > 0


def test_suite_declares_each_row_check_once():
    for checks in SUITE.values():
        labels = [c.label for c in checks if isinstance(c, Row)]
        assert len(labels) == len(set(labels))


def test_snapshot_scores_stay_in_range(spark, built):
    snapshot = built[0].location_snapshot
    assert snapshot.filter("climate_index_total < 0 or climate_index_total > 1").count() == 0
    flags = " or ".join(marts.QUALITY)
    assert built[0].fct_weather.filter(f"is_quality_approved = ({flags})").count() == 0


def test_export_and_manifest(spark, tmp_path):
    out = str(tmp_path / "out")
    relations = {
        "marts/numbers": spark.range(10).repartition(3),
        "marts/gaps": spark.createDataFrame([(1, None)], "a int, b string"),
        "flat": spark.range(2),
    }
    manifest = {r["table"]: r for r in export.export(spark, relations, out).collect()}
    assert manifest["numbers"]["row_count"] == 10 and manifest["numbers"]["dataset"] == "marts"
    assert manifest["numbers"]["file_count"] == 3
    assert manifest["flat"]["dataset"] == "" and manifest["flat"]["row_count"] == 2
    back = spark.read.schema("id bigint").json(f"{out}/marts/numbers")
    assert rows(back) == [(i,) for i in range(10)]
    lines = "".join(p.read_text() for p in Path(out, "marts/gaps").glob("*.json"))
    assert json.loads(lines) == {"a": 1}  # NULL members are left out
    files = spark.read.json(f"{out}/export_manifest_files")
    assert files.filter("relation = 'marts/numbers' and bytes > 0").count() == 3
    again = export.export(spark, {"flat": spark.range(5)}, out)
    assert again.first()["row_count"] == 5  # overwritten, not appended
    with pytest.raises(ValueError):
        export.export(spark, relations, out, manifest_name="../x")


def test_export_discovery(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shown")
    spark.range(3).write.mode("overwrite").saveAsTable("shown.stored")
    spark.sql("CREATE OR REPLACE VIEW shown.seen AS SELECT * FROM shown.stored")
    spark.range(1).createOrReplaceTempView("hidden")
    found = export.discover(spark, ["shown", "absent", "shown"])
    assert sorted(found) == ["shown/seen", "shown/stored"]
    assert found["shown/seen"].count() == 3
    assert list(export.named_tables(spark, {"x.json": "shown.stored"})) == ["x"]
    with pytest.raises(ValueError):
        export.named_tables(spark, {})


def daily(spark, *readings):
    return legacy.daily(staging.flattened_weather(raw_readings(spark, *readings)))


def local(path):
    return Path(path.removeprefix("file:"))


def test_upsert_rewrites_only_touched_months(spark):
    table = new_path(spark, "t")

    def load(df):
        incremental.upsert(df, table, legacy.KEY, ["location_id"])

    def may():
        folder = monthly.read_state(spark, table).months["2024-05-01"]
        return folder, sorted(p.name for p in local(table).glob(f"{folder}/month_start=2024-05-01/*/*.parquet"))

    load(daily(spark, reading("a", "2024-05-01", 1, T2M=1), reading("a", "2024-06-01", 1, T2M=1)))
    before = may()
    batch = daily(spark, reading("a", "2024-06-01", 2, T2M=2), reading("b", "2024-06-02", 2, T2M=3))
    load(batch)
    load(batch)
    stored = incremental.read_table(spark, table).select("location_id", "t2m")
    assert rows(stored) == [("a", 1.0), ("a", 2.0), ("b", 3.0)]
    assert may() == before and before[1]


def test_upsert_opens_only_touched_months(spark, monkeypatch):
    from pampero.workspace import shared_folder as folder

    table = new_path(spark, "t")
    days = [reading("a", f"2024-{m:02}-01", 1, T2M=m) for m in range(1, 13)]
    incremental.upsert(daily(spark, *days), table, legacy.KEY, ["location_id"])
    opened = []

    def spied(df, *rest):
        opened.extend(df.inputFiles())
        return write(df, *rest)

    write = monthly._write_spans
    monkeypatch.setattr(monthly, "_write_spans", spied)
    before = set(local(folder(spark)).glob("pampero/*"))
    incremental.upsert(daily(spark, reading("a", "2024-05-01", 2, T2M=9)), table, legacy.KEY, ["location_id"])
    assert set(local(folder(spark)).glob("pampero/*")) == before
    stored = [f for f in opened if table.removeprefix("file:") in f]
    assert stored and all("month_start=2024-05-01" in f for f in stored)


@pytest.mark.parametrize("months_done", [0, 1, 2])
@pytest.mark.parametrize("first", [True, False])
def test_a_load_that_dies_leaves_the_table_as_it_was(spark, monkeypatch, first, months_done):
    """Killed before, between and after the months of a load, the first load or a later one."""
    table, mark = new_path(spark, "t"), "_sdc_extracted_at"

    def load(*readings):
        raw = staging.flattened_weather(raw_readings(spark, *readings))
        incremental.load_new(raw, table, mark, legacy.daily, legacy.KEY, ["location_id"])

    def stored():
        df = incremental.read_table(spark, table)
        return None if df is None else rows(df.select(F.month("date"), "t2m"))

    one = [reading("a", "2024-05-01", 1, T2M=1), reading("a", "2024-06-01", 1, T2M=1)]
    two = [reading("a", "2024-05-01", 2, T2M=2), reading("a", "2024-06-01", 2, T2M=2)]
    if not first:
        load(*one)
    before, write = stored(), monthly._write_spans

    def die(df, *rest):
        write(df.where(F.month("month_start") < 5 + months_done), *rest)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(monthly, "_write_spans", die)
    with pytest.raises(RuntimeError):
        load(*one, *two)
    assert stored() == before
    monkeypatch.setattr(monthly, "_write_spans", write)
    load(*one, *two)
    assert stored() == [(5, 2.0), (6, 2.0)]
    # What the dead load left is gone after the next one, with what that superseded.
    load(reading("a", "2024-07-01", 3, T2M=3))
    load(reading("a", "2024-08-01", 4, T2M=4))
    alive = set(monthly.read_state(spark, table).months.values())
    assert {p.name for p in local(table).glob("load=*")} == alive
    assert {p.name for p in local(table).glob("spans/load=*")} == alive


def test_readers_under_way_keep_their_files(spark):
    table = new_path(spark, "t")
    load = lambda *r: incremental.upsert(daily(spark, *r), table, legacy.KEY, ["location_id"])
    load(reading("a", "2024-05-01", 1, T2M=1))
    old = incremental.read_table(spark, table).select("t2m")
    load(reading("a", "2024-05-01", 2, T2M=2))
    assert rows(old) == [(1.0,)]
    assert rows(incremental.read_table(spark, table).select("t2m")) == [(2.0,)]


def test_a_second_writer_is_noticed(spark, monkeypatch):
    table = new_path(spark, "t")
    load = lambda *r: incremental.upsert(daily(spark, *r), table, legacy.KEY, ["location_id"])
    load(reading("a", "2024-05-01", 1, T2M=1))
    write = monthly._write_spans

    def overtaken(*all_):
        monkeypatch.setattr(monthly, "_write_spans", write)
        load(reading("b", "2024-05-01", 2, T2M=2))
        return write(*all_)

    monkeypatch.setattr(monthly, "_write_spans", overtaken)
    with pytest.raises(RuntimeError, match="another load"):
        load(reading("c", "2024-05-01", 3, T2M=3))
    assert rows(incremental.read_table(spark, table).select("location_id")) == [("a",), ("b",)]


def test_plain_month_folders_are_taken_over(spark):
    """A table written by other means has no pointer: its months stay until a load replaces them."""
    table = new_path(spark, "t")
    days = [reading("a", "2024-05-01", 1, T2M=1), reading("a", "2024-06-01", 1, T2M=1)]
    daily(spark, *days).write.partitionBy("month_start").parquet(table)
    raw = staging.flattened_weather(raw_readings(spark, *days, reading("a", "2024-06-02", 2, T2M=5)))
    incremental.load_new(raw, table, "_sdc_extracted_at", legacy.daily, legacy.KEY, ["location_id"])
    stored = incremental.read_table(spark, table)
    assert rows(stored.select(F.col("date").cast("string"), "t2m")) == [
        ("2024-05-01", 1.0),
        ("2024-06-01", 1.0),
        ("2024-06-02", 5.0),
    ]
    assert set(monthly.read_state(spark, table).months.values()) > {""}


def test_months_and_keys_may_be_null(spark):
    table = new_path(spark, "t")
    schema = "month_start date, province_key string, location_id string, n long"
    first = [(None, None, "a", 1), (None, "P", None, 2), (date(2024, 5, 1), None, None, 3)]
    monthly.write_months(spark.createDataFrame(first, schema), table, ["province_key", "location_id"])
    assert rows(monthly.read_table(spark, table).select("n")) == [(1,), (2,), (3,)]
    again = spark.createDataFrame([(None, "P", "b", 4)], schema)
    monthly.write_months(again, table, ["province_key", "location_id"])
    assert rows(monthly.read_table(spark, table).select("n")) == [(3,), (4,)]
    assert rows(monthly.read_table(spark, table, months=[None]).select("n")) == [(4,)]
    found = monthly.read_table(spark, table, where={"province_key": None})
    assert rows(found.select("n")) == [(3,)]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Three months of 400 locations, nine in ten of which lie in one province of 21."""
    table = str(tmp_path_factory.mktemp("clustered") / "t")
    at = F.col("id") % 400
    province = F.when(at < 360, F.lit("M")).otherwise(F.format_string("%02d", at % 20))
    df = spark.range(400 * 90).select(
        province.alias("province_key"),
        F.format_string("l%03d", at).alias("location_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") / 400).cast("int")).alias("date"),
        F.rand(1).alias("v"),
    )
    df = df.withColumn("month_start", F.trunc("date", "month")).repartition(7)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(monthly, "FILE_ROWS", 600)
        monthly.write_months(df, table, ["province_key", "location_id"])
    return table, df


def test_a_light_province_opens_few_files_a_heavy_one_many(spark, clustered):
    table, df = clustered
    everything = monthly.read_table(spark, table)
    files = everything.inputFiles()
    assert len(files) >= 60 and everything.exceptAll(df.select(*everything.columns)).count() == 0
    light = monthly.read_table(spark, table, where={"province_key": "07"})
    assert light.count() == df.where("province_key = '07'").count() > 0
    assert len(light.inputFiles()) <= 2 * 3  # a border may fall into a province, in each month
    heavy = monthly.read_table(spark, table, where={"province_key": "M"})
    assert len(heavy.inputFiles()) > 0.8 * len(files)
    one = monthly.read_table(spark, table, where={"province_key": "M", "location_id": "l123"})
    assert one.count() == 90 and len(one.inputFiles()) <= 2 * 3
    month = monthly.read_table(spark, table, [date(2024, 2, 1)], {"province_key": "M", "location_id": "l123"})
    assert month.count() == 29 and len(month.inputFiles()) <= 2
    assert monthly.read_table(spark, table, where={"province_key": "zz"}).count() == 0
    # A column that rows are not ordered by first opens all files and finds the same rows.
    by_place = monthly.read_table(spark, table, where={"location_id": "l123"})
    assert by_place.count() == 90 and len(by_place.inputFiles()) == len(files)


def test_files_hold_disjoint_ranges_of_even_size(spark, clustered):
    table, _ = clustered
    held = (
        spark.read.parquet(*{str(p) for p in local(table).glob("load=*")})
        .groupBy("month_start", "span")
        .agg(
            F.min(F.struct("province_key", "location_id")).alias("low"),
            F.max(F.struct("province_key", "location_id")).alias("high"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    last = None
    for r in held.orderBy("month_start", "low").collect():
        if last and last.month_start == r.month_start:
            assert tuple(last.high) < tuple(r.low)
        last = r
    assert held.agg(F.max("n")).first()[0] < 3 * 600
    told = spark.read.parquet(*{str(p) for p in local(table).glob("spans/load=*")})
    assert rows(held.select("month_start", "span", "low", "high")) == rows(
        told.select("month_start", "span", "low", "high")
    )


def test_a_key_finds_its_span(spark):
    """The binary search equals a look at all, for any number of spans."""
    for n in (1, 2, 3, 7, 8, 33):
        cuts = spark.range(1).select(
            F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((i * 10).alias("low"), i.alias("span"))).alias("cuts")
        )
        keys = spark.range(0, 10 * n + 5).select("id").crossJoin(cuts)
        found = keys.select(F.expr("least(id div 10, %d)" % (n - 1)).alias("want"), monthly.span_of(F.col("cuts"), F.col("id"), n).alias("got"))
        assert found.where("want <> got").count() == 0


def test_stream_loads_each_file_once_and_survives_a_restart(spark, tmp_path):
    source, table, progress = (str(tmp_path / n) for n in ("raw", "table", "progress"))

    def arrive(*readings):
        raw_readings(spark, *readings).coalesce(1).write.mode("append").parquet(source)
        stream = streaming.read_raw_stream(spark, source, files_per_batch=1)
        streaming.run_available(stream, table, progress).awaitTermination()
        stored = incremental.read_table(spark, table)
        return rows(stored.select("location_id", F.col("date").cast("string"), "t2m"))

    assert arrive(reading("a", "2024-06-01", 2, T2M=2)) == [("a", "2024-06-01", 2.0)]
    # A later file holds an older extract of the same day and a new day.
    assert arrive(reading("a", "2024-06-01", 1, T2M=1), reading("a", "2024-07-01", 1, T2M=5)) == [
        ("a", "2024-06-01", 2.0),
        ("a", "2024-07-01", 5.0),
    ]
    assert arrive(reading("a", "2024-06-01", 3, T2M=3))[0] == ("a", "2024-06-01", 3.0)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_latest_day_needs_no_deduplication(spark):
    staged = staging.weather(adapter.raw_weather(spark, DATA))
    best = weather.best_daily_rows(staged).agg(F.max("date")).first()[0]
    assert weather.latest_day(staged).first()[0] == best
