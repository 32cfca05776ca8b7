"""Building blocks on hand-written rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pampero.operators import checks, incremental
from pampero.operators.payload import raw_member, text_member, with_payload
from pampero.operators.ranking import best_row, newest
from pampero.plans import dimensions, staging, weather
from pampero.sources import windows
from pampero.sources.raw import catalog_as_raw, read_csv, read_raw
from pampero.sources.schemas import (
    CATALOG_CSV,
    RAW_LOCATIONS,
    RAW_WEATHER,
    WEATHER_PAYLOAD,
    documented,
)

AB = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_payload_forms_agree(spark):
    texts = ['{"a": "x", "b": 1.5}', '{"b": null}', '{"a": {"k": 1}, "b": [1]}', "not json", None]
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, data string")
    picked = [text_member("a").alias("a"), raw_member("b").try_cast("double").alias("b")]
    expected = [(0, "x", 1.5), (1, None, None), (2, None, None), (3, None, None), (4, None, None)]
    assert rows(with_payload(raw, AB).select("i", *picked)) == expected

    variant = raw.filter("i < 3").withColumn("data", F.parse_json("data"))
    assert rows(with_payload(variant, AB).select("i", *picked)) == expected[:3]

    flat = spark.createDataFrame([(0, "x", 1.5)], "i int, a string, b double")
    assert rows(with_payload(flat, AB).select("i", *picked)) == expected[:1]

    struct = spark.createDataFrame([(0, ("x",)), (1, (None,))], "i int, data struct<a:string>")
    assert rows(with_payload(struct, AB).select("i", *picked)) == [(0, "x", None), (1, None, None)]


def test_text_is_told_from_nested_values_by_type(spark):
    texts = [
        '{"a": "[Norte] Punto 4", "b": "1"}',
        '{"a": "{x} dep"}',
        '{"a": {"k": "v"}}',
        '{"a": ["v"]}',
        '{"a": "[1]"}',
    ]
    want = ["[Norte] Punto 4", "{x} dep", None, None, "[1]"]
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, data string")
    got = with_payload(raw, AB).select("i", text_member("a").alias("a"))
    assert [r[1] for r in rows(got)] == want
    variant = raw.withColumn("data", F.parse_json("data"))
    assert [r[1] for r in rows(with_payload(variant, AB).select("i", text_member("a").alias("a")))] == want
    flat = spark.createDataFrame([(0, "[x]"), (1, "{y}")], "i int, a string")
    assert [r[1] for r in rows(with_payload(flat, AB).select("i", text_member("a").alias("a")))] == ["[x]", "{y}"]
    struct = spark.createDataFrame([(0, ("[x]",))], "i int, data struct<a:string>")
    assert [r[1] for r in rows(with_payload(struct, AB).select("i", text_member("a").alias("a")))] == ["[x]"]


def test_best_row_does_not_depend_on_partitioning(spark):
    data = [("k", 1, v) for v in range(50)] + [("z", None, 1), ("z", 0, 0)]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(data[::-1] if parts == 3 else data, "k string, o int, v int")
        best = best_row(df.repartition(parts), ["k"], newest("o"), ["v"])
        assert rows(best) == [("k", 1, 49), ("z", 0, 0)]


def test_new_rows(spark):
    stamp = [(datetime(2024, 1, d),) for d in (1, 2, 3)]
    source = spark.createDataFrame(stamp, "t timestamp")
    later = incremental.new_rows(source, source.limit(0).unionByName(source.filter("t < '2024-01-03'")), "t")
    assert later.count() == 1
    assert incremental.new_rows(source, source.filter("false"), "t").count() == 3
    assert incremental.new_rows(source, None, "t").count() == 3
    assert incremental.new_rows(source, source, "t").count() == 0


def test_merge_replaces_by_key_and_stops_on_drift(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    merged = incremental.merge(target, batch, ["k"])
    assert rows(merged) == [(1, "old"), (2, "new"), (3, "new")]
    assert rows(incremental.merge(merged, batch, ["k"])) == rows(merged)
    with pytest.raises(ValueError, match="does not fit"):
        incremental.merge(target, batch.withColumn("v", F.lit(1)), ["k"])


def test_merge_newest_ignores_late_rows(spark):
    schema = "k int, t int, v string"
    target = spark.createDataFrame([(1, 5, "kept"), (2, 5, "old")], schema)
    batch = spark.createDataFrame([(1, 4, "late"), (2, 6, "new")], schema)
    assert rows(incremental.merge_newest(target, batch, ["k"], ["t"])) == [
        (1, 5, "kept"),
        (2, 6, "new"),
    ]


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", -1.0), (None, None), (None, 2.0)], "k string, v double"
    )
    assert checks.not_null(df, "v").count() == 1
    assert rows(checks.unique(df, "k")) == [("a", 2)]
    assert rows(checks.unique_combination(df, ["k"])) == [(None, 2), ("a", 2)]
    assert rows(checks.accepted_values(df, "k", ["b"])) == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "id string")
    assert rows(checks.relationship(df, "k", parent, "id")) == [("a", 2)]
    failing = checks.expression(df, F.col("v") >= 0, where=F.col("v").isNotNull())
    assert rows(failing) == [("a", -1.0)]
    assert checks.expression(df, F.col("v") >= 0).count() == 1  # unknown passes
    assert checks.expression(df, F.col("v") >= 0, strict=True).count() == 2


def test_coverage(spark):
    ten, nine = spark.range(10), spark.range(9)
    assert rows(checks.coverage(nine, ten)) == [(0.9,)]
    assert rows(checks.coverage(ten, ten)) == []
    assert rows(checks.coverage(nine, spark.range(0))) == []


def test_windows():
    assert windows.days_back(1, date(2024, 3, 1)) == (date(2024, 2, 29), date(2024, 2, 29))
    assert windows.days_back(30, date(2024, 3, 1))[0] == date(2024, 1, 31)
    years = windows.year_slices(2022, 2023, date(2024, 5, 6))
    assert years == [
        (date(2022, 1, 1), date(2022, 12, 31)),
        (date(2023, 1, 1), date(2023, 12, 31)),
        (date(2024, 1, 1), date(2024, 5, 6)),
    ]
    assert windows.year_slices(2022, tail_end=date(2024, 5, 6), reverse=True) == years[::-1]
    assert windows.year_slices(2022, 2023, date(2020, 1, 1), tail=False) == years[:2]
    with pytest.raises(ValueError):
        windows.year_slices(2022, 2023, date(2023, 5, 6))
    loaded = []
    assert list(windows.backfill(years, lambda a, b: loaded.append((a, b)))) == years == loaded


def test_slices_label_rows_once(spark):
    df = spark.createDataFrame(
        [("2022-12-31",), ("2023-01-01",), ("2030-01-01",)], "d string"
    ).select(F.col("d").cast("date").alias("date"))
    slices = windows.year_slices(2022, 2022, date(2023, 5, 6))
    assert rows(windows.with_slice(df, slices).select("date", "slice_start")) == [
        (date(2022, 12, 31), date(2022, 1, 1)),
        (date(2023, 1, 1), date(2023, 1, 1)),
    ]


def test_missing_source_gives_no_rows_of_the_declared_schema(spark, tmp_path):
    empty = read_raw(spark, str(tmp_path / "absent"), RAW_WEATHER)
    assert empty.schema == RAW_WEATHER and empty.count() == 0
    assert weather.best_daily_rows(staging.weather(empty)).count() == 0


def test_catalogue_file_feeds_the_location_model(spark, tmp_path):
    path = tmp_path / "locations.csv"
    path.write_text(
        "location_id,location_name,province_name,latitude,longitude,country_code,is_active\n"
        "ba_lp,La Plata,Buenos Aires,-34.9,-57.9,AR,true\n"
        'co,"Córdoba, capital",Córdoba,x,-64.2,AR,yes\n',
        encoding="utf-8",
    )
    raw = catalog_as_raw(read_csv(spark, str(path), CATALOG_CSV), "2024-01-01 00:00:00")
    current = dimensions.current_locations(staging.locations(raw))
    picked = current.select("location_id", "location_name", "province_key", "latitude", "is_active")
    assert rows(picked) == [
        ("ba_lp", "La Plata", "BUENOS AIRES", -34.9, True),
        ("co", "Córdoba, capital", "CORDOBA", None, None),
    ]


def test_comments_survive_a_stored_table(spark):
    df = documented(spark.createDataFrame([("a", 1)], "location_id string, other int"))
    df.write.mode("overwrite").saveAsTable("commented")
    comments = {c.name: c.description for c in spark.catalog.listColumns("commented")}
    assert comments["location_id"] == "Stable location identifier"
    assert comments["other"] is None


def location(i, day, deleted=False, name="n"):
    stamp = datetime(2024, 1, day)
    data = {f: None for f in RAW_LOCATIONS["data"].dataType.fieldNames()}
    data.update(location_id=i, location_name=name, province_name="P")
    return (stamp, stamp, stamp, stamp if deleted else None, day, 1, data)


def test_location_deleted_last_keeps_its_older_version(spark):
    raw = spark.createDataFrame(
        [
            location("a", 1, name="first"),
            location("a", 2, deleted=True, name="gone"),
            location("b", 1, deleted=True),
            location("c", 1, name="old"),
            location("c", 3, name="new"),
        ],
        RAW_LOCATIONS,
    )
    current = dimensions.current_locations(staging.locations(raw))
    assert rows(current.select("location_id", "location_name")) == [("a", "first"), ("c", "new")]


def reading(i, day, loaded, seq=1, deleted=False, **measures):
    stamp = datetime(2024, 6, loaded)
    data = {f: None for f in WEATHER_PAYLOAD.fieldNames()}
    data.update(location_id=i, date=day, province_name="P", x_source="s")
    data.update({k: str(v) for k, v in measures.items()})
    return (stamp, stamp, stamp, stamp if deleted else None, seq, 1, data)


FULL = dict(T2M_MAX=25, T2M_MIN=10, T2M=18, T2MDEW=9, PRECTOTCORR=1, RH2M=50, TS=18, WS2M=2, PS=100)


def raw_readings(spark, *readings, form="struct"):
    df = spark.createDataFrame(list(readings), RAW_WEATHER)
    return df.withColumn("data", F.to_json("data")) if form == "json" else df


@pytest.mark.parametrize("form", ["struct", "json"])
def test_fullest_reading_wins_then_the_newest(spark, form):
    staged = staging.weather(
        raw_readings(
            spark,
            reading("a", "2024-06-01", 1, **FULL),
            reading("a", "2024-06-01", 9, T2M=1),
            reading("a", "2024-6-2", 3, T2M=1),
            reading("a", "2024-06-02", 4, T2M=2),
            reading("a", "2024-06-03", 4, deleted=True, **FULL),
            reading("a", "junk", 4, **FULL),
            reading(None, "2024-06-01", 4, **FULL),
            form=form,
        )
    )
    best = weather.best_daily_rows(staged).select("date", "avg_air_temp_c")
    assert rows(best) == [(date(2024, 6, 1), 18.0), (date(2024, 6, 2), 2.0)]


def test_payload_schema_is_complete():
    assert len(WEATHER_PAYLOAD) == 25
    assert json.loads(RAW_WEATHER.json())["fields"][-1]["name"] == "data"
