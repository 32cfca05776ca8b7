"""Stored forms: tables by location, documented tables, exports read back, backfills, the suite."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pampero import files
from pampero.operators.payload import text_member, with_payload
from pampero.plans import staging
from pampero.plans.models import Models, lazy
from pampero.plans.suite import SUITE, Parent, Row, Unique, run_suite
from pampero.sinks import bucketed, catalogue, export
from pampero.sources import adapter, schemas, windows
from pampero.workspace import new_path
from test_operators import rows
from verification.catalog import QUERIES

DATA = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def database(spark):
    name = f"kept_{id(object())}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def graph(spark, keep):
    return Models(
        lambda: adapter.raw_weather(spark, DATA, "flat"), lambda: adapter.raw_locations(spark, DATA), keep=keep
    )


def test_fact_and_snapshot_of_bucketed_tables_shuffle_nothing(spark, database, no_broadcasts):
    keep = bucketed.ByLocation(database, new_path(spark, "buckets"), 4)
    models = graph(spark, keep)
    fact = models.fct_weather
    assert "Exchange hashpartitioning" not in physical(fact) and physical(fact).count("Join") == 2
    models = bucketed.build_by_location(models, keep)
    snapshot = models.location_snapshot
    assert "Exchange" not in physical(snapshot) and "SortMergeJoin" in physical(snapshot)
    plain = graph(spark, lazy)
    assert rows(snapshot.select("location_id", "snapshot_date")) == rows(
        plain.location_snapshot.select("location_id", "snapshot_date")
    )
    # A bucket is one file: the fact was written as it came, the others dealt once.
    for name in ("fct_weather_daily", "best_weather", "dim_location"):
        assert len(list(Path(keep.out.removeprefix("file:"), name).glob("*.parquet"))) <= 4


def test_buckets_grow_with_rows():
    assert [bucketed.enough_buckets(n, 8) for n in (0, 10, 32_000_000, 33_000_000)] == [8, 8, 8, 16]


def test_the_fact_meets_locations_once(spark):
    assert physical(graph(spark, _written).fct_weather).count("LeftOuter") == 1


def _written(df, name):
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_comments_are_read_from_the_catalogue(spark, database):
    df = spark.createDataFrame([("a", 1.0, 2)], "location_id string, t2m_max double, other int")
    catalogue.save_documented(df, database, "legacy_daily", new_path(spark, "t"))
    catalogue.save_documented(df, database, "unknown", new_path(spark, "t"))
    told = {(r.relation, r.column): (r.relation_comment, r.column_comment) for r in catalogue.comments(spark, database).collect()}
    about = schemas.RELATIONS["legacy_daily"]
    assert told["legacy_daily", "t2m_max"] == (about, "Daily maximum air temperature at 2 m, Celsius")
    assert told["legacy_daily", "other"] == (about, None)
    assert told["unknown", "location_id"] == (None, "Stable location identifier")
    catalogue.describe(spark, f"{database}.unknown", "it's a \\ 'test'")
    assert spark.catalog.getTable(f"{database}.unknown").description == "it's a \\ 'test'"


def test_a_backfill_goes_on_where_it_stopped(spark):
    ledger, loaded = new_path(spark, "slices"), []
    slices = windows.year_slices(2020, tail_end=date(2023, 3, 1), reverse=True)

    def load(first, last):
        if first.year == 2021 and not loaded.count(first):
            loaded.append(first)
            raise RuntimeError("driver lost")
        loaded.append(first)

    with pytest.raises(RuntimeError):
        list(windows.resume_backfill(spark, slices, load, ledger))
    assert set(windows.read_ledger(spark, ledger)) == {date(2023, 1, 1), date(2022, 1, 1)}
    rest = list(windows.resume_backfill(spark, slices, load, ledger))
    assert [a.year for a, _ in rest] == [2021, 2020]
    assert list(windows.resume_backfill(spark, slices, load, ledger)) == []
    # The started year has grown.
    later = windows.year_slices(2020, tail_end=date(2023, 3, 2), reverse=True)
    assert [b for _, b in windows.resume_backfill(spark, later, load, ledger)] == [date(2023, 3, 2)]


def test_small_files_are_replaced_whole(spark):
    path = new_path(spark, "small")
    assert files.read_text(spark, path) is None
    for text in ("one", "zwei ü", ""):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    folder = Path(path.removeprefix("file:")).parent
    assert not list(folder.glob(f"{Path(path).name}.*"))


def test_damaged_exports_are_found(spark, tmp_path):
    out = str(tmp_path / "export")
    df = spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.lit("é\n\"x")).alias("s"), F.lit(1.5).alias("v"))
    relations = {"a/even": df.repartition(3), "a/none": df.where("id < 0"), "a/once": df.coalesce(1)}
    manifest = export.export(spark, relations, out)
    assert rows(manifest.select("table", "row_count", "is_whole")) == [
        ("even", 100, True),
        ("none", 0, True),
        ("once", 100, True),
    ]
    assert export.damaged(spark, out).count() == 0
    files_ = sorted((tmp_path / "export/a/even").glob("*.json"))
    lines = files_[0].read_text().splitlines(keepends=True)
    files.replace_text(spark, str(files_[0]), "".join(lines[:-1]))  # one line lost
    changed = files_[1].read_text().replace('"v":1.5', '"v":2.5', 1)
    files.replace_text(spark, str(files_[1]), changed)  # as many lines, but another one
    next((tmp_path / "export/a/once").glob("*.json")).unlink()
    found = {(r.relation, r.file): (r.found_rows, r.listed_rows) for r in export.damaged(spark, out).collect()}
    assert len(found) == 3
    assert found["a/even", files_[0].name] == (len(lines) - 1, len(lines))
    assert found["a/even", files_[1].name][0] == found["a/even", files_[1].name][1]
    assert [v for k, v in found.items() if k[0] == "a/once"] == [(None, 100)]


# --- payloads ------------------------------------------------------------------------------------

MEMBERS = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "n", "x.y")])


def texts(df):
    return rows(with_payload(df, MEMBERS).select("i", text_member("name").alias("name"), text_member("n").alias("n")))


def test_bracketed_text_survives_a_document_that_repeats_a_key(spark):
    docs = [
        (1, '{"name": "[Norte] 1", "n": 1, "n": 2}'),
        (2, '{"name": ["Norte"], "n": {"a": 1, "a": 2}}'),
        (3, '{"name": "{}", "n": "[]"}'),
        (4, '{"n": true}'),
        (5, "no document"),
        (6, None),
    ]
    got = texts(spark.createDataFrame(docs, "i int, data string"))
    assert got[0][1] == "[Norte] 1"
    assert got[1:] == [(2, None, None), (3, "{}", "[]"), (4, None, "true"), (5, None, None), (6, None, None)]


def test_variant_members_come_by_path_without_a_parse(spark):
    docs = [
        (1, '{"name": "[Norte] 1", "n": 1.5}'),
        (2, '{"name": ["Norte"], "n": {"a": 1}}'),
        (3, '{"name": null, "n": "[]"}'),
        (4, "[1]"),
        (5, None),
    ]
    raw = spark.createDataFrame(docs, "i int, data string").withColumn("data", F.parse_json("data"))
    path = new_path(spark, "variant")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    assert texts(stored) == texts(raw) == [(1, "[Norte] 1", "1.5"), (2, None, None), (3, None, "[]"), (4, None, None), (5, None, None)]
    plan = staging.weather(stored.select("data", *[F.lit(None).alias(c) for c in schemas.REPLICATION]))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in text and "to_json" not in text and "parse_json" not in text


# --- the suite ------------------------------------------------------------------------------------


def test_suite_reads_each_relation_once(spark):
    parent = _written(spark.createDataFrame([("a",), ("b",), (None,)], "k string"), "parent")
    child = _written(
        spark.createDataFrame(
            [("a", 1, 1.0), ("a", 1, -1.0), ("c", 2, None), ("c", 3, 5.0), (None, 4, 5.0), (None, 4, 5.0)],
            "k string, n int, v double",
        ),
        "child",
    )
    declared = {
        "parent": [Unique(("k",)), Row("not_null k", "k is not null")],
        "child": [
            Unique(("k", "n")),
            Unique(("n",)),
            Parent("k", "parent"),
            Row("range v", "v between 0 and 4", "v is not null"),
            Row("sign v", "v > 0"),
        ],
    }
    got = run_suite({"parent": parent, "child": child}, declared)
    assert physical(got).count("FileScan") == 2
    assert {(r.relation, r.check): r.failures for r in got.collect()} == {
        ("parent", "unique k"): 0,
        ("parent", "not_null k"): 1,
        ("child", "unique k, n"): 2,
        ("child", "unique n"): 2,
        ("child", "known k"): 1,
        ("child", "range v"): 4,
        ("child", "sign v"): 1,
    }
    none = run_suite({"parent": parent.where("false"), "child": child.where("false")}, declared)
    assert [r.failures for r in none.collect()] == [0] * 7
    with pytest.raises(ValueError, match="parent"):
        run_suite({"child": child}, declared)


def test_suite_query_finds_what_is_wrong(spark):
    found = QUERIES["check_suite"](spark, DATA).collect()
    assert len(found) == sum(len(declared) for n, declared in SUITE.items() if "csv" not in n)
    assert sum(r.failures > 0 for r in found) >= 5
