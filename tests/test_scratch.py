"""What lies on disk while relations are stored: shuffles once, narrow, and deleted when done with."""

import random
import time
import uuid
from datetime import date
from pathlib import Path

import pytest

from pampero.operators import incremental, monthly
from pampero.plans import legacy, weather
from pampero.plans.models import Models, lazy
from pampero.plans.suite import Row, Unique, run_suite
from pampero.sinks import bucketed
from pampero.sources import adapter
from pampero.streaming import upsert as streaming
from pampero.workspace import new_path
from test_operators import rows
from verification.catalog import QUERIES

DATA = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def graph(spark, keep):
    return Models(
        lambda: adapter.raw_weather(spark, DATA, "flat"), lambda: adapter.raw_locations(spark, DATA), keep=keep
    )


@pytest.fixture
def database(spark):
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_days_kept_by_location_are_shuffled_once(spark, database, monkeypatch):
    """Raw rows go to where they are ranked and written; a location of many snapshots is ranked
    before, with the same rows."""
    seen, dealt = [], bucketed.ByLocation.dealt

    def spied(self, df):
        out = dealt(self, df)
        if "weather_variable_non_null_count" in df.columns and "is_active_location" not in df.columns:
            seen.append(physical(out))
        return out

    monkeypatch.setattr(bucketed.ByLocation, "dealt", spied)
    expected = rows(graph(spark, lazy).best_weather)
    for hot in (bucketed.HOT_ROWS, 590):
        monkeypatch.setattr(bucketed, "HOT_ROWS", hot)
        models = graph(spark, bucketed.ByLocation(database, new_path(spark, "buckets"), 4))
        assert rows(models.best_weather.select(*weather.best_daily_rows(models.stg_weather).columns)) == expected
    few, many = seen
    assert few.count("Exchange hashpartitioning(location_id") == 1 and "Exchange hashpartitioning(location_id#" in few
    assert ", date" not in few[few.index("Exchange hashpartitioning") :].split("\n")[0]
    # The hot ones by day, in their own branch.
    assert many.count("Exchange hashpartitioning(location_id") == 2 and "Union" in many


def test_checks_shuffle_narrow_entries_and_none_for_rows_that_pass(spark):
    """An entry is a check, a key and two counts, however many checks a relation declares."""
    declared = {"t": [Row(f"positive {i}", "n > 0", f"n <> {i}") for i in range(1, 9)] + [Unique(("k", "n"))]}
    t = spark.createDataFrame([("a", 1), ("a", 1), (None, -1), (None, -1), ("b", None)], "k string, n int")
    suite = run_suite({"t": t}, declared)
    found = {r["check"]: r["failures"] for r in suite.collect()}
    assert found == {**{f"positive {i}": 2 for i in range(1, 9)}, "unique k, n": 2}
    # Only the two counts are added up.
    plan = physical(suite)
    partial = [line for line in plan.split("\n") if "HashAggregate(keys=[test#" in line and "key#" in line]
    assert partial and all(line.count("sum(") == 2 for line in partial)


def shuffle_files(spark):
    """Sizes of the shuffle files that lie on disk."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [str(f) for f in env.blockManager().diskBlockManager().localDirs()]
    return {p: p.stat().st_size for folder in folders for p in Path(folder).glob("*/shuffle_*.data") if p.exists()}


def left_of(spark, before, most=0):
    """Bytes of shuffle files made since ``before``, once no more than ``most`` or after a while."""
    for _ in range(40):
        left = sum(n for p, n in shuffle_files(spark).items() if p not in before)
        if left <= most:
            break
        time.sleep(0.25)
    return left


def test_the_suite_leaves_no_days_shuffled(spark):
    """Days of both generations, yields and the fact are shuffled by the time it returns, and their
    files are gone."""
    before = {**shuffle_files(spark)}
    checked = QUERIES["check_suite"](spark, DATA)
    assert left_of(spark, before, 50_000) <= 50_000
    assert checked.count() == 61


@pytest.mark.parametrize("version", [None, ["v"]])
def test_many_rows_are_upserted_some_months_at_a_time(spark, monkeypatch, version):
    """Repeated and null keys and months too; what a pass shuffled is gone before the next."""
    kind = "k string, date date, v int, pad string, month_start date"
    months = [date(2024, m, 1) for m in (1, 2, 3, 4)]
    days = [m.replace(day=5) for m in months]
    stored = [(k, d, 1, m) for k in ("a", "b", "b", None) for d, m in zip(days, months)] + [("a", None, 1, None)]
    come = [(k, d, 2 * i, m) for i, k in enumerate(("b", "c", "c", None)) for d, m in zip(days[1:], months[1:])]
    come += [("a", None, 5, None), ("d", None, 6, None)]
    rng = random.Random(3)
    stored, come = ([(*r[:3], rng.randbytes(5_000).hex(), r[3]) for r in part] for part in (stored, come))
    target, batch = spark.createDataFrame(stored, kind), spark.createDataFrame(come, kind)
    monkeypatch.setattr(monthly, "PASS_ROWS", 9)
    calls, write = [], monthly._write_spans

    def spied(*args):
        calls.append(left_of(spark, before, 20_000))
        return write(*args)

    monkeypatch.setattr(monthly, "_write_spans", spied)
    table, before = new_path(spark, "passes"), {**shuffle_files(spark)}
    for df in (target, batch):
        incremental.upsert(df, table, ["k", "date"], ["k"], version)
    merge = incremental.merge_newest if version else incremental.merge
    expected = merge(target, batch, ["k", "date"], *([version] if version else []))
    assert rows(incremental.read_table(spark, table)) == rows(expected)
    assert len(calls) == 4 and max(calls) <= 20_000
    assert monthly.read_state(spark, table).load == 2


def test_a_streamed_batch_is_written_after_its_own_shuffles_are_deleted(spark, monkeypatch):
    table, left = new_path(spark, "streamed"), []
    write = monthly.write_months

    def spied(*args, **kwargs):
        left.append(left_of(spark, before, 50_000))
        return write(*args, **kwargs)

    monkeypatch.setattr(incremental, "write_months", spied)
    raw = adapter.raw_weather(spark, DATA)
    before = {**shuffle_files(spark)}
    streaming.load_batch(raw, table)
    streaming.load_batch(raw, table)
    assert len(left) == 2 and max(left) <= 50_000
    # The second time the same days came again.
    assert incremental.read_table(spark, table).count() == legacy.daily(adapter.observations(spark, DATA)).select(
        *legacy.KEY
    ).distinct().count()
