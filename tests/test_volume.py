"""What stored tables shuffle and write."""

from datetime import date

import pytest

from pampero.operators import incremental, monthly
from pampero.plans.models import Models, lazy
from pampero.plans.weather import METRICS
from pampero.sinks import tables
from pampero.sources import adapter
from pampero.workspace import new_path, stage
from test_operators import rows

DATA = "/root/testdata/sf0.001"


def graph(spark, keep):
    return Models(
        lambda: adapter.raw_weather(spark, DATA, "flat"),
        lambda: adapter.raw_locations(spark, DATA),
        lambda: adapter.tax_csv(spark, DATA),
        lambda: adapter.yield_csv(spark, DATA),
        keep=keep,
    )


def test_the_stored_fact_is_worked_out_after_its_rows_are_shuffled_and_sorted(spark, monkeypatch):
    given, written = [], monthly._write_spans

    def spied(df, *args):
        kept = written(df, *args)
        given.append((df.columns, kept._jdf.queryExecution().executedPlan().toString()))
        return kept

    monkeypatch.setattr(monthly, "_write_spans", spied)
    paths = tables.build(graph(spark, stage), new_path(spark, "marts"))
    columns, plan = given[0]
    assert not {*METRICS, "campaign_name", "is_quality_approved"} & {*columns}
    assert plan.count("Sort [") == 1 and plan.index("Sort [") < plan.index("REPARTITION_BY_NUM")
    fact = graph(spark, lazy).fct_weather
    stored = monthly.read_table(spark, paths["fct_weather_daily"]).select(*fact.columns)
    assert rows(stored) == rows(fact)


@pytest.mark.parametrize("version", [None, ["v"]])
def test_an_upsert_shuffles_whole_rows_once(spark, monkeypatch, version):
    """Repeated and null keys too: rows of a key are chosen between where files are written."""
    kind = "k string, date date, v int, month_start date"
    day, month = date(2024, 1, 5), date(2024, 1, 1)
    stored = [("a", day, 1, month), ("b", day, 9, month), (None, day, 3, month)]
    come = [("a", day, 2, month), ("b", day, 4, month), ("b", day, 5, month), (None, day, 4, month)]
    target, batch = spark.createDataFrame(stored, kind), spark.createDataFrame(come, kind)
    plans, written = [], monthly._write_spans

    def spied(*args):
        kept = written(*args)
        plans.append(kept._jdf.queryExecution().executedPlan().toString())
        return kept

    monkeypatch.setattr(monthly, "_write_spans", spied)
    table = new_path(spark, "upserted")
    for df in (target, batch):
        incremental.upsert(df, table, ["k", "date"], ["k"], version)
    merge = incremental.merge_newest if version else incremental.merge
    expected = merge(target, batch, ["k", "date"], *([version] if version else []))
    assert rows(incremental.read_table(spark, table)) == rows(expected)
    # By month and key for the cuts, and by span; none by key.
    assert "span" in plans[1] and "hashpartitioning(k" not in plans[1]
    assert "hashpartitioning(date" not in plans[1] and "LeftAnti" not in plans[1]
