"""Date windows for daily loads and calendar-year backfills."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.files import read_text, replace_text

LOCAL_ZONE = "America/Argentina/Buenos_Aires"
FIRST_HISTORY_YEAR = 2016

Window = tuple[date, date]


def today_in(zone: str = LOCAL_ZONE) -> date:
    return datetime.now(ZoneInfo(zone)).date()


def days_back(n: int, today: date | None = None) -> Window:
    """The n full days before today; ``days_back(1)`` is yesterday."""
    today = today or today_in()
    return today - timedelta(days=n), today - timedelta(days=1)


def date_window(df: DataFrame, first: date, last: date, date_col: str = "date") -> DataFrame:
    """Rows dated within [first, last]."""
    return df.filter(F.col(date_col).between(F.lit(first), F.lit(last)))


def month_window(df: DataFrame, first: date, last: date) -> DataFrame:
    """The same on a month-partitioned table: also names the partition column, so that whole
    partitions are skipped."""
    months = F.col("month_start").between(F.lit(first.replace(day=1)), F.lit(last))
    return date_window(df.filter(months), first, last)


def year_slices(
    first_year: int = FIRST_HISTORY_YEAR,
    last_full_year: int | None = None,
    tail_end: date | None = None,
    reverse: bool = False,
    tail: bool = True,
) -> list[Window]:
    """Full calendar years followed by the started one up to `tail_end` (today).

    `reverse` starts with the started year and walks back, so that recent data arrives first.
    """
    tail_end = tail_end or today_in()
    if reverse or last_full_year is None:
        last_full_year = tail_end.year - 1 if reverse else today_in().year - 1
    years = [(date(y, 1, 1), date(y, 12, 31)) for y in range(first_year, last_full_year + 1)]
    if tail or reverse:
        tail_start = date(last_full_year + 1, 1, 1)
        if tail_end < tail_start:
            raise ValueError(f"tail ends {tail_end}, before it starts {tail_start}")
        years.append((tail_start, tail_end))
    return years[::-1] if reverse else years


def with_slice(df: DataFrame, slices: list[Window], date_col: str = "date") -> DataFrame:
    """Label each row with the first day of its slice; rows outside every slice drop out.

    One pass over the table for any number of slices.
    """
    label = None
    for first, last in slices:
        inside = F.col(date_col).between(F.lit(first), F.lit(last))
        label = F.when(inside, F.lit(first)) if label is None else label.when(inside, F.lit(first))
    return df.withColumn("slice_start", label).filter(F.col("slice_start").isNotNull())


def resume_backfill(
    spark: SparkSession, slices: list[Window], load: Callable[[date, date], None], ledger: str
) -> Iterator[Window]:
    """Run `load` slice by slice as `backfill` does, yielding each finished one, and go on where an
    earlier run stopped.

    ``ledger`` is the path of a small file that names the slices in place, one line of text each.
    A slice enters it when its load has returned, so one that died is loaded again: loads have to
    stand being repeated, as upserts do. A slice that has grown since, as the started year does, is
    open again.
    """
    done = read_ledger(spark, ledger)
    for first, last in slices:
        if done.get(first) == last:
            continue
        load(first, last)
        done[first] = last
        text = "".join(f"{a}\t{b}\n" for a, b in sorted(done.items()))
        replace_text(spark, ledger, text)
        yield first, last


def read_ledger(spark: SparkSession, ledger: str) -> dict[date, date]:
    """First and last day of each slice in place."""
    lines = (read_text(spark, ledger) or "").splitlines()
    return dict(tuple(map(date.fromisoformat, line.split("\t"))) for line in lines)


def backfill(slices: list[Window], load: Callable[[date, date], None]) -> Iterator[Window]:
    """Run `load` slice by slice, yielding each finished one.

    Slices cover disjoint partitions, so a failed run resumes at the first missing slice.
    """
    for first, last in slices:
        load(first, last)
        yield first, last
