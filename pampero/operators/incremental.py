"""High-water-mark reads and keyed upserts into month-partitioned tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pampero.operators.monthly import MONTH, read_state, read_table, write_months
from pampero.operators.ranking import best_row, newest
from pampero.workspace import release, staged


def high_water_mark(target: DataFrame, column: str) -> datetime | None:
    """Largest value of the column; None for an empty target. One value reaches the driver."""
    naive = F.max(column).cast("timestamp_ntz").alias("mark")
    return target.agg(naive).first()["mark"]


def new_rows(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Source rows later than anything in the target.

    A missing or empty target takes every row: comparing with its NULL mark would drop them
    all, for ever. Rows as old as the mark, or older, are taken as loaded. The mark enters the
    filter as a literal, which Parquet uses to skip row groups.
    """
    return rows_after(source, column, None if target is None else high_water_mark(target, column))


def rows_after(source: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Source rows later than a given mark; all of them without one."""
    if mark is None:
        return source
    return source.filter(F.col(column) > F.lit(mark.isoformat(" ")).cast("timestamp"))


def assert_same_columns(target: DataFrame, batch: DataFrame) -> None:
    """Stop on schema drift: same names and types, in any order."""
    have = {f.name: f.dataType for f in target.schema}
    come = {f.name: f.dataType for f in batch.schema}
    if have != come:
        drift = sorted(set(have.items()) ^ set(come.items()), key=str)
        raise ValueError(f"batch does not fit the target: {drift}")


def merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target with the batch's rows in place of those sharing their key.

    Batch keys are made distinct before the join, so repeated keys add no work. As in a keyed
    merge the batch should hold one row per key; rows repeated there are all kept.
    """
    assert_same_columns(target, batch)
    replaced = batch.select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").unionByName(batch)


def merge_newest(
    target: DataFrame, batch: DataFrame, keys: list[str], version: list[str]
) -> DataFrame:
    """Target and batch with the newest version of each key, in whatever order they came."""
    assert_same_columns(target, batch)
    return newest_versions(target.unionByName(batch), keys, version)


def newest_versions(
    df: DataFrame, keys: list[str], version: list[str], lie_by: list[str] | None = None
) -> DataFrame:
    """Newest version of each key. Rows that already lie by columns their keys determine,
    ``lie_by``, are not shuffled again."""
    tiebreak = sorted(c for c in df.columns if c not in (*keys, *version, *(lie_by or [])))
    within = [*(lie_by or []), *[k for k in keys if k not in (lie_by or [])]]
    return best_row(df, within, newest(*version), tiebreak)


#: Whether a row to be written comes from the batch.
_COMES = "_comes"


def unreplaced_rows(placed: DataFrame, keys: list[str], lie_by: list[str]) -> DataFrame:
    """`merge` of rows that already lie by columns their keys determine: those of the batch, and
    those of the target whose key the batch has not. Keys with a null in them replace nothing."""
    comes = F.col(_COMES)
    same_key = Window.partitionBy(*lie_by, *[k for k in keys if k not in lie_by])
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    replaced = F.max(comes).over(same_key) & named
    seen = placed.withColumn("_replaced", replaced)
    return seen.where(comes | ~F.col("_replaced")).drop("_replaced", _COMES)


def committed_mark(spark: SparkSession, table: str, column: str) -> datetime | None:
    """High-water mark of the loads that ended, as the table's pointer has it.

    A table without one, loaded by other means, is asked itself.
    """
    state = read_state(spark, table)
    if state.mark is not None:
        return datetime.fromisoformat(state.mark)
    target = read_table(spark, table)
    return None if target is None else high_water_mark(target, column)


def load_new(
    source: DataFrame,
    path: str,
    column: str,
    shape: Callable[[DataFrame], DataFrame],
    keys: list[str],
    cluster_by: list[str],
) -> None:
    """One load: source rows past the mark, shaped and upserted, and the new mark with them.

    Months and mark change in one step, so a load that dies leaves both as they were, and the
    next load reads the same rows again.
    """
    spark = source.sparkSession
    before = committed_mark(spark, path, column)
    fresh = rows_after(source, column, before)
    after = high_water_mark(fresh, column)
    if after is None:
        return
    upsert(shape(fresh), path, keys, cluster_by, mark=after)


def upsert(
    batch: DataFrame,
    path: str,
    keys: list[str],
    cluster_by: list[str],
    version: list[str] | None = None,
    mark: datetime | None = None,
) -> None:
    """Merge a batch into the table at `path`, reading and rewriting only the months it touches.

    Batch rows replace stored ones; with `version`, only if they are newer by those
    columns, for batches that may arrive late or twice.

    The key must determine the month (it holds the date). Only the folders of the batch's months
    are opened, and their merged rows are written once, beside them; all months are put in place
    by one step (`monthly`). The shuffle a step took is deleted before the next.
    """
    spark = batch.sparkSession
    state = read_state(spark, path)
    choose, stored = None, False
    with staged(batch, "batch") as batch:
        release(spark)
        # One value per month of history touched, twelve a year at most.
        months = [r[0] for r in batch.select(MONTH).distinct().collect()]
        target = read_table(spark, path, months)
        places = batch.select(MONTH, *cluster_by)
        if target is not None:
            places = places.unionByName(target.select(MONTH, *cluster_by))
        if set(cluster_by) <= set(keys):
            # Rows of one key meet where files are written: they are shuffled once.
            merged, choose = _to_choose(target, batch, keys, version)
            stored = True
        elif target is None:
            merged = newest_versions(batch, keys, version) if version else batch
        else:
            merged = (
                merge_newest(target, batch, keys, version) if version else merge(target, batch, keys)
            )
        stamp = None if mark is None else mark.isoformat(" ")
        write_months(
            merged, path, cluster_by, places, stamp, before=state, choose=choose, stored=stored
        )


def _to_choose(
    target: DataFrame | None, batch: DataFrame, keys: list[str], version: list[str] | None
) -> tuple[DataFrame, Callable[[DataFrame, list[str]], DataFrame] | None]:
    """Rows of both, and how those to keep are told where rows of one key meet."""
    if target is not None:
        assert_same_columns(target, batch)
    if version:
        both = batch if target is None else target.unionByName(batch)
        return both, lambda rows, lie_by: newest_versions(rows, keys, version, lie_by)
    if target is None:
        return batch, None
    both = target.withColumn(_COMES, F.lit(False)).unionByName(
        batch.withColumn(_COMES, F.lit(True))
    )
    return both, lambda rows, lie_by: unreplaced_rows(rows, keys, lie_by)
