"""Data checks. Each returns the offending rows; an empty result is a pass.

Checks on keys return one row per offending key with its row count, so a key that holds much
of the table is counted before the shuffle instead of being moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.functions.safe import safe_divide

MIN_COVERAGE = 0.95


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys held by more than one row, NULL members included."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, NULL excluded."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    outside = df.filter(~F.col(column).isin(values))
    return outside.groupBy(column).agg(F.count("*").alias("row_count"))


def relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child keys missing in the parent, with their row counts."""
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )
    known = parent.select(F.col(field).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def expression(
    df: DataFrame, holds: Column, where: Column | None = None, strict: bool = False
) -> DataFrame:
    """Rows for which the condition is false; with ``strict`` also those where it is unknown."""
    considered = df if where is None else df.filter(where)
    return considered.filter(~(F.coalesce(holds, F.lit(False)) if strict else holds))


def coverage(
    snapshot: DataFrame, dimension: DataFrame, minimum: float = MIN_COVERAGE
) -> DataFrame:
    """Snapshot rows over dimension rows when below the minimum; an empty dimension passes."""
    # Two one-row relations: the join is a pairing of two counts.
    have = snapshot.agg(F.count("*").alias("have"))
    want = F.broadcast(dimension.agg(F.count("*").alias("want")))
    ratio = safe_divide(F.col("have"), F.col("want"))
    return have.crossJoin(want).select(ratio.alias("coverage_ratio")).filter(
        F.col("coverage_ratio") < minimum
    )


def prefers_usable(snapshot: DataFrame, weather: DataFrame) -> DataFrame:
    """Locations shown with a fallback row although they have a usable one."""
    usable = weather.filter("is_quality_approved and not is_partial_latest_day")
    return (
        snapshot.filter(F.col("selection_strategy") != "usable")
        .join(usable.select("location_id").distinct(), "location_id", "left_semi")
        .select("location_id", "selection_strategy", "snapshot_date")
    )
