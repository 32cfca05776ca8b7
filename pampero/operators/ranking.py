"""Keep the best row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def best_row(
    df: DataFrame, keys: list[str], order: list[Column], tiebreak: list[str]
) -> DataFrame:
    """First row of each key by `order`; `tiebreak` columns, descending, settle equal rows.

    Name every column whose value matters in `tiebreak` and the result does not depend on how
    rows are spread over the cluster. Spark keeps one row per key in every task before the
    shuffle (WindowGroupLimit), so a key that holds much of the table shuffles at most one row
    per task.
    """
    best_first = Window.partitionBy(*keys).orderBy(*order, *newest(*tiebreak))
    ranked = df.withColumn("_rank", F.row_number().over(best_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
