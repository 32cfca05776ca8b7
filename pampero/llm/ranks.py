"""Numbering rows in a total order without bringing them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pampero.llm.common import stage

#: Bits of a row's number within its partition, as Spark deals them.
ROW_BITS = 33


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the place of each row, 1 first, in a column ``name``; equal rows in any order.

    Rows are dealt to tasks by ranges of the order and sorted there. A row's place is its place
    in its task and the number of rows in the tasks before, one row a task, so that nothing but
    these counts comes together.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Stored: a number must mean the same row whenever it is read again.
    dealt = stage(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", ROW_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    joined = dealt.withColumn("__part", part).join(F.broadcast(counts), "__part")
    return joined.select(*df.columns, place.cast("long").alias(name))
