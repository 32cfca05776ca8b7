"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of links ``a, b`` (long, not null); the root is the
    smallest node of its component, itself included.

    A large star ties a node's larger neighbours to its smallest one, a small star its smaller
    neighbours and itself; both keep components, and repeated they end in stars about each
    smallest node. Minima are aggregated before they are shuffled, so a centre with very many
    neighbours costs one row per task. Every round is a stored table.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stage(small, "links")
        now = edges.agg(
            F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
        ).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
