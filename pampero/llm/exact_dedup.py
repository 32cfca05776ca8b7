"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition becomes a run: its texts' digests in order, with the row that stays so far
and how many rows it stands for. Runs then meet in rounds. In round r, run p sends each digest to
the run that differs from p in its r-th digit only, that digit being the digest's; after as many
rounds as a run number has digits, every digest has met all its copies, in a run chosen by the
digest alone. Receivers merge the sorted runs of up to ``RADIX`` partners and keep one row per
digest at every level, so a text copied a billion times is one row per run from the first level
on, and no task ever holds more than its share of digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import stage

#: Runs that meet in one merge.
RADIX = 16

#: What makes two texts equal: the digest, verified by length and a hash of another family.
IDENTITY = ["digest", "size", "check"]


def exact_dedup(
    docs: DataFrame, keep: str = "largest", text: Column | None = None
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` names the row that stays of equal texts, by ``doc_id``: ``largest`` or
    ``smallest``. ``text`` is what is compared, as it stands unless an expression is given.
    Null texts count as empty. A null ``doc_id`` never stays beside one that is not null. Rows
    that repeat an id and its text are counted and answered each, alike. An empty table gives
    no rows.
    """
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    best = {"largest": F.max, "smallest": F.min}[keep]
    digests = docs.select(
        F.col("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("check"),
        F.spark_partition_id().alias("run"),
    )
    # Stored: a run number must mean the same rows whenever it is read again.
    runs = stage(digests.sortWithinPartitions(*IDENTITY, "doc_id"), "digest-runs")
    count = (runs.agg(F.max("run")).first()[0] or 0) + 1
    leaves = runs.groupBy("run", *IDENTITY).agg(
        best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("members")
    )
    merged = tree_merge(leaves, count, best)
    # The way back: a run asks once for each digest it holds, then its rows read the answer.
    answers = leaves.select("run", *IDENTITY).join(merged, IDENTITY)
    return runs.join(answers, ["run", *IDENTITY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def tree_merge(leaves: DataFrame, count: int, best) -> DataFrame:
    """``IDENTITY, keep_id, group_size`` over all runs, in rounds of ``RADIX``-way merges."""
    rounds = 1
    while RADIX**rounds < count:
        rounds += 1
    home = F.pmod(F.xxhash64("digest"), F.lit(RADIX**rounds))
    level = leaves.withColumn("owner", F.col("run").cast("long")).withColumn("home", home)

    def digit(column: str, r: int) -> Column:
        return F.pmod(F.floor(F.col(column) / F.lit(RADIX**r)), F.lit(RADIX))

    for r in range(rounds):
        moved = (digit("home", r) - digit("owner", r)) * F.lit(RADIX**r) + F.col("owner")
        level = (
            level.withColumn("owner", moved)
            .repartition(max(count, 1), "owner")
            .sortWithinPartitions("owner", *IDENTITY)
            .groupBy("owner", "home", *IDENTITY)
            .agg(best("keep_id").alias("keep_id"), F.sum("members").alias("members"))
        )
    return level.select(*IDENTITY, "keep_id", F.col("members").alias("group_size"))
