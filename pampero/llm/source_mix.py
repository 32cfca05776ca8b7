"""Mixing sources to target weights, by histograms over hashes; DataFrame functions alone.

Every document has a hash. A source with a budget takes all documents whose hash lies below a
threshold. The threshold is found from sums alone: sizes are added up by source and the first
digit of the hash, the digit in which the running sum passes the budget becomes the threshold's
first, and only documents with that digit are added up again by the next one, until a single
document is left. So no source is ever sorted or gathered, however much of the corpus it holds:
a histogram has ``2**DIGIT`` sums a source, added up partially before they are shuffled.

Thresholds are nested: a larger budget has a larger threshold and takes all that a smaller one
takes. The document at the threshold does not fit its budget. What is left of the budget is
spent in the same way on later documents small enough for it, ``passes`` times in all; the
document at a source's last threshold is taken if that comes nearer to the budget than leaving it.

A budget above the source's size takes every document once for each time it holds the whole
source, and what remains by the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pampero.llm.common import stage
from pampero.llm.ranks import ranked

#: Bits of a digit: a histogram has 4,096 sums a source.
DIGIT = 12

#: Digits of a document's hash, then of its row's number, which parts rows that repeat an id and
#: its text.
HASH_DIGITS, ROW_DIGITS = 5, 6

#: Words between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def hashed(seed: str) -> Column:
    """60 bits of a document's id and text: the first 15 digits of an MD5."""
    key = F.concat_ws(
        ":",
        F.lit(seed),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.coalesce("text", F.lit("")),
    )
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def mix_targets(sizes: DataFrame, weights: list[int], share: float, ceiling: float) -> DataFrame:
    """``source, place, source_size, target`` of sources ``source, source_size``.

    Sources in the order of their names, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes by weight. A target stops at ``ceiling`` times its source's size; what
    is above is shared again by the weights of the others, until none is above. Two sums a
    round reach the driver.
    """
    placed = ranked(sizes, [F.col("source").isNull(), F.col("source")], "place")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(turns, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    top = (F.col("source_size") * ceiling).alias("top")
    plan = stage(placed.select("source", "place", "source_size", weight.alias("weight"), top), "mix")
    total = plan.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # Sources whose share at this level reaches their ceiling give back what is above.
        stopped = F.col("top") < F.col("weight") * level
        left, heavy, n = plan.agg(
            F.sum(F.when(stopped, F.col("top")).otherwise(0.0)),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))),
            F.sum(stopped.cast("long")),
        ).first()
        if not heavy or n == full:
            break
        level, full = (total * share - left) / heavy, n
    target = F.least("top", F.col("weight") * level)
    return plan.select("source", "place", "source_size", target.alias("target"))


def threshold(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The cut of each place whose rows exceed its budget; a place all of whose rows fit has none.

    ``rows`` have ``place, hash, row, size``, ``budgets`` have ``place, room``. A cut is the
    cell ``low_hash, wide_hash, low_row, wide_row`` that holds one row alone. The rows before it,
    by hash, then row, fit the budget and leave ``room``; that row does not fit.
    """
    whole = {
        "low_hash": 0,
        "wide_hash": 1 << DIGIT * HASH_DIGITS,
        "low_row": 0,
        "wide_row": (1 << 63) - 1,
    }
    cuts = budgets.select("place", "room", *[F.lit(v).cast("long").alias(k) for k, v in whole.items()])
    digits = [("hash", DIGIT * d) for d in reversed(range(HASH_DIGITS))]
    digits += [("row", DIGIT * d) for d in reversed(range(ROW_DIGITS))]
    place = Window.partitionBy("place")
    for by, shift in digits:
        digit = F.shiftright(F.col(by), shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        sums = (
            rows.join(cuts, "place")
            .where(inside("hash") & inside("row"))
            .groupBy("place", "room", *whole, digit.alias("digit"))
            .agg(F.sum("size").alias("mass"), F.count(F.lit(1)).alias("members"))
        )
        passed = (
            sums.withColumn("running", F.sum("mass").over(place.orderBy("digit")))
            .where("running > room")
            .withColumn("first", F.min("digit").over(place))
            .where("digit = first")
        )
        narrowed = {
            f"low_{by}": F.col(f"low_{by}") + F.shiftleft(F.col("digit").cast("long"), shift),
            f"wide_{by}": F.lit(1 << shift).cast("long"),
        }
        cells = [narrowed.get(c, F.col(c)).alias(c) for c in whole]
        room = (F.col("room") - F.col("running") + F.col("mass")).alias("room")
        cuts = stage(passed.select("place", room, *cells, "members"), "cuts")
        # One number reaches the driver: whether some cell holds more than one row yet.
        most = cuts.agg(F.max("members")).first()[0]
        cuts = cuts.drop("members")
        if most is None or most == 1:
            break
    return cuts


def inside(by: str) -> Column:
    """Whether a row is in the cell of its place's cut, seen by its hash or its row number."""
    beyond = F.col(by) - F.col(f"low_{by}")
    return (beyond >= 0) & (beyond < F.col(f"wide_{by}"))


def before() -> Column:
    """Whether a row comes before its place's cut; true without one."""
    earlier = inside("hash") & (F.col("row") < F.col("low_row"))
    return F.col("low_hash").isNull() | (F.col("hash") < F.col("low_hash")) | earlier


def mix_sources(
    docs: DataFrame,
    weights: list[int],
    share: float = 1.5,
    ceiling: float = 2.0,
    seed: str = "mix",
    passes: int = 3,
) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` counts the words between ASCII blanks, ``taken`` those the mix takes: the whole
    document ``copies`` times, from none up to ``ceiling`` times rounded up. ``target`` is the
    budget of the document's source (`mix_targets`), which the source misses by half of the
    document at its last threshold at most.

    The choice depends on ids, texts and ``seed`` alone, so reruns agree, on any cluster. A
    null or empty text has size 0 and is never taken; null is a source of its own, the last;
    rows repeating an id and its text are chosen one by one, and being alike may stand for each
    other. Columns other than ``doc_id, text, source`` are not read. An empty table gives no rows.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sized = stage(
        docs.select(
            "doc_id", "source", size.alias("size"), hashed(seed).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    targets = mix_targets(sizes, weights, share, ceiling)
    targets = targets.withColumn("whole", whole).withColumnRenamed("source", "of")
    targets = stage(targets, "targets")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")

    room = F.col("target") - F.col("whole") * F.col("source_size")
    budgets = targets.select("place", room.alias("room"))
    left = rows.where("size > 0").select("place", "hash", "row", "size")
    more = F.lit(False)
    open_ = F.col("size") > 0
    for number in range(1, passes + 1):
        cuts = threshold(left, budgets)
        left = (
            left.join(cuts, "place")
            .where(~before() & ~(inside("hash") & inside("row")) & (F.col("size") <= F.col("room")))
            .select("place", "hash", "row", "size")
        )
        budgets = cuts.select("place", "room")
        if number < passes:
            rest = left.groupBy("place").agg(F.sum("size").alias("rest"))
            cuts = cuts.join(rest, "place", "left").withColumn("rest", F.coalesce("rest", F.lit(0)))
            # Stored, so that Spark knows how few they are and leaves the rows where they lie.
            cuts = stage(cuts, "cuts")
        else:
            cuts = cuts.withColumn("rest", F.lit(0))
        rows = rows.join(cuts, "place", "left")
        at = inside("hash") & inside("row")
        # The last cut of a place: all that follows fits, and this document may come nearer.
        missed = F.col("room") - F.col("rest")
        nearer = at & (missed >= 0) & (2 * missed >= F.col("size"))
        rows = rows.withColumn("more", more | (open_ & (before() | nearer)))
        fits = F.coalesce(F.col("size") <= F.col("room"), F.lit(False))
        rows = rows.withColumn("open", open_ & ~before() & ~at & fits).drop(*cuts.columns[1:])
        more, open_ = F.col("more"), F.col("open")
    copies = F.col("whole") + more.cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(0).cast("long")
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
