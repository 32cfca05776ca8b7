"""Line deduplication by a segment-partition edit join, in DataFrame functions alone.

Of two lines within ``edits`` edits, the shorter cut into ``edits + 1`` segments has one that the
longer holds unchanged, at a place that the edits beside it allow. Segments are as long for all
lines of about one length; every line is filed under what it holds at these places, with the sizes
for its own length and for each up to ``edits`` below. Lines that meet under a key are verified:
what they have in common at both ends is taken off, what is left has to share a segment again, and
then goes through a banded edit distance whose columns are bit vectors as wide as the band.

A line goes if an earlier one is alike, so one witness is enough. Under each key, lines are first
compared with the earliest line there, one pair a line. Of the lines this leaves open, those under
keys of few lines are compared with all earlier ones there. Under a key of many lines the shared
segment is taken out and the rest, which is as near, is filed by segments of its own, under the key:
lines meet again only if they share one of these too, and so on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import stage

EDITS = 2

#: Characters a line has at least to be looked at; shorter ones and blank ones stay.
MIN_CHARS = 20

#: Cells of the filters that keep rows out of a shuffle: 2 MB of bits, whatever the data.
KEY_CELLS = LINE_CELLS = 24

#: Lines of a key up to which all pairs of them are compared; more are filed anew.
FEW = 32

#: How often lines are filed anew. What is left then shares all but a third of its characters.
DEPTH = 3

LAST = (1 << 63) - 1


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """``rank, check, pos, line, chars, id, twin`` of the lines looked at.

    ``rank`` and ``check`` tell the document and order it; ``id`` and ``twin`` are 64-bit hashes
    of the line, together its identity.
    """
    text = F.coalesce("text", F.lit(""))
    line = F.col("line")
    return (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"),
            F.xxhash64(text).alias("check"),
            F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
        )
        .withColumn("chars", F.char_length(line))
        .where(F.col("chars") >= min_chars)
        .withColumns({"id": F.xxhash64(line), "twin": F.xxhash64(line, F.lit(1))})
    )


def segment_size(length: Column, edits: int) -> Column:
    """Characters of a segment of lines of a length: at most their ``edits + 1``-th part, cut to
    four binary digits, so that lines of about one length have segments of one size."""
    part = F.floor(F.greatest(length, F.lit(0)) / (edits + 1)).cast("int")
    digits = F.floor(F.log2(F.greatest(part, F.lit(1)))).cast("int")
    shift = F.greatest(digits - 3, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", part, shift), shift)


def places(edits: int) -> list[tuple[int, int]]:
    """Number of each segment and shift of a place it may be at. Segments of the second half are
    told from the end. Of a segment that is unchanged in both lines, with as many edits before it as
    its number at most and no more behind it than segments, the nearer end moves it by these edits."""
    return [
        (i, shift)
        for i in range(edits + 1)
        for shift in range(-min(i, edits - i), min(i, edits - i) + 1)
    ]


def filed(rows: DataFrame, line: str, edits: int, under: list[Column], text: bool = False) -> DataFrame:
    """Rows with each ``key`` of a line, made of columns ``under`` too; with ``text`` as ``at``, a
    struct of the ``key`` and the ``rest`` of the line without the segment.

    Arrays are exploded where they are made: Spark asks a column first whether it is empty, and
    would work all keys out twice for that.
    """
    whole = F.col(line)
    kept = rows.columns
    length, size = F.col("__chars"), F.col("__size")
    # Most lengths have segments as long as the length below them.
    sizes = F.array_distinct(
        F.array(*[segment_size(length - less, edits) for less in range(edits + 1)])
    )
    rows = rows.withColumn("__chars", F.char_length(whole)).select(
        "*", F.explode(sizes).alias("__size")
    )
    keys = []
    for i, shift in places(edits):
        if 2 * i <= edits:
            start = size * i + 1 + shift
        else:
            start = length - size * (edits + 1 - i) + 1 + shift
        key = F.xxhash64(F.substring(whole, start, size), size, F.lit(i), *under)
        if text:
            rest = F.concat(F.left(whole, start - 1), F.substring(whole, start + size, length))
            key = F.struct(key.alias("key"), rest.alias("rest"))
        keys.append(key)
    return rows.select(*kept, F.explode(F.array_distinct(F.array(*keys))).alias("at" if text else "key"))


def cell_of(column: str, bits: int) -> tuple[Column, Column]:
    """Number of a hash's cell, as that of a word of 64 cells and of the bit in it."""
    cell = F.shiftrightunsigned(column, 64 - bits)
    return F.shiftright(cell, 6), cell.bitwiseAND(F.lit(63)).cast("int")


def cells(values: DataFrame, column: str, bits: int) -> DataFrame:
    """Bitmap over 2**bits cells of which hold a value, in words."""
    word, bit = cell_of(column, bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    return values.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"))


def in_cells(rows: DataFrame, column: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """Rows whose cell is filled. The bitmap's size is fixed by ``bits``, so every task gets it."""
    word, bit = cell_of(column, bits)
    kept = rows.columns
    return (
        rows.withColumn("word", word)
        .join(F.broadcast(bitmap), "word")
        .where(F.call_function("getbit", F.col("bits"), bit) == 1)
        .select(*kept)
    )


def without_common_ends(pairs: DataFrame) -> DataFrame:
    """Strings ``s, t`` without most of their common beginning and end, by halves."""
    for _ in range(8):
        half = F.floor(F.least(F.char_length("s"), F.char_length("t")) / 2).cast("int")
        same = F.left("s", half) == F.left("t", half)
        pairs = pairs.withColumns(
            {c: F.when(same, F.substring(c, half + 1, F.char_length(c))).otherwise(F.col(c)) for c in "st"}
        )
        half = F.floor(F.least(F.char_length("s"), F.char_length("t")) / 2).cast("int")
        same = F.right("s", half) == F.right("t", half)
        pairs = pairs.withColumns(
            {c: F.when(same, F.left(c, F.char_length(c) - half)).otherwise(F.col(c)) for c in "st"}
        )
    return pairs


def characters(text: Column, edits: int) -> Column:
    """A string's characters behind a beginning that all strings get: it changes no distance, and
    leaves none shorter than a band."""
    return F.split(F.concat(F.lit("\u0001" * (edits + 1)), text), "")


def within_edits(rows: Column, columns: Column, edits: int) -> Column:
    """Whether two strings, whose lengths differ by ``edits`` at most, are that near.

    Both are columns of `characters`, worked out before: an expression would be worked out anew
    in every step.
    Column j of the distance matrix is kept as differences of neighbouring cells on the
    ``2 * edits + 1`` diagonals about the main one, a bit each for +1 and -1; the band moves one
    row down with each column. The score follows the band's lowest diagonal to the last row, then
    that row.
    """
    band = 2 * edits + 1
    full = (1 << band) - 1
    state = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("up"),
        F.lit(0).cast("long").alias("down"),
        F.lit(edits).alias("score"),
    )
    big = lambda n: F.lit(n).cast("long")

    def matches(j):
        total = big(0)
        for b in range(band):
            equal = F.get(rows, j - edits + b) == F.get(columns, j)
            total = total + F.when(equal, big(1 << b)).otherwise(big(0))
        return total

    def column(a, j):
        # Cells of a column differ from the lowest diagonal's by the band's width at most: past
        # this score none is within reach, and the rest of the columns is passed over.
        return F.when(a["score"] > 3 * edits, a).otherwise(next_column(a, j))

    def next_column(a, j):
        # Two structs, one after the other, so that each vector is worked out once.
        seen = F.transform(F.array(matches(j)), lambda x: x)
        return F.element_at(
            F.transform(
                F.transform(
                    seen,
                    lambda x: F.struct(
                        (
                            (x.bitwiseAND(a["up"]) + a["up"]).bitwiseXOR(a["up"])
                            .bitwiseOR(x).bitwiseOR(a["down"])
                        ).bitwiseAND(big(full)).alias("level")
                    ),
                ),
                lambda d: moved(a, j, d["level"]),
            ),
            1,
        )

    def moved(a, j, level):
        right = a["down"].bitwiseOR(F.bitwise_not(level.bitwiseOR(a["up"]))).bitwiseAND(big(full))
        left = level.bitwiseAND(a["up"])
        lower = F.shiftright(level, 1)
        last = F.size(rows) - 1 - j + edits  # bit of the last row in this column
        at_last = lambda v: F.call_function("shiftright", v, last).bitwiseAND(big(1)).cast("int")
        return F.struct(
            left.bitwiseOR(F.bitwise_not(lower.bitwiseOR(right))).bitwiseAND(big(full)).alias("up"),
            lower.bitwiseAND(right).alias("down"),
            (
                a["score"]
                + F.when(last >= band - 1, 1 - F.shiftright(level, band - 1).cast("int"))
                .otherwise(at_last(right) - at_last(left))
            ).alias("score"),
        )

    steps = F.sequence(F.lit(0), F.size(columns) - 1)
    return F.aggregate(steps, state, column, lambda a: a["score"]) <= edits


def share_segment(edits: int) -> Column:
    """Whether ``s, t`` can be within ``edits`` edits, by one segment of the shorter in the longer."""
    longer = F.char_length("s") > F.char_length("t")
    a = F.when(longer, F.col("t")).otherwise(F.col("s"))
    b = F.when(longer, F.col("s")).otherwise(F.col("t"))
    size = F.floor(F.char_length(a) / (edits + 1)).cast("int")
    found = F.lit(False)
    for i, shift in places(edits):
        if 2 * i <= edits:
            own = other = size * i + 1
        else:
            own, other = [F.char_length(c) - size * (edits + 1 - i) + 1 for c in (a, b)]
        found = found | (F.substring(a, own, size) == F.substring(b, other + shift, size))
    return found


def near_pairs(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Pairs ``x, y`` of line ids within ``edits`` edits, as ``later, earlier``."""
    of = lambda s: texts.select(
        F.col("id").alias(s), F.col("first").alias(f"{s}_first"), F.col("chars").alias(f"{s}_chars")
    )
    sized = (
        pairs.join(of("x"), "x")
        .join(of("y"), "y")
        .where(F.abs(F.col("x_chars") - F.col("y_chars")) <= edits)
    )
    worded = sized.join(texts.select(F.col("id").alias("x"), F.col("line").alias("s")), "x").join(
        texts.select(F.col("id").alias("y"), F.col("line").alias("t")), "y"
    )
    later = F.col("x_first") > F.col("y_first")
    named = worded.select(
        F.when(later, F.col("x")).otherwise(F.col("y")).alias("later"),
        F.when(later, F.col("y")).otherwise(F.col("x")).alias("earlier"),
        "s",
        "t",
    )
    # Stored: a condition on the ends taken off would be rewritten in terms of whole lines, and one
    # on characters in terms of strings.
    ends = stage(without_common_ends(named), "line-pairs").where(share_segment(edits))
    ends = stage(
        ends.select("later", "earlier", *[characters(F.col(c), edits).alias(c) for c in "st"]),
        "line-pairs",
    )
    return ends.where(within_edits(F.col("s"), F.col("t"), edits)).select("later", "earlier")


def texts_of(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, line, chars, first`` of the lines in pairs; ``first`` is where the line is first."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    rows = lines.select("id", "line", "chars", F.struct("rank", "check", "pos").alias("at"))
    return (
        in_cells(rows, "id", cells(wanted, "id", LINE_CELLS), LINE_CELLS)
        .join(wanted, "id")
        .groupBy("id")
        .agg(
            F.first("line").alias("line"),
            F.max("chars").alias("chars"),
            F.min("at").alias("first"),
        )
    )


def pair(x: Column | str, y: Column | str) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def refiled(members: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """``key, id, rank, chars, rest`` of members of keys: what is left of a line without the segment it
    is filed under, once for each place it has it at."""
    told = filed(members.join(texts.select("id", "line"), "id"), "line", edits, [], text=True)
    found = told.where(F.col("at.key") == F.col("key"))
    return found.select("key", "id", "rank", "chars", "at.rest").distinct()


def compared(members: DataFrame, done: DataFrame, edits: int) -> DataFrame:
    """Pairs of lines not ``done`` with all earlier ones of their key, of about their length."""
    left = members.join(done, "id", "left_anti")
    alike = F.abs(F.col("x.chars") - F.col("y.chars")) <= edits
    return (
        left.alias("x")
        .join(members.alias("y"), "key")
        .where((F.col("x.id") != F.col("y.id")) & (F.col("y.rank") <= F.col("x.rank")) & alike)
        .select(*pair("x.id", "y.id"))
        .distinct()
    )


def dropped_lines(
    docs: DataFrame, edits: int, min_chars: int, few: int = FEW, depth: int = DEPTH
) -> DataFrame:
    """``rank, check, pos`` of every line that an earlier line equals or nearly equals."""
    lines = lines_of(docs, min_chars)
    occurrence = F.struct("rank", "check", "pos")
    firsts = stage(
        lines.groupBy("id", "twin").agg(F.min(occurrence).alias("first"), F.count(F.lit(1)).alias("n")),
        "first-lines",
    )
    entries = filed(lines.select("id", "rank", "chars", "line"), "line", edits, []).drop("line")
    meetings = stage(
        entries.groupBy("key")
        .agg(
            F.min("id").alias("low"),
            F.max("id").alias("high"),
            F.min_by("id", "rank").alias("head"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("low < high"),
        "line-meetings",
    )
    # Two rows under a key are a pair. More are read again, past a filter of their keys.
    larger = meetings.where("n > 2").select("key", "head", "n")
    members = stage(
        in_cells(entries, "key", cells(larger, "key", KEY_CELLS), KEY_CELLS)
        .join(larger, "key")
        .groupBy("key", "id", "head", "n", "chars")
        .agg(F.min("rank").alias("rank")),
        "line-members",
    )
    # So far ``n`` counts copies of a line too.
    many = stage(
        members.where(F.col("n") > few).groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > few),
        "line-keys",
    )
    members = members.join(many, "key", "left").withColumn("n", F.coalesce("lines", F.lit(0))).drop("lines")
    pairs = stage(
        meetings.where("n = 2")
        .select(F.col("low").alias("x"), F.col("high").alias("y"))
        .union(members.where("id <> head").select(*pair("id", "head")))
        .distinct(),
        "line-pairs",
    )
    # All lines under keys of several are in pairs with their heads, so later steps need no more.
    texts = stage(texts_of(lines, pairs), "line-texts")
    near = stage(near_pairs(pairs, texts, edits), "near-lines")

    # Lines without a witness yet, against all earlier lines of their smaller keys; larger keys that
    # hold such lines are filed anew.
    done = stage(near.select(F.col("later").alias("id")).distinct(), "near-lines")
    more, rests = [], None
    for again in range(depth):
        more.append(stage(compared(members.where(F.col("n") <= few), done, edits), "line-pairs"))
        keys = stage(
            members.where(F.col("n") > few).join(done, "id", "left_anti").select("key").distinct(),
            "line-keys",
        )
        if keys.isEmpty():
            members = None
            break
        # Lines under a key, without what they share there, are filed under it by segments anew.
        if rests is None:
            rests = refiled(members.join(keys, "key"), texts, edits)
        else:
            rests = rests.join(keys, "key")
        under = filed(rests, "rest", edits, [F.col("key")], text=True)
        rests = stage(under.select("id", "rank", "chars", "at.key", "at.rest"), "line-rests")
        groups = (
            rests.groupBy("key")
            .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
            .where("low < high")
            .select("key", "n")
        )
        met = rests.select("key", "id", "rank", "chars").distinct()
        members = stage(met.join(groups, "key"), "line-members")
    if members is not None:
        more.append(compared(members, done, edits))
    more = stage(
        reduce(DataFrame.union, more).distinct().join(pairs, ["x", "y"], "left_anti"), "line-pairs"
    )
    near = near.union(near_pairs(more, texts, edits))
    witnessed = near.select(F.col("later").alias("id")).distinct()
    known = firsts.join(witnessed.withColumn("near", F.lit(True)), "id", "left").where(
        "n > 1 OR near"
    )
    return (
        lines.select("rank", "check", "pos", "id", "twin")
        .join(known, ["id", "twin"])
        .where(F.coalesce("near", F.lit(False)) | (occurrence != F.col("first")))
        .select("rank", "check", "pos")
    )


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of the rows given, ``text`` without the lines dropped, and ``n_lines``,
    ``n_dropped``, which replace columns of these names.

    A line of ``min_chars`` characters or more goes if an earlier line of that size, in the
    order of ``doc_id``, place, is within ``edits`` edits of it, whether that one stays or not. A
    document without id comes last. Null stays null and empty stays empty; both have no lines.
    Rows repeating an id and its text are one document and get the same answer; an id with
    several texts has them ordered by a hash. An empty table gives no rows.
    """
    gone = dropped_lines(docs.select("doc_id", "text"), edits, min_chars)
    gone = stage(
        gone.distinct()
        .groupBy("rank", "check")
        .agg(F.collect_set("pos").alias("gone")),
        "dropped-lines",
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    told = docs.select(
        *columns,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("__rank"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("__check"),
    )
    joined = told.join(
        gone.select(F.col("rank").alias("__rank"), F.col("check").alias("__check"), F.col("gone").alias("__gone")),
        ["__rank", "__check"],
        "left",
    )
    lines = F.split("text", "\n", -1)
    kept = F.array_join(
        F.filter(lines, lambda _, i: ~F.array_contains(F.col("__gone"), i)), "\n"
    )
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(lines))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in columns],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
