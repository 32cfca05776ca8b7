"""Jaccard join of word n-gram sets by prefixes, with skipping from set relations.

Two sets with Jaccard similarity of at least t share a member among the first
``n - ceil(t n) + 1`` of each, under any common order of members. The order here puts frequent
members last and the rest by hash. Lists of the sets that hold a member in their prefix, by
size, are skipped over in blocks of sizes too far apart, and two sets whose positions leave too
little room behind the member are skipped as well.

Relations between sets save the rest. Equal sets are one class. In each block of a list every set
is first compared with the block's first set only, then with one of the largest component a few
times, which yields one pair per set and time however many near copies there are. Sets found
alike are one component, inside which nothing is compared again.
Across components the answer for a set is derived from the answer of the similar set it was
matched with, r: with known ``|x \\ r|`` and ``|r \\ x|``, the overlap of r and y bounds the
overlap of x and y from both sides, and only pairs the bounds leave open are counted out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pampero.llm.common import (
    STAGED,
    Words,
    buffers,
    cell_filter,
    fold,
    in_cells,
    release,
    slices,
    stage,
    text_bytes,
    unstage,
)
from pampero.llm.components import components

SHINGLE = 5
PERCENT = 80

SPACES = b" \t\n\v\f\r"

#: A member is frequent, and ordered last, if it occurs this often and makes up this share of
#: all occurrences: at most two million members are. Input tasks report what they meet
#: ``NOTABLE`` times. Only the order depends on it, no result.
FREQUENT = 16
FREQUENT_SHARE = 2_000_000
NOTABLE = 2

#: Prefix members a list task holds at most, about.
LIST_MEMBERS = 2_000_000

#: Least bits of a signature; a larger set has the power of two from twice its size on.
SIGNATURE_BITS = 1024

#: Times a block's sets are compared with one set each, before what is left is compared in full.
ROUNDS = 5

#: What a list holds of a set.
FIELDS = ("node", "n", "place", "shared")

#: Cells of the filter that keeps texts nobody asks for out of a join.
FILTER_BITS = 24


def shingle_sets(table, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of k words; of all words where a text has fewer."""
    grams = table.grams(k)
    sets = []
    for low, high in zip(table.first[:-1], table.first[1:]):
        if high - low >= k:
            sets.append(np.unique(grams[low : high - k + 1]))
        elif high > low:
            total = np.zeros(1, np.uint64)
            for h in table.hashes[low:high]:
                total = total * np.uint64(0xD6E8FEB86659FD93) + h
            sets.append(fold(total ^ np.uint64(high - low)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(members: np.ndarray) -> bytes:
    """Parity of the member count in each of equal ranges of hashes, a bit each."""
    bits = SIGNATURE_BITS
    while bits < 2 * len(members):
        bits *= 2
    at = (members >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """Members at least that only one of two sets has: bits in which their signatures differ.
    The finer signature is folded to the other's size, two ranges into one."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        if len(a) > len(b):
            a, b = b, a
        b = np.packbits(np.bitwise_xor.reduce(np.unpackbits(b).reshape(-1, 2), axis=1))
    return int(np.bitwise_count(a ^ b).sum())


def frequent_members(docs: DataFrame, k: int) -> np.ndarray:
    """Members to order last: those frequent in the counts that input tasks find notable."""

    def count(batches):
        words = Words(SPACES)
        held = []
        for batch in slices(batches, "body"):
            held += shingle_sets(words(buffers(batch, "body")), k)
        members, n = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
        notable = n >= NOTABLE
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(members[notable].view(np.int64), 0)),
                pa.array(np.append(n[notable], n.sum())),
                pa.array(np.append(np.zeros(notable.sum(), bool), True)),
            ],
            names=["member", "n", "all"],
        )

    found = stage(
        docs.select(text_bytes().alias("body"))
        .mapInArrow(count, "member long, n long, all boolean")
        .groupBy("all", "member")
        .agg(F.sum("n").alias("n")),
        "frequent",
    )
    total = found.where("all").agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, -(-total // FREQUENT_SHARE))
    rows = found.where(~F.col("all") & (F.col("n") >= least)).select("member").toArrow()
    return np.sort(rows.column("member").to_numpy().astype(np.int64).view(np.uint64))


def in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def prefix_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """A stored row per document: its set's size, digest, signature and ordered prefix."""
    last = docs.sparkSession.sparkContext.broadcast(frequent_members(docs, k))

    def scan(batches):
        words = Words(SPACES)
        frequent = last.value
        for batch in slices(batches, "body"):
            sizes, d1, d2, signs, prefixes = [], [], [], [], []
            for s in shingle_sets(words(buffers(batch, "body")), k):
                n = len(s)
                sizes.append(n)
                d1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(np.bitwise_xor.reduce(fold(s + np.uint64(1))).view(np.int64)))
                signs.append(signature(s))
                rare = s[~in_sorted(s, frequent)]
                ordered = np.concatenate((rare, s[in_sorted(s, frequent)]))
                p = n - -(-n * percent // 100) + 1 if n else 0
                prefixes.append(ordered[:p].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.array(signs, pa.binary()),
                    pa.array(prefixes, pa.binary()),
                ],
                names=["row", "doc_id", "check", "n", "d1", "d2", "signature", "prefix"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("check"),
        text_bytes().alias("body"),
    )
    schema = (
        f"row long, doc_id {kind}, check long, n long, d1 long, d2 long, "
        "signature binary, prefix binary"
    )
    return stage(read.mapInArrow(scan, schema), "set-prefixes")


def list_entries(reps: DataFrame, members: int) -> DataFrame:
    """``member, node, n, place, shared`` of prefix members that more than one set has.

    ``place`` counts the members before it in its set's order, ``shared`` those of them that are
    in a list as well.
    """
    ranges = 16
    while ranges * LIST_MEMBERS < members:
        ranges *= 2
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def deal(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for node, n, prefix in zip(*[c.to_pylist() for c in batch.columns]):
                tokens = np.frombuffer(prefix, np.uint64)
                where = (tokens >> shift).astype(np.int64)
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.diff(where[order])) + 1
                for part in np.split(order, cuts):
                    out[0].append(int(where[part[0]]))
                    out[1].append(node)
                    out[2].append(n)
                    out[3].append(tokens[part].tobytes())
                    out[4].append(part.astype(np.int32).tobytes())
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)],
                names=["part", "node", "n", "tokens", "places"],
            )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(frame["tokens"]), np.uint64)
        places = np.frombuffer(b"".join(frame["places"]), np.int32)
        counts = frame["tokens"].map(len).to_numpy() // 8
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        same = ordered[1:] == ordered[:-1]
        shared = order[np.append(same, False) | np.insert(same, 0, False)]
        owner = np.repeat(np.arange(len(frame)), counts)[shared]
        return pd.DataFrame(
            {
                "member": tokens[shared].view(np.int64),
                "node": frame["node"].to_numpy()[owner],
                "n": frame["n"].to_numpy()[owner],
                "place": places[shared].astype(np.int64),
            }
        )

    dealt = reps.select("node", "n", "prefix").mapInArrow(
        deal, "part long, node long, n long, tokens binary, places binary"
    )
    met = dealt.groupBy("part").applyInPandas(meet, "member long, node long, n long, place long")
    before = F.row_number().over(Window.partitionBy("node").orderBy("place")) - 1
    return stage(met.withColumn("shared", before), "set-lists")


def needed(na: Column, nb: Column, percent: int) -> Column:
    """Smallest overlap that makes two sets of these sizes alike."""
    return F.ceil((na + nb) * percent / (100 + percent))


def alike(overlap: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (na + nb - overlap)


def room(percent: int) -> Column:
    """Whether sizes and places of two list entries leave room for the overlap needed, if the
    member is the first that the two sets share.

    One meeting a pair is enough, and the first shared member of two alike sets is in the prefixes
    of both, with all of their overlap from there on. Later meetings are not looked at.
    """
    na, nb = F.col("x.n"), F.col("y.n")
    behind = F.least(na - F.col("x.place"), nb - F.col("y.place"))
    return (
        (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        & (behind >= needed(na, nb, percent))
    )


def plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose signatures allow them to be alike, with sizes."""
    of = lambda s: reps.select(
        F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("signature").alias(f"s{s}")
    )

    def bound(batches):
        for batch in batches:
            signs = zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())
            least = np.array([apart(x, y) for x, y in signs], np.int64)
            fits = least <= batch.column(4).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(fits)) for i in range(4)],
                names=["a", "b", "na", "nb"],
            )

    space = F.col("na") + F.col("nb") - 2 * needed(F.col("na"), F.col("nb"), percent)
    return (
        pairs.join(of("a"), "a")
        .join(of("b"), "b")
        .select("a", "b", "na", "nb", space.alias("space"), "sa", "sb")
        .mapInArrow(bound, "a long, b long, na long, nb long")
    )


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the exact size of the two sets' intersection."""

    def count(batches):
        for batch in batches:
            values = [c.to_pylist() for c in batch.columns]
            n = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True))
                for x, y in zip(values[4], values[5])
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(n, pa.int64())],
                names=["a", "b", "na", "nb", "overlap"],
            )

    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("xs")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("members").alias("ys")), "b")
        .select("a", "b", "na", "nb", "xs", "ys")
        .mapInArrow(count, "a long, b long, na long, nb long, overlap long")
    )


def members_of(docs: DataFrame, reps: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``node, members`` of the nodes given: their texts are read again."""

    def scan(batches):
        words = Words(SPACES)
        for batch in slices(batches, "body"):
            sets = [s.tobytes() for s in shingle_sets(words(buffers(batch, "body")), k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["node", "members"]
            )

    wanted = reps.join(nodes, "node").select("node", F.col("doc_id").alias("id"), "check")
    filled = docs.sparkSession.sparkContext.broadcast(cell_filter(wanted, "check", FILTER_BITS))

    def asked(batches):
        cells = filled.value
        for batch in batches:
            check = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(in_cells(cells, check, FILTER_BITS)))

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("check"),
        text_bytes().alias("body"),
    ).mapInArrow(asked, f"id {kind}, check long, body binary")
    same = texts["check"].eqNullSafe(wanted["check"]) & texts["id"].eqNullSafe(wanted["id"])
    return (
        texts.join(wanted, same)
        .select("node", "body")
        .dropDuplicates(["node"])
        .mapInArrow(scan, "node long, members binary")
    )


def jaccard_links(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Membership ``row, doc_id, n_shingles, node`` and links ``a, b, overlap`` between nodes.

    A node is a class of equal sets; empty sets belong to none. Links are all that are needed
    for the components of the full join; a pair already connected is not counted out.
    """
    spark = docs.sparkSession
    rows = prefix_rows(docs, k, percent)
    rows_path = STAGED[-1]
    filled = rows.where("n > 0")
    classes = filled.groupBy("d1", "d2", "n").agg(F.min("row").alias("node"))
    members = filled.select("row", "doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"])
    member_rows = members.select("row", "doc_id", F.col("n").alias("n_shingles"), "node").union(
        rows.where("n = 0").select("row", "doc_id", "n", F.lit(None).cast("long"))
    )
    reps = stage(
        filled.join(classes.select(F.col("node").alias("row")), "row").withColumnRenamed(
            "row", "node"
        ),
        "set-classes",
    )
    member_rows = stage(member_rows, "set-members")
    # Prefixes of all rows are read no more: those of one set of each class are in ``reps``.
    unstage(spark, rows_path)
    total = reps.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    entries = list_entries(reps, total // 8)
    release(spark)

    # Each set with one of its block, where sizes are within a tenth of each other: that with the
    # fewest members of its own, as the text that copies were made from.
    block = F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.1))).alias("block")
    blocks = entries.select("*", block)
    heads = blocks.groupBy("member", "block").agg(
        F.min_by(F.struct(*FIELDS), F.struct(F.col("place") - F.col("shared"), "node")).alias("head")
    )
    heads = heads.select("member", "block", "head.*").alias("x")
    first_pairs = (
        blocks.alias("y")
        .join(heads, ["member", "block"])
        .where((F.col("y.node") != F.col("x.node")) & room(percent))
        .select(*pair())
        .distinct()
    )
    links, tried, roots = None, None, None
    pairs = first_pairs
    for turn in range(ROUNDS):
        plain = stage(plausible(pairs, reps, percent), "set-pairs")
        if turn and plain.isEmpty():
            break
        sets = stage(members_of(docs, reps, endpoints(plain), k), "sets")
        sets_path = STAGED[-1]
        counted = stage(overlaps(plain, sets), "set-overlaps")
        unstage(spark, sets_path)
        release(spark)
        found = counted.where(alike(F.col("overlap"), F.col("na"), F.col("nb"), percent))
        tried = plain if tried is None else tried.union(plain)
        links = found if links is None else links.union(found)
        roots = stage(components(links.select("a", "b")), "roots")
        known = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = other_heads(known.select("*", block), turn, percent).join(
            tried.select("a", "b"), ["a", "b"], "left_anti"
        )
    first = tried

    # The similar set each set was matched with, and how far apart the two are.
    turned = links.select(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na"),
        F.col("na").alias("nb"), "overlap",
    )
    nearest = links.unionByName(turned).groupBy(F.col("b").alias("node")).agg(
        F.max_by(F.struct("a", "na", "nb", "overlap"), F.struct("overlap", "a")).alias("to")
    )
    mixed = (
        known.groupBy("member")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("member")
    )
    open_entries = stage(known.join(mixed, "member"), "set-lists-open")
    release(spark)
    crossing = (
        open_entries.alias("x")
        .join(open_entries.alias("y"), "member")
        .where((F.col("x.root") < F.col("y.root")) & room(percent))
        .select(*pair())
        .distinct()
    )
    # A pair is seen once per component and order of a list; those counted before are settled.
    crossing = crossing.join(first.select("a", "b"), ["a", "b"], "left_anti")
    rest = stage(plausible(crossing, reps, percent), "set-pairs")
    like = lambda s: nearest.select(
        F.col("node").alias(s),
        F.col("to.a").alias(f"r{s}"),
        (F.col("to.nb") - F.col("to.overlap")).alias(f"extra{s}"),
        (F.col("to.na") - F.col("to.overlap")).alias(f"lacks{s}"),
    )
    # Answers of the similar sets first, then what they say about the sets derived from them.
    related = stage(
        rest.join(like("b"), "b", "left")
        .withColumn("rb", F.coalesce("rb", "b"))
        .fillna(0, ["extrab", "lacksb"]),
        "set-pairs",
    )
    asked = related.select("a", F.col("rb").alias("b")).distinct().where("a <> b")
    sized = lambda s: reps.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"))
    asked = asked.join(sized("a"), "a").join(sized("b"), "b").select("a", "b", "na", "nb")
    sets = stage(
        members_of(docs, reps, endpoints(asked).union(endpoints(rest)).distinct(), k), "sets"
    )
    answers = stage(overlaps(asked, sets), "set-overlaps")
    derived = related.join(
        answers.select("a", F.col("b").alias("rb"), F.col("overlap").alias("r_overlap")),
        ["a", "rb"],
    ).withColumns(
        {
            "least": F.col("r_overlap") - F.col("lacksb"),
            "most": F.col("r_overlap") + F.col("extrab"),
        }
    )
    need = needed(F.col("na"), F.col("nb"), percent)
    sure = derived.where(F.col("least") >= need).select("a", "b", F.col("least").alias("overlap"))
    open_pairs = derived.where((F.col("least") < need) & (F.col("most") >= need))
    more = overlaps(open_pairs.select("a", "b", "na", "nb"), sets)
    more = more.where(alike(F.col("overlap"), F.col("na"), F.col("nb"), percent))
    found = links.select("a", "b", "overlap").union(sure).union(more.select("a", "b", "overlap"))
    return member_rows, stage(found, "set-links")


def pair() -> list[Column]:
    """Nodes of two list entries, the smaller as ``a``."""
    nodes = F.col("x.node"), F.col("y.node")
    return [F.least(*nodes).alias("a"), F.greatest(*nodes).alias("b")]


def other_heads(known: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each set in a block with one set of the block's largest component, another
    in every turn, unless it belongs to that component already."""
    heads = (
        known.groupBy("member", "block", "root")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min_by(F.struct(*FIELDS), F.xxhash64("node", F.lit(turn))).alias("entry"),
        )
        .groupBy("member", "block")
        .agg(F.max_by(F.struct("entry", "root"), F.struct("size", "root")).alias("head"))
        .select("member", "block", "head.entry.*", "head.root")
    )
    return (
        known.alias("y")
        .join(heads.alias("x"), ["member", "block"])
        .where((F.col("x.root") != F.col("y.root")) & room(percent))
        .select(*pair())
        .distinct()
    )


def endpoints(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def jaccard_components(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A text's set holds its distinct k-word shingles, or its whole word sequence if shorter;
    null, empty and wordless texts have the empty set and are linked with nothing. The
    component is named by the smallest ``doc_id`` reachable, null ids aside. Rows repeating an
    id are documents of their own. An empty table gives no rows.
    """
    members, links = jaccard_links(docs, k, percent)
    roots = components(links.select("a", "b"))
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = placed.where(F.col("root").isNotNull())
    names = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return linked.join(names, "root").select("doc_id", "n_shingles", "component_id").union(
        placed.where(F.col("root").isNull()).select(
            "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
        )
    )
