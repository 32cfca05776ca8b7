"""Removal of repeated byte strings by column-wise suffix sorting of many texts.

Texts are cut at minimizers: of every window of ``length`` bytes the smallest hash of its grams is
its key, and a stretch of windows with one key is a piece. Equal windows have equal keys, so
repeats are found key by key. A piece met again as a whole is settled by its hash. Pieces of one
key that differ are sorted together: their collection's Burrows-Wheeler transform is built column
by column, one symbol of every piece entering in each round, from the last to the first, and the
common prefixes of neighbouring suffixes are kept up to date with it. Suffixes whose common
prefix reaches ``length`` are the same window. Windows that share their hash with no other of the
collection cannot be repeats, so pieces enter it from their first window that does to their last.

The transform of a collection lives in one task's memory, written anew from front to back each
round: collections are bounded (``COLLECTION`` pieces and the rest of one key), so they need no
files. A key with more pieces than a collection holds is settled window by window instead, with
the smallest document taken before rows are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import (
    STAGED,
    buffers,
    cell_filter,
    fold,
    in_cells,
    release,
    slices,
    stage,
    text_bytes,
)
from pampero.workspace import discard

LENGTH = 50

#: Bytes of text a task cuts at once; pieces one task compares; windows of a piece at most.
CHUNK = 4 << 20
PIECES = 2_000_000
PIECE_WINDOWS = 64

#: Pieces sorted together at least, and of one key at most.
COLLECTION = 8192
HOT_KEY = 65_536

FILTER_BITS = 24
LAST = (1 << 63) - 1
NOT_MET, COVERED, OPEN = 0, 1, 2


class Cutter:
    """Pieces of texts, by polynomial hashes read off prefix sums."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, length: int):
        self.length, self.gram = length, max(length * 2 // 5, 1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.BASE), ("inverses", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def __call__(self, body: bytes):
        """Start, end (of windows), key and hash of the pieces of a text."""
        windows = len(body) - self.length + 1
        if windows <= 0:
            return np.zeros((2, 0), np.int64), *np.zeros((2, 0), np.uint64)
        raw = np.frombuffer(body, np.uint8)
        self._reach(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=sums[1:])
        grams = len(raw) - self.gram + 1
        least = fold((sums[self.gram :] - sums[:grams]) * self.inverses[:grams])
        span, width = 1, self.length - self.gram + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        runs = np.diff(np.append(starts, windows))
        if (runs > PIECE_WINDOWS).any():
            starts = np.concatenate(
                [np.arange(s, s + n, PIECE_WINDOWS) for s, n in zip(starts, runs)]
            )
        ends = np.append(starts[1:], windows)
        stop = ends + self.length - 1
        hashes = (sums[stop] - sums[starts]) * self.inverses[starts]
        hashes = fold(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return np.stack((starts, ends)), least[starts], hashes


    def sharing(self, strings: list[bytes]) -> list[tuple[int, int, int]]:
        """Strings with windows whose hash occurs again among all of theirs, and the first and last
        of these windows: no other can be in common with one."""
        lengths = np.array([len(s) for s in strings])
        raw = np.frombuffer(b"".join(strings), np.uint8)
        self._reach(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=sums[1:])
        counts = np.maximum(lengths - self.length + 1, 0)
        owner = np.repeat(np.arange(len(strings)), counts)
        begins = np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts)
        at = np.arange(len(owner)) + begins[owner]
        hashes = (sums[at + self.length] - sums[at]) * self.inverses[at]
        order = np.argsort(hashes)
        again = np.diff(hashes[order]) == 0
        met = np.zeros(len(owner), bool)
        met[order[:-1][again]] = met[order[1:][again]] = True
        met = np.flatnonzero(met)
        strings_met, first = np.unique(owner[met], return_index=True)
        last = np.append(first[1:], len(met)) - 1
        begin = (np.cumsum(lengths) - lengths)[strings_met]
        return list(
            zip(strings_met.tolist(), (at[met[first]] - begin).tolist(), (at[met[last]] - begin).tolist())
            if len(met)
            else ()
        )


#: A piece as it is dealt: four bytes of its key, which only bring pieces together, and all of
#: its hash, which tells whether they are the same.
PIECE = np.dtype([("key", "<u4"), ("hash", "<u8")])


def pack(keys: np.ndarray, hashes: np.ndarray) -> bytes:
    pieces = np.empty(len(keys), PIECE)
    pieces["key"], pieces["hash"] = keys & np.uint64(0xFFFFFFFF), hashes
    return pieces.tobytes()


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    pieces = np.frombuffer(body, PIECE)
    return pieces["key"], pieces["hash"]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys >> np.uint64(40)).astype(np.int64) % parts


CUT = "part long, ranks binary, variants binary, counts binary, pieces binary"
FLAGS = "rank long, variant long, part long, flags binary"


def cut_texts(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """Pieces of texts ``rank, variant, body``, dealt to parts by key; many texts in a row.

    Pieces equal to one of a smaller document in the same chunk are settled here: their numbers
    go to a part below zero, whose rows are passed on.
    """

    def cut(batches):
        cutter = Cutter(length)
        held, size = [], 0
        for batch in slices(batches, "body"):
            columns = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), buffers(batch, "body"))
            for rank, variant, body in columns:
                _, keys, hashes = cutter(body)
                held.append((rank, variant, keys, hashes))
                size += len(body)
            if size >= CHUNK:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    def rows(held):
        counts = np.array([len(h[2]) for h in held])
        doc = np.repeat(np.arange(len(held)), counts)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        ranks = np.array([h[0] for h in held], np.int64)
        variants = np.array([h[1] for h in held], np.int64)
        keys = np.concatenate([h[2] for h in held])
        hashes = np.concatenate([h[3] for h in held])
        same = fold(keys + fold(hashes))
        order = np.lexsort((ranks[doc], same))
        new = np.append(True, same[order][1:] != same[order][:-1])
        least = ranks[doc[order]][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        settled = np.zeros(len(doc), bool)
        settled[order] = ranks[doc[order]] > least
        out = [[], [], [], [], []]

        def add(part, of, body):
            docs, n = np.unique(of, return_counts=True)
            for column, value in zip(
                out, (part, ranks[docs].tobytes(), variants[docs].tobytes(), n.astype(np.int32).tobytes(), body)
            ):
                column.append(value)

        own = np.flatnonzero(settled)
        if len(own):
            add(-1 - int(fold(same[:1])[0] % np.uint64(parts)), doc[own], number[own].astype(np.uint32).tobytes())
        left = np.flatnonzero(~settled)
        where = part_of(keys[left], parts)
        by_part = np.argsort(where, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(where[by_part]) != 0)) if len(left) else []
        for group in np.split(left[by_part], edges[1:]) if len(left) else []:
            add(int(part_of(keys[group[:1]], parts)[0]), doc[group], pack(keys[group], hashes[group]))
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds)],
            names=["part", "ranks", "variants", "counts", "pieces"],
        )

    return texts.select("rank", "variant", "body").mapInArrow(cut, CUT)


def compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Flags of all pieces of a part: whether each is met whole in a smaller document, or has a
    key in common with other pieces and is the first of its kind."""
    part = int(frame["part"].iloc[0])
    ranks = np.frombuffer(b"".join(frame["ranks"]), np.int64)
    variants = np.frombuffer(b"".join(frame["variants"]), np.int64)
    counts = np.frombuffer(b"".join(frame["counts"]), np.int32)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    body = b"".join(frame["pieces"])
    if part < 0:
        cells = [body[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:])]
        return pd.DataFrame({"rank": ranks, "variant": variants, "part": -1, "flags": cells})
    keys, hashes = unpack(body)
    rank = np.repeat(ranks, counts)
    order = np.lexsort((rank, hashes, keys))
    k, h, r = keys[order], hashes[order], rank[order]
    new_key = np.append(True, k[1:] != k[:-1])
    new = new_key | np.append(True, h[1:] != h[:-1])
    place = np.arange(len(order))
    least = r[np.maximum.accumulate(np.where(new, place, 0))]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))
    several = np.repeat(kinds > 1, np.diff(np.append(np.flatnonzero(new_key), len(order))))
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.where(r > least, COVERED, np.where(several, OPEN, NOT_MET))
    met = np.flatnonzero(np.logical_or.reduceat(flags > 0, bounds[:-1]))
    cells = flags.tobytes()
    return pd.DataFrame(
        {
            "rank": ranks[met],
            "variant": variants[met],
            "part": part,
            "flags": [cells[bounds[i] : bounds[i + 1]] for i in met],
        }
    )


def document_flags(keys: np.ndarray, told: list[dict], parts: int) -> np.ndarray:
    """Flags of a document's pieces in their order, from those its parts gave."""
    flags = np.zeros(len(keys), np.uint8)
    for t in told:
        if t["part"] < 0:
            flags[np.frombuffer(t["flags"], np.uint32)] = COVERED
    left = np.flatnonzero(flags == NOT_MET)
    where = part_of(keys[left], parts)
    for t in told:
        if t["part"] >= 0:
            flags[left[where == t["part"]]] = np.frombuffer(t["flags"], np.uint8)
    return flags


# --- column-wise construction ----------------------------------------------------------------


class Collection:
    """Burrows-Wheeler transform and common prefixes of a collection of byte strings.

    ``symbols[i]`` stands before the i-th smallest suffix, 0 if none does; ``common[i]`` is the
    common prefix of suffix i with the one before it; ``owner`` and ``size`` tell the suffix.
    """

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings])
        m, longest = len(strings), int(self.lengths.max(initial=0))
        # Column c holds the symbol c places from the end of each string, from 1 up; 0 is none.
        columns = np.zeros((longest + 1, m), np.uint16)
        for i, s in enumerate(strings):
            columns[: len(s), i] = np.frombuffer(s, np.uint8)[::-1].astype(np.uint16) + 1
        self.symbols = columns[0].copy() if m else np.zeros(0, np.uint16)
        self.common = np.zeros(m, np.uint16)
        self.owner = np.arange(m, dtype=np.int32)
        self.size = np.zeros(m, np.uint16)
        self.place = np.arange(m)  # of each string's newest suffix
        for c in range(1, longest + 1):
            self._insert(columns[c], np.flatnonzero(self.lengths >= c), c)

    def _insert(self, before: np.ndarray, active: np.ndarray, size: int) -> None:
        """Enter the suffix of ``size`` symbols of every active string."""
        m = len(self.lengths)
        order = np.argsort(self.symbols, kind="stable")
        ended = int(np.count_nonzero(self.symbols == 0))
        order = order[ended:]  # the suffix m + r is the symbol before suffix order[r], and it
        rank = np.empty(len(self.symbols), np.int64)
        rank[order] = np.arange(len(order))
        new = m + rank[self.place[active]]
        total = m + len(order)
        fresh = np.zeros(total, bool)
        fresh[new] = True

        # Common prefixes change at the new suffixes and at those right behind them.
        touched = np.flatnonzero(fresh | np.append(False, fresh[:-1]))
        r = touched[touched >= m] - m
        here = order[r]
        previous = order[np.maximum(r - 1, 0)]
        alike = (r > 0) & (self.symbols[here] == self.symbols[previous])
        common = np.zeros(len(r), np.uint16)
        if alike.any():
            ranges = np.stack((previous[alike] + 1, here[alike] + 1), axis=1).ravel()
            padded = np.append(self.common, 0)
            common[alike] = np.minimum.reduceat(padded, ranges)[::2] + 1

        def enter(old, values):
            out = np.empty(total, old.dtype)
            out[~fresh] = old
            out[new] = values
            return out

        at = np.empty(len(self.lengths), np.int64)
        at[active] = new
        self.symbols = enter(self.symbols, before[active])
        self.common = enter(self.common, 0)
        self.common[r + m] = common
        self.owner = enter(self.owner, active)
        self.size = enter(self.size, size)
        self.place[active] = new
        # Suffixes of strings that have ended have moved as well.
        rest = np.flatnonzero(self.lengths < size)
        if len(rest):
            old_to_new = np.flatnonzero(~fresh)
            self.place[rest] = old_to_new[self.place[rest]]

    def repeated(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """String and start of each window of ``length`` that a smaller rank has too."""
        linked = self.common >= length
        groups = np.cumsum(~linked)
        inside = linked | np.append(linked[1:], False)
        at = np.flatnonzero(inside)
        if not len(at):
            return np.zeros((2, 0), np.int64)
        starts = np.flatnonzero(np.append(True, np.diff(groups[at]) != 0))
        rank = ranks[self.owner[at]]
        least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(at))))
        own = self.owner[at[rank > least]]
        return own.astype(np.int64), self.lengths[own] - self.size[at[rank > least]]


def windows_to_spans(starts: np.ndarray, ends: np.ndarray, length: int):
    """Maximal byte runs under stretches of covered windows [start, end)."""
    order = np.argsort(starts, kind="stable")
    low, high = starts[order], np.maximum.accumulate(ends[order] + length - 1)
    new = np.append(True, low[1:] > high[:-1]) if len(low) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return low[first], high[np.append(first[1:], len(low)) - 1] if len(low) else high


# --- the operator ----------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
    smaller ``doc_id``; a document without id comes after all others. Texts are UTF-8 bytes, null
    is empty. Rows that repeat an id are parts of one document and do not touch each other. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"),
            F.xxhash64(text).alias("check"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        ),
        "texts",
    )
    # Of equal texts the first is looked at; all of a later one has been met. A text is told
    # by its rank and its hash, since an id may have several.
    firsts = stage(
        rows.groupBy("digest").agg(
            F.min("rank").alias("rank"),
            F.first("check").alias("variant"),
            F.first("n_bytes").alias("n_bytes"),
        ),
        "first-texts",
    )
    looked = firsts.where(F.col("n_bytes") >= length)
    total = looked.agg(F.sum("n_bytes")).first()[0] or 0
    pieces = total // max((length - length * 2 // 5) // 2, 1)
    parts = 16
    while parts * PIECES < pieces:
        parts *= 2

    flags = stage(
        cut_texts(all_texts(docs), length, parts)
        .groupBy("part")
        .applyInPandas(compare, FLAGS),
        "piece-flags",
    )
    flags_path = STAGED[-1]
    told = flags.groupBy("rank", "variant").agg(
        F.collect_list(F.struct("part", "flags")).alias("told")
    )
    met = looked.join(told.select("rank", "variant"), ["rank", "variant"])
    release(spark)
    opened = stage(open_pieces(read_texts(docs, met), told, length, parts), "met-texts")
    # Shuffled texts and pieces are let go of before others are shuffled.
    del told, met, flags
    discard(spark, flags_path)
    release(spark)
    found = repeats_of(opened, length)
    starts = stage(
        found.groupBy("rank", "variant").agg(F.collect_set("start").alias("more")), "repeat-starts"
    )
    del found
    release(spark)
    results = measured(opened, starts, length)

    whole = (F.col("rank") > F.col("first")) & (F.col("n_bytes") >= length)
    named = firsts.select("digest", F.col("rank").alias("first"), "variant")
    joined = rows.join(named, "digest").join(
        results.withColumnRenamed("rank", "first"), ["first", "variant"], "left"
    )
    own = F.when(F.col("rank") == F.col("first"), F.col("removed"))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce(own, F.lit(0))).alias("n_removed"),
        F.when(whole, 1)
        .otherwise(F.coalesce(F.when(F.col("rank") == F.col("first"), F.col("spans")), F.lit(0)))
        .cast("long")
        .alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(
            F.coalesce(
                F.when(F.col("rank") == F.col("first"), F.col("kept")), F.lower(F.hex("digest"))
            )
        )
        .alias("kept_sha256"),
    )


def all_texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("variant"),
        text_bytes().alias("body"),
    )


def read_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rank, variant, body`` of the texts wanted, by ``rank, variant``.

    Texts nobody wants mostly stay behind before the join. A row that repeats id and text
    gives its text again, which changes nothing that is counted from it.
    """
    filled = docs.sparkSession.sparkContext.broadcast(cell_filter(wanted, "variant", FILTER_BITS))

    def asked(batches):
        cells = filled.value
        for batch in batches:
            check = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(in_cells(cells, check, FILTER_BITS)))

    texts = all_texts(docs).mapInArrow(asked, "rank long, variant long, body binary")
    return texts.join(wanted.select("rank", "variant"), ["rank", "variant"])


OPENED = (
    "rank long, variant long, body binary, starts binary, ends binary, "
    "open array<struct<key:long,start:long,size:long>>"
)


def open_pieces(texts: DataFrame, told: DataFrame, length: int, parts: int) -> DataFrame:
    """Texts with the windows settled so far, and their pieces still open."""

    def cut(batches):
        cutter = Cutter(length)
        for batch in slices(batches, "body"):
            starts, ends, opened = [], [], []
            for body, flags in zip(buffers(batch, "body"), batch.column(3).to_pylist()):
                spans, keys, _ = cutter(body)
                flag = document_flags(keys, flags, parts)
                covered = spans[:, flag == COVERED]
                starts.append(covered[0].tobytes())
                ends.append(covered[1].tobytes())
                opened.append(
                    [
                        {"key": k, "start": a, "size": b + length - 1 - a}
                        for k, a, b in zip(
                            keys[flag == OPEN].view(np.int64).tolist(),
                            *spans[:, flag == OPEN].tolist(),
                        )
                    ]
                )
            kind = pa.list_(
                pa.struct([("key", pa.int64()), ("start", pa.int64()), ("size", pa.int64())])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(starts, pa.binary()),
                    pa.array(ends, pa.binary()),
                    pa.array(opened, kind),
                ],
                names=["rank", "variant", "body", "starts", "ends", "open"],
            )

    return (
        texts.join(told, ["rank", "variant"])
        .select("rank", "variant", "body", "told")
        .mapInArrow(cut, OPENED)
    )


FOUND = "rank long, variant long, start long"


def repeats_of(opened: DataFrame, length: int) -> DataFrame:
    """``rank, variant, start`` of open windows that a smaller document has too."""
    spots = opened.select("rank", "variant", "body", F.explode("open").alias("o"))
    first, size = F.col("o.start").cast("int") + 1, F.col("o.size").cast("int")
    pieces = spots.select(
        "rank", "variant", "o.key", "o.start", F.substring("body", first, size).alias("text")
    )
    sizes = spots.select("o.key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # At most one piece in HOT_KEY is such a key, so that every task gets them and no text is
    # shuffled to be told apart.
    hot = stage(sizes.where(F.col("n") > HOT_KEY).select("key"), "hot-keys")
    some_hot = not hot.isEmpty()
    parts = int(opened.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sort(batches):
        held, last = [], None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if len(held) >= COLLECTION and row[0] != last:
                    yield settle(held)
                    held = []
                last = row[0]
                held.append(row)
        if held:
            yield settle(held)

    cutter = Cutter(length)

    def settle(held):
        # Of each piece, the stretch from its first to its last window that may be met.
        held = [
            (*held[i][:3], held[i][3] + a, held[i][4][a : b + length])
            for i, a, b in cutter.sharing([h[4] for h in held])
        ]
        ranks = np.array([h[1] for h in held], np.int64)
        owner, start = Collection([h[4] for h in held]).repeated(length, ranks)
        variants = np.array([h[2] for h in held], np.int64)
        offsets = np.array([h[3] for h in held], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(ranks[owner]), pa.array(variants[owner]), pa.array(offsets[owner] + start)],
            names=["rank", "variant", "start"],
        )

    cold = pieces.join(F.broadcast(hot), "key", "left_anti") if some_hot else pieces
    by_key = (
        cold.select("key", "rank", "variant", "start", "text")
        .repartition(parts, "key")
        .sortWithinPartitions("key")
    )
    sorted_repeats = by_key.mapInArrow(sort, FOUND)
    if not some_hot:
        return sorted_repeats

    at = F.explode(F.sequence(F.lit(0), F.length("text") - length)).alias("at")
    windows = (
        pieces.join(F.broadcast(hot), "key")
        .select("rank", "variant", "start", "text", at)
        .select(
            "rank",
            "variant",
            (F.col("start") + F.col("at")).alias("start"),
            F.substring("text", F.col("at") + 1, F.lit(length)).alias("window"),
        )
    )
    least = windows.groupBy("window").agg(F.min("rank").alias("least"))
    counted = windows.join(least, "window").where(F.col("rank") > F.col("least"))
    return sorted_repeats.union(counted.select("rank", "variant", "start"))


def measured(opened: DataFrame, starts: DataFrame, length: int) -> DataFrame:
    """``rank, variant, removed, spans, kept`` of the texts met elsewhere; ``starts`` has the
    repeated windows of each as ``more``."""

    def measure(batches):
        for batch in slices(batches, "body"):
            out = [[], [], []]
            for body, starts, ends, more in zip(
                buffers(batch, "body"), *[batch.column(i).to_pylist() for i in (3, 4, 5)]
            ):
                extra = np.array(more or [], np.int64)
                low, high = windows_to_spans(
                    np.concatenate((np.frombuffer(starts, np.int64), extra)),
                    np.concatenate((np.frombuffer(ends, np.int64), extra + 1)),
                    length,
                )
                kept = hashlib.sha256()
                at = 0
                for a, b in zip(low, high):
                    kept.update(body[at:a])
                    at = b
                kept.update(body[at:])
                out[0].append(int((high - low).sum()))
                out[1].append(len(low))
                out[2].append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.string()),
                ],
                names=["rank", "variant", "removed", "spans", "kept"],
            )

    return (
        opened.select("rank", "variant", "body", "starts", "ends")
        .join(starts, ["rank", "variant"], "left")
        .mapInArrow(measure, "rank long, variant long, removed long, spans long, kept string")
        .dropDuplicates(["rank", "variant"])
    )
