"""Benchmark decontamination by winnowing.

A text's k-grams of words are hashed, and of every w consecutive ones the smallest hash is kept.
With k + w - 1 = L, any L words that two texts share hold w whole k-grams, of which both texts
keep the same smallest one: no shared window of L words can be missed. Kept grams of documents
that are also kept in the benchmark are joined with the benchmark's, and each meeting is extended
word by word to both sides, which decides by the words themselves.

Items shorter than the window are windows of their own length, so documents are winnowed once
for each length that the benchmark has, ten at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import (
    Words,
    buffers,
    cell_filter,
    fold,
    in_cells,
    slices,
    stage,
    text_bytes,
)

WINDOW = 10

#: Bytes below 0x80 that no word contains: all but digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())

#: Cells of the filter over the benchmark's grams: 2 MB however large the benchmark is. Fuller
#: cells let more grams of documents reach the join; none is lost.
FILTER_BITS = 24

CONTEXT = "fp long, span int, before string, after string"


def winnow(hashes: np.ndarray, first: np.ndarray, w: int) -> np.ndarray:
    """Positions of grams that are smallest in one of the windows of w grams they lie in.

    ``first[d]`` to ``first[d + 1]`` are the grams of text d; windows do not cross texts, and
    of equal smallest grams in a window all are kept.
    """
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = hashes[:n].copy()
    for j in range(1, w):
        np.minimum(least, hashes[j : j + n], out=least)
    whole = np.ones(n, bool)
    for edge in first[1:-1]:
        whole[max(edge - w + 1, 0) : edge] = False
    kept = np.zeros(len(hashes), bool)
    for j in range(w):
        kept[j : j + n] |= whole & (hashes[j : j + n] == least)
    return np.flatnonzero(kept)


def fingerprints(table, span: int):
    """Fingerprint, text, and word position of every winnowed gram for windows of ``span``."""
    k = (span + 1) // 2
    grams = table.grams(k)
    lengths = np.diff(table.first)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(grams)]
    # Grams that reach into the next text are none.
    real = np.arange(len(grams)) + k <= table.first[1:][owner]
    grams, owner, place = grams[real], owner[real], np.flatnonzero(real)
    first = np.searchsorted(owner, np.arange(len(lengths) + 1))
    picked = winnow(grams, first, span - k + 1)
    owner, place = owner[picked], place[picked]
    return fold(grams[picked] ^ np.uint64(span)), owner, place - table.first[owner], place


def context(table, d: int, place: int, span: int) -> tuple[str, str]:
    """The words that a window of ``span`` around the gram can reach: those before it, nearest
    first, and the gram with those after it."""
    k = (span + 1) // 2
    low, high = table.first[d], table.first[d + 1]
    before = [table.word(i) for i in range(place - 1, max(low, place - span + k) - 1, -1)]
    after = [table.word(i) for i in range(place, min(high, place + span))]
    return b" ".join(before).decode(), b" ".join(after).decode()


def common_words(a: str, b: str) -> int:
    """How many words both begin with. Words hold any sign beyond ASCII, so that only the blanks
    put between them part them."""
    n = 0
    for x, y in zip(a.split(" ") if a else [], b.split(" ") if b else []):
        if x != y:
            break
        n += 1
    return n


def benchmark_contexts(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, fp, span, before, after`` of every fingerprint of every item."""

    def read(batches):
        words = Words(SEPARATORS)
        for batch in slices(batches, "body"):
            ids = batch.column(0).to_pylist()
            table = words(buffers(batch, "body"))
            lengths = np.diff(table.first)
            rows = []
            for span in {min(int(n), window) for n in lengths if n}:
                for fp, d, _, place in zip(*fingerprints(table, span)):
                    if min(lengths[d], window) == span:
                        pair = context(table, d, int(place), span)
                        rows.append((ids[d], int(fp.view(np.int64)), span, *pair))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["item_id", "fp", "span", "before", "after"],
            )

    items = benchmark.select(F.col("item_id").cast("long"), text_bytes().alias("body"))
    return items.mapInArrow(read, f"item_id long, {CONTEXT}").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``
    and ``hit_spans``, the stretches of hit words as (start, end).

    Null and empty texts have no words and are clean; an item without words hits nothing; an
    item without id hits words but is not listed. Rows repeating an id are judged each. With
    an empty benchmark all documents are clean; an empty table gives no rows.
    """
    spark = docs.sparkSession
    contexts = stage(benchmark_contexts(benchmark, window), "benchmark-grams")
    spans = [r[0] for r in contexts.select("span").distinct().collect()]  # 1 to window
    filled = spark.sparkContext.broadcast(cell_filter(contexts, "fp", FILTER_BITS))

    def scan(batches):
        words = Words(SEPARATORS)
        cells = filled.value
        for batch in slices(batches, "body"):
            table = words(buffers(batch, "body"))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for span in spans:
                fps, owner, pos, place = fingerprints(table, span)
                for i in np.flatnonzero(in_cells(cells, fps, FILTER_BITS)):
                    before, after = context(table, owner[i], int(place[i]), span)
                    found[owner[i]].append(
                        {"fp": int(fps[i].view(np.int64)), "span": span, "pos": int(pos[i]),
                         "before": before, "after": after}
                    )
            meeting = pa.struct(
                [("fp", pa.int64()), ("span", pa.int32()), ("pos", pa.int64()),
                 ("before", pa.string()), ("after", pa.string())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(table.first), pa.int64()),
                    pa.array(found, pa.list_(meeting)),
                ],
                names=["row", "doc_id", "n_words", "meetings"],
            )

    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", text_bytes().alias("body")
    ).mapInArrow(
        scan,
        f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
        "meetings array<struct<fp:long,span:int,pos:long,before:string,after:string>>",
    )
    rows = stage(scanned, "document-grams")

    meetings = rows.select("row", F.explode("meetings").alias("m")).select("row", "m.*")
    # Items that share a stretch of words meet a document once, as its context.
    stretch = F.xxhash64("fp", "span", "before", "after")
    owners = contexts.select(stretch.alias("stretch"), "item_id")
    distinct = contexts.select(
        "fp", "span", F.col("before").alias("b"), F.col("after").alias("a"), stretch.alias("stretch")
    ).distinct()

    def extend(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = common_words(r["before"], r["b"]), common_words(r["after"], r["a"])
                if right >= (r["span"] + 1) // 2 and left + right >= r["span"]:
                    out.append((r["row"], r["pos"] - left, r["pos"] + right, r["stretch"]))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["row", "start", "end", "stretch"]
            )

    hits = stage(
        meetings.join(distinct, ["fp", "span"])
        .select("row", "pos", "span", "before", "after", "b", "a", "stretch")
        .mapInArrow(extend, "row long, start long, end long, stretch long"),
        "benchmark-hits",
    )
    ranges = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("ranges")
    )
    spans_of = ranges.select("row", merged_ranges("ranges").alias("hit_spans"))
    items = (
        hits.select("row", "stretch")
        .distinct()
        .join(owners, "stretch")
        .select("row", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    none = F.array().cast("array<struct<start:long,end:long>>")
    joined = (
        rows.select("row", "doc_id", "n_words")
        .join(spans_of, "row", "left")
        .join(items, "row", "left")
        .withColumn("hit_spans", F.coalesce("hit_spans", none))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "hit_spans",
    )


def merged_ranges(column: str):
    """Sorted ranges with those that touch or overlap made one."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def step(done, r):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end")
        )
        return F.when(
            (F.size(done) > 0) & (r["start"] <= last["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(column, empty, step)
