"""Target-distribution importance resampling: draw documents that look like a target set.

Features are runs of one to three words. Each falls into one of ``buckets`` by the CRC-32 of its
bytes; a bucket's gain is the logarithm of how much likelier the target holds it than the corpus;
a document's weight is the sum of the gains of its features, and the documents drawn are those of
highest weight plus Gumbel noise, which draws without replacement in proportion to likelihood.

CRCs are worked out for many features at once. The distinct features of a slice of texts are
grouped by length, each length is a matrix of bytes with a row a feature, and one step of the CRC
takes a whole column of it: as many steps as a feature has bytes, however many features there
are. Results are scattered back to where the features occur.

Buckets are worked out once per text and stored, two bytes a feature; their sums over the corpus
are one row a bucket, and so are the gains, whatever the corpus holds. Documents are numbered by
score without gathering them (`ranks`).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import Words, buffers, slices, stage, text_bytes
from pampero.llm.ranks import ranked

#: Bytes of ASCII that are neither letters nor digits.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Features of more bytes, of which no column would hold many, are taken one by one.
LONG = 256


def crc_table() -> np.ndarray:
    """The CRC-32 of every byte, reflected, by its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table.astype(np.uint32)


def crc_columns(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings of ``raw`` at ``starts``, matrices of equal length in turn."""
    crcs = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:])):
        if size > LONG:
            for i in rows.tolist():
                crcs[i] = zlib.crc32(raw[starts[i] : starts[i] + size].tobytes())
            continue
        # A byte position a row, so that a step reads its column in one go.
        matrix = raw[starts[rows][None, :] + np.arange(size)[:, None]]
        state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix:
            state = table[(state ^ column) & 0xFF] ^ (state >> 8)
        crcs[rows] = ~state
    return crcs


class Features:
    """Buckets of all word runs of many texts at once."""

    def __init__(self, longest: int, buckets: int):
        self.words, self.table = Words(SEPARATORS), crc_table()
        self.longest, self.buckets = longest, buckets

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Number of words of each text, and its features' buckets, those of one word first."""
        table = self.words(texts)
        n = len(table.hashes)
        # The words with one space behind each, so that a feature is one stretch of bytes.
        raw = np.frombuffer(table.buf, np.uint8)
        kept = self.words.inside[raw]
        kept[table.ends] = True
        joined = np.where(self.words.inside[raw], raw, np.uint8(0x20))[kept]
        size = table.ends - table.starts
        starts = np.cumsum(size + 1) - size - 1
        ends = starts + size
        counts = np.diff(table.first)
        found = []
        for k in range(1, self.longest + 1):
            here = np.maximum(counts - k + 1, 0)
            at = np.repeat(table.first[:-1] - (np.cumsum(here) - here), here) + np.arange(here.sum())
            if not len(at):
                found.append((here, np.zeros(0, np.uint16)))
                continue
            # Runs with equal 64-bit hashes are worked out once.
            grams = table.grams(k) if k > 1 else table.hashes
            _, one, back = np.unique(grams[at], return_index=True, return_inverse=True)
            one = at[one]
            crcs = crc_columns(joined, starts[one], ends[np.minimum(one + k - 1, n - 1)] - starts[one], self.table)
            found.append((here, (crcs % np.uint32(self.buckets)).astype(np.uint16)[back]))
        parts = [np.split(b, np.cumsum(here)[:-1]) for here, b in found]
        return counts, [np.concatenate(p) for p in zip(*parts)]


def bucketed(docs: DataFrame, id_column: str, longest: int, buckets: int) -> DataFrame:
    """``id, n_words, n_features, buckets`` of every row, the last as unsigned 16-bit integers."""
    rows = docs.select(F.col(id_column).alias("id"), text_bytes().alias("body"))
    result = rows.select("id").schema.add("n_words", "long").add("n_features", "long").add("buckets", "binary")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        for batch in slices(batches, "body"):
            n_words, found = features(buffers(batch, "body"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([f.astype("<u2").tobytes() for f in found], pa.binary()),
                ],
                ["id", "n_words", "n_features", "buckets"],
            )

    return rows.mapInArrow(count, result)


def bucket_sums(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket over all rows; one row a bucket and task is shuffled, one row a
    bucket reaches the driver."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(buffers(batch, "buckets")), "<u2")
            sums += np.bincount(held, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["bucket", "n"])

    parts = features.select("buckets").mapInArrow(total, "bucket long, n long")
    sums = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        sums[bucket] = n
    return sums


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of how much likelier the target holds a bucket, rounded down;
    one is added to every count."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(seed: str, doc_id: object) -> int:
    """A thousand times a Gumbel variate, rounded down, fixed by the seed and an id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gains: np.ndarray, seed: str) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    # A broadcast is unpickled by reference, so executors get plain bytes.
    shared = features.sparkSession.sparkContext.broadcast(gains.astype("<i8").tobytes())
    result = features.select(F.col("id").alias("doc_id"), "n_words", "n_features").schema
    result = result.add("weight", "long").add("score", "long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(shared.value, "<i8")
        for batch in batches:
            weights = [int(gain[np.frombuffer(b, "<u2")].sum()) for b in buffers(batch, "buckets")]
            noise = [gumbel(seed, i) for i in batch.column(0).to_pylist()]
            scores = [w + g for w, g in zip(weights, noise)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                result.names,
            )

    return features.mapInArrow(score, result)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    longest: int = 3,
    buckets: int = 10_000,
    seed: str = "42",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the N documents with at least ``min_words`` words, the ``floor(percent * N / 100)`` of
    highest score are drawn, ties to the smaller ``doc_id``, null last; ``rank`` counts them
    from 1 and is null for all others. ``target`` needs a column ``text``.

    Words are lower-cased in A-Z and parted by ASCII other than letters and digits. A null or
    empty text has no words, weight 0 and is not drawn while ``min_words`` is positive; its score
    is the noise alone. A null ``doc_id`` takes the noise of an empty id. Rows repeating an id
    have the same noise and are ranked each. With an empty target, or an empty table of documents,
    gains come from the added ones. ``buckets`` is at most 65,536. Other columns are not read.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are stored as unsigned 16-bit integers")
    features = stage(bucketed(docs, "doc_id", longest, buckets), "features")
    wanted = bucketed(target.select(F.lit(None).cast("long").alias("id"), "text"), "id", longest, buckets)
    gains = bucket_gains(bucket_sums(features, buckets), bucket_sums(wanted, buckets))
    told = stage(scored(features, gains, seed), "scored")
    enough = F.col("n_words") >= min_words
    drawn = told.where(enough).count() * percent // 100
    order = [
        F.col("score").desc(),
        F.col("doc_id").asc_nulls_last(),
        F.col("weight").desc(),
        F.col("n_features"),
        F.col("n_words"),
    ]
    placed = ranked(told.where(enough), order)
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(told.where(~enough).withColumn("rank", F.lit(None).cast("long")))
