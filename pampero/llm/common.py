"""Helpers the operators share: session settings, Arrow batches, hashing of words in bulk.

Every operator reads only the columns it names, by selecting them first, so further columns of
any name do not disturb it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.workspace import discard, new_path, release  # noqa: F401

#: Bytes of text handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 1 << 18


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: small Arrow batches, so that a task holds few
    megabytes of text at a time, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a relation once into the shared folder and return it as a table scan.

    What is read by several later steps is worked out once, numbers given to rows stay what they
    are, and a lost executor costs a re-read. Texts make up most of it, hence the dense codec.
    """
    path = new_path(df.sparkSession, name)
    STAGED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables staged, in order, for whoever knows when they are not needed any more.
STAGED: list[str] = []


def unstage(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nobody needs any more."""
    discard(spark, path)
    if path in STAGED:
        STAGED.remove(path)


class Shared:
    """A value all tasks read. It is sent as bytes that hold the code of its classes too, so that
    executors need no copy of the package; a broadcast by itself names classes only."""

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return pickle.loads(self.held.value)


def text_bytes(column: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null is empty."""
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named binary column holds about ``SLICE_BYTES`` in each."""
    for batch in batches:
        sizes = np.fromiter((len(x) for x in buffers(batch, column)), np.int64, batch.num_rows)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def buffers(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A binary column as bytes objects; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def fold(h: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every bit depends on all (the splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cell_filter(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2**bits cells hold a value of a column of 64-bit hashes, packed.

    Its size does not depend on how many values there are: with more, more cells are filled
    and more strangers pass; no value is ever missed.
    """
    cell = F.shiftrightunsigned(column, 64 - bits) + 1
    rows = (
        df.groupBy(F.bitmap_bucket_number(cell).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
        .collect()
    )
    filled = np.zeros(1 << bits >> 3, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        start = (r["bucket"] - 1) * len(part)
        filled[start : start + len(part)] = part
    return filled


def in_cells(filled: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the cells of hashes are filled."""
    cell = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return ((filled[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)


class Words:
    """Words of many texts at once, lower-cased in A-Z, with a 64-bit hash each.

    ``separators`` are the byte values no word contains. The hash of a word is a polynomial in
    its bytes, read off prefix sums, so no Python object is made per word.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, separators: bytes):
        self.lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
        inside = np.ones(256, bool)
        inside[list(separators)] = False
        self.inside = inside
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.BASE), ("inverses", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def __call__(self, texts: list[bytes]) -> WordTable:
        buf = b" ".join(texts).translate(self.lower) + b" "
        raw = np.frombuffer(buf, np.uint8)
        inside = self.inside[raw]
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(raw) and inside[0]:
            change = np.concatenate(([0], change))
        starts, ends = change[0::2], change[1::2]
        self._reach(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=sums[1:])
        hashes = fold((sums[ends] - sums[starts]) * self.inverses[starts])
        edges = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=edges[1:])
        first = np.searchsorted(starts, edges)
        return WordTable(buf, starts, ends, hashes, first)


class WordTable:
    """``first[d]`` to ``first[d + 1]`` are the words of text d."""

    def __init__(self, buf, starts, ends, hashes, first):
        self.buf, self.starts, self.ends = buf, starts, ends
        self.hashes, self.first = hashes, first

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]]

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; meaningless where fewer follow in the text."""
        h = self.hashes
        n = max(len(h) - k + 1, 0)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
        return fold(total)
