"""Periodic runs of words: stretches in which the same few words come round four times or more.

A word of a qualifying run comes back once a period, so inside the run it occurs at least as
often as the run has whole periods. Words too rare for that within their segment can lie in no
run: they split the segment, and the pieces are looked at again, with fewer occurrences each,
until nothing splits any more. Few words of a common text are left. The surviving segments are
scanned lag by lag.

A lag scan need not compare all words at all lags. A run of period q holds four periods, so the
words that equal their q-th successor form a stretch of three periods, and such a stretch holds
a whole block of two periods that begins at a multiple of q. For each lag only the blocks at its
multiples are compared, by prefix sums of hashes, all lags between two powers of two at once:
n/1 + n/2 + n/3 ... comparisons in all. A block that agrees is compared word by word before it
counts, and then extended to both sides. Blocks that lie wholly in a run already found have a
smaller period, of which the lag is a multiple, and are passed over.

Each text is settled by itself, so the job has no shuffle and no state; a lost executor costs
its texts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pampero.llm.common import buffers, fold, slices, text_bytes

#: Blocks compared at once, but for those of a single lag.
BLOCKS = 1 << 20

OUTPUT = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def splits(words: np.ndarray, least: int, shortest: int) -> list[tuple[int, int]]:
    """Segments left when words with under ``least`` occurrences in their segment have split it,
    over and over, until every word of every segment has that many. Those of under ``shortest``
    words are given up. ``words`` are small integers."""
    stable, open_ = [], [(0, len(words))]
    while open_:
        low, high = open_.pop()
        if high - low < shortest:
            continue
        segment = words[low:high]
        if high - low < len(words) >> 3:  # counts over the words that occur, not over all
            segment = np.unique(segment, return_inverse=True)[1]
        rare = np.flatnonzero(np.bincount(segment)[segment] < least)
        if not len(rare):
            stable.append((low, high))
            continue
        edges = np.concatenate(([-1], rare, [high - low])) + low
        wide = np.flatnonzero(np.diff(edges) > shortest)
        open_.extend(zip((edges[wide] + 1).tolist(), edges[wide + 1].tolist()))
    return sorted(stable)


class Scan:
    """Lag scan of one segment; ``runs`` are ``(start, length, period)`` within it."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, words: np.ndarray, periods: int, shortest: int):
        self.words, self.periods, self.shortest = words, periods, shortest
        n = len(words)
        # powers[i] and sums[i]: a polynomial in the words before i.
        steps = np.full(n + 1, self.BASE, np.uint64)
        steps[0] = 1
        self.powers = np.cumprod(steps)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(fold(words.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=self.sums[1:])
        # Up to where a run that holds this word reaches.
        self.reach = np.zeros(n, np.int64)
        self.runs: list[tuple[int, int, int]] = []
        low = 1
        while low * periods <= n:
            high = min(2 * low - 1, low + BLOCKS * low // n, n // periods)
            self.scan_lags(low, high)
            low = high + 1

    def scan_lags(self, low: int, high: int) -> None:
        """All lags from low to high, which is below twice low, so that none is a multiple of
        another."""
        lags = np.arange(low, high + 1)
        blocks = (len(self.words) - 3 * lags) // lags + 1
        lag = np.repeat(lags, blocks)
        first = np.arange(len(lag)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = first * lag
        # The words of [at, at + 2q) and those q further on: equal sums, one shifted by q.
        sums = self.sums
        here = (sums[at + 2 * lag] - sums[at]) * self.powers[lag]
        same = np.flatnonzero(here == sums[at + 3 * lag] - sums[at + lag])
        same = same[self.reach[at[same]] < at[same] + 3 * lag[same]]
        if not len(same):
            return
        # Neighbouring blocks of one lag belong to one run.
        new = np.flatnonzero((np.diff(same) != 1) | (np.diff(lag[same]) != 0)) + 1
        for group in np.split(same, new):
            q = int(lag[group[0]])
            self.extend(int(at[group[0]]), int(at[group[-1]]) + 2 * q, q)

    def extend(self, low: int, high: int, q: int) -> None:
        """The run round words low to high, all of which should equal their q-th successor."""
        w = self.words
        unlike = np.flatnonzero(w[low:high] != w[low + q : high + q])
        if len(unlike):  # Hashes agreed by chance: go by the stretches that do agree.
            edges = np.concatenate(([low - 1], low + unlike, [high]))
            for a, b in zip(edges[:-1] + 1, edges[1:]):
                if b - a >= 2 * q:
                    self.extend(int(a), int(b), q)
            return
        # Less than q words to either side, or the next block would have agreed too. One that
        # did is another group only if hashes agreed by chance, hence the loops.
        while low:
            a = max(low - q, 0)
            unlike = np.flatnonzero(w[a:low] != w[a + q : low + q])
            low = a + int(unlike[-1]) + 1 if len(unlike) else a
            if len(unlike):
                break
        while high < len(w) - q:
            b = min(high + q, len(w) - q)
            unlike = np.flatnonzero(w[high:b] != w[high + q : b + q])
            high = high + int(unlike[0]) if len(unlike) else b
            if len(unlike):
                break
        length = high - low + q
        if length >= max(self.shortest, self.periods * q) and self.reach[low] < high + q:
            self.runs.append((low, length, q))
            np.maximum(self.reach[low : high + q], high + q, out=self.reach[low : high + q])


def find_runs(words: np.ndarray, periods: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` by start, then period, of a row of small integers."""
    found = []
    for low, high in splits(words, periods, shortest):
        scan = Scan(words[low:high], periods, shortest)
        found.extend((low + start, length, q) for start, length, q in scan.runs)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: all but those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, counted exactly; ties to the smaller start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words by equal small integers."""
    ids = defaultdict(count().__next__)
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def detect_runs(
    docs: DataFrame,
    loops: Column | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    periods: int = 4,
    shortest: int = 6,
    outputs: bool = True,
) -> DataFrame:
    """One row per input row: the columns of ``keep``, ``n_words, n_runs``, the run of most
    periods as ``start, length, period, exponent_milli`` (nulls without a run),
    ``runs_sha256``, ``collapsed_sha256``, and with ``outputs`` all ``runs`` and the text
    ``collapsed`` to one period of each run.

    Words are what ASCII blanks part, as they are written. A run is a stretch of at least
    ``periods`` times its smallest period and of ``shortest`` words that no neighbouring word
    extends. ``loops``, where not null, is a struct ``at, span``: every word from number
    ``at`` on is replaced by one of the ``span`` words from there, in turn.

    A null or empty text has no words and no runs; its digests are those of the empty string.
    Rows repeating an id are answered each. Further columns of any name are not read. An empty
    table gives no rows. A text is held by one task, at about a hundred bytes a word.
    """
    nothing = F.lit(None).cast("struct<at:long,span:long>")
    rows = docs.select(
        *keep, (nothing if loops is None else loops).alias("__loop"), text_bytes().alias("__body")
    )
    extra = ", runs array<struct<start:long,length:long,period:long>>, collapsed string"
    result = docs.select(*keep).schema
    for field in T.StructType.fromDDL(OUTPUT + (extra if outputs else "")):
        result = result.add(field)
    names = list(keep)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in slices(batches, "__body"):
            told = []
            loop = batch.column(len(names)).to_pylist()
            for body, turn in zip(buffers(batch, "__body"), loop):
                words = body.split()
                n = len(words)
                if turn is not None and n:
                    at, span = turn["at"], turn["span"]
                    words[at:] = [words[at + i % span] for i in range(n - at)]
                runs = find_runs(numbers(words), periods, shortest)
                left = b" ".join(compress(words, collapse(n, runs).tolist()) if runs else words)
                listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
                start, length, q = best_run(runs) or (None, None, None)
                row = {
                    "n_words": n,
                    "n_runs": len(runs),
                    "start": start,
                    "length": length,
                    "period": q,
                    "exponent_milli": 1000 * length // q if runs else None,
                    "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                    "collapsed_sha256": hashlib.sha256(left).hexdigest(),
                }
                if outputs:
                    keys = ("start", "length", "period")
                    row |= {"runs": [dict(zip(keys, r)) for r in runs], "collapsed": left.decode()}
                told.append(row)
            schema = schema or arrow_schema(outputs)
            answer = pa.RecordBatch.from_pylist(told, schema)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *answer.columns], [*names, *answer.schema.names]
            )

    return rows.mapInArrow(settle, result)


def arrow_schema(outputs: bool) -> pa.Schema:
    """The answer's columns as Arrow types."""
    long, text = pa.int64(), pa.string()
    fields = [(c, long) for c in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")]
    fields += [("runs_sha256", text), ("collapsed_sha256", text)]
    if outputs:
        run = pa.struct([("start", long), ("length", long), ("period", long)])
        fields += [("runs", pa.list_(run)), ("collapsed", text)]
    return pa.schema(fields)
