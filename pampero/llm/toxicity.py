"""Toxicity by a factorization machine over hashed terms.

Terms are words hashed into buckets; a text is the set of its buckets. Every bucket seen in the
rows to fit on has a weight and a vector, and a text is scored by its weights and by the products
of all pairs of its vectors, so that two terms harmless alone can tell together. No term is left
out beforehand: what chance alone would teach, the penalties of the fit take back to zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pampero.llm.common import Shared, Words, buffers, release, slices, text_bytes

BUCKET_BITS = 18
FACTORS = 8

#: Labelled rows the machine is fitted on at most, first by a hash of their id, and bytes of
#: their term sets, four a distinct term; the first row is taken whatever its size.
FIT_ROWS, FIT_BYTES = 20_000, 64 << 20

EPOCHS, BATCH, RATE, START, SEED = 20, 256, 0.3, 0.1, 7

#: Terms whose penalties are made up for at once in the end.
SETTLED = 8192

#: Penalty on the size of a weight and on the length of a vector, against the log-loss summed
#: over the rows: a term that is in one or two rows of a label alone cannot outweigh it.
WEIGHT_PENALTY, VECTOR_PENALTY = 1.0, 0.3

#: Bytes below 0x80 that no term contains: all but digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def term_sets(words: Words, bodies: list[bytes]) -> list[np.ndarray]:
    """Distinct buckets of each text's terms."""
    table = words(bodies)
    buckets = (table.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    return [np.unique(buckets[a:b]) for a, b in zip(table.first[:-1], table.first[1:])]


@dataclass
class Machine:
    features: np.ndarray  # bucket to feature number, or -1
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def present(self, buckets: np.ndarray) -> np.ndarray:
        found = self.features[buckets]
        return found[found >= 0]

    def score(self, present: np.ndarray) -> float:
        v = self.vectors[present]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum()) / max(len(v), 1)
        total = self.bias + float(self.weights[present].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def fit(features: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, n: int) -> Machine:
    """Penalised log-loss over the rows by adaptive steps; the same rows always give the same
    machine.

    A step moves only the terms of its rows. Penalties of the steps between are made up for when
    a term comes again, and at the end. Pairs are divided by the number of terms, since a long
    text has more of them by the square.
    """
    rng = np.random.default_rng(SEED)
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    bias, bias_squares = float(np.log(share / (1 - share))), 1.0
    # The weight, then the vector.
    params = np.zeros((n, 1 + FACTORS))
    params[:, 1:] = rng.normal(0, START, (n, FACTORS))
    squares = np.ones_like(params)
    settled = np.zeros(n)
    sizes = np.array([len(r) for r in rows])
    seen = 0

    def settle(f):
        rate = RATE / np.sqrt(squares[f]) * ((seen - settled[f]) / len(rows))[:, None]
        p = params[f]
        p[:, 0] = np.sign(p[:, 0]) * np.maximum(np.abs(p[:, 0]) - WEIGHT_PENALTY * rate[:, 0], 0)
        length = np.maximum(np.sqrt((p[:, 1:] ** 2).sum(axis=1)), 1e-12)
        left = 1 - VECTOR_PENALTY * rate[:, 1:].mean(axis=1) / length
        p[:, 1:] *= np.maximum(left, 0)[:, None]
        params[f], settled[f] = p, seen
        return p

    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            picked = order[at : at + BATCH]
            seen += len(picked)
            # Rows without terms teach the bias alone.
            bare = labels[picked[sizes[picked] == 0]]
            push = float((1 / (1 + np.exp(-np.clip(bias, -60, 60))) - bare).sum())
            picked = picked[sizes[picked] > 0]
            if len(picked):
                terms, k = np.concatenate([rows[r] for r in picked]), sizes[picked]
                row = np.repeat(np.arange(len(picked)), k)
                by_term = np.argsort(terms, kind="stable")
                new = np.diff(terms[by_term], prepend=-1) != 0
                begins = np.flatnonzero(new)
                f = terms[by_term][begins]
                where = np.empty(len(terms), np.int64)
                where[by_term] = np.cumsum(new) - 1
                p = settle(f)
                starts = np.cumsum(k) - k
                sums = np.add.reduceat(p[where], starts)
                own = np.add.reduceat((p[:, 1:] ** 2).sum(axis=1)[where], starts)
                total = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - own) / k
                slope = 1 / (1 + np.exp(-np.clip(total, -60, 60))) - labels[picked]
                each = np.column_stack((slope, (slope / k)[:, None] * sums[:, 1:], slope / k))
                gradient = np.add.reduceat(each[row[by_term]], begins)
                gradient, alone = gradient[:, :-1], gradient[:, -1:]
                gradient[:, 1:] -= alone * p[:, 1:]
                squares[f] += gradient**2
                params[f] -= RATE * gradient / np.sqrt(squares[f])
                push += float(slope.sum())
            bias_squares += push**2
            bias -= RATE * push / np.sqrt(bias_squares)
    # Some at a time: working on all terms at once would take several times the machine's size.
    for at in range(0, n, SETTLED):
        settle(np.arange(at, min(at + SETTLED, n)))
    return Machine(
        features, bias, params[:, 0].astype(np.float32), params[:, 1:].astype(np.float32)
    )


def train(docs: DataFrame, labels: DataFrame, learn_from: Column) -> Machine | None:
    """Machine from rows where ``learn_from`` holds and the label is known."""

    def terms(batches):
        words = Words(SEPARATORS)
        for batch in slices(batches, "body"):
            sets = [s.tobytes() for s in term_sets(words, buffers(batch, "body"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "terms"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = (
        labels.where("toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    learned = docs.where(learn_from & F.col("doc_id").isNotNull())
    # Copies teach once: a text repeated a thousand times is not a thousand witnesses.
    witnesses = (
        learned.select("doc_id", F.xxhash64("text").alias("check"))
        .join(known, "doc_id")
        .groupBy("check", "toxic")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", "toxic")
        .distinct()
    )
    # The hash that bounds the rows to fit on comes first, from ids alone.
    order = F.xxhash64("doc_id")
    last = (
        witnesses.select(order.alias("h")).orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
    )
    # Merged by id whatever the sizes: labels grow with the documents, so a plan that sends
    # them to every task would be another one on a larger table.
    named = (
        learned.where(order <= last)
        .select("doc_id", text_bytes().alias("body"))
        .mapInArrow(terms, f"doc_id {kind}, terms binary")
        .join(witnesses.where(order <= last).hint("merge"), "doc_id")
        .select("doc_id", "terms", "toxic")
        .orderBy(order, "doc_id", "terms")
        .limit(FIT_ROWS)
    )
    # Over the rows of the bound alone.
    ahead = Window.orderBy(order, "doc_id", "terms").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum(F.octet_length("terms")).over(ahead), F.lit(0))
    fits = (held == 0) | (held + F.octet_length("terms") <= FIT_BYTES)
    sample = named.withColumn("fits", fits).where("fits").select("terms", "toxic")
    sets, toxic = [], []
    # What the driver is done with goes first, since it is here that it holds most.
    release(docs.sparkSession)
    # The driver holds each set once, and few rows beside: they come in turn, and are numbered
    # in place.
    for row in sample.toLocalIterator():
        sets.append(np.frombuffer(bytearray(row["terms"]), np.int32))
        toxic.append(row["toxic"])
    if not sets:
        return None
    seen = np.zeros(1 << BUCKET_BITS, bool)
    for x in sets:
        seen[x] = True
    known = np.flatnonzero(seen)
    number = np.full(1 << BUCKET_BITS, -1, np.int32)
    number[known] = np.arange(len(known))
    for x in sets:
        x[:] = number[x]
    return fit(number, sets, np.array(toxic, float), max(len(known), 1))


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Learns ``labels.toxic`` of the rows where ``learn_from`` holds; ``held_out`` is its opposite,
    and a null there is held out. A null or empty text has no terms and gets the score of the
    label's share. An id labelled twice is toxic if either label says so; null labels teach
    nothing. Without any label every score is 0. Rows repeating an id are scored each. An empty
    table gives no rows.
    """
    learn = F.coalesce(learn_from, F.lit(False))
    machine = train(docs.select("doc_id", "text"), labels, learn)
    held_out = (~learn).alias("held_out")
    if machine is None:
        return docs.select(
            "doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")
        )
    return apply(docs.select("doc_id", held_out, text_bytes().alias("body")), machine, ["doc_id", "held_out"])


def apply(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``score, predicted`` of the text in ``body``."""
    shared = Shared(docs.sparkSession, machine)

    def score(batches):
        words, machine = Words(SEPARATORS), shared.value
        for batch in slices(batches, "body"):
            sets = term_sets(words, buffers(batch, "body"))
            scores = np.array([machine.score(machine.present(s)) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                ],
                names=[*keep, "score", "predicted"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "body").mapInArrow(score, f"{kinds}, score double, predicted int")
