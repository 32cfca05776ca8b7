"""A log-bilinear neural language model, trained by noise-contrastive estimation.

The next token is predicted in two steps. Its class comes from the model: the vectors of the
classes before it, each weighted by its distance, add up to a prediction that is compared with
every class by a product, and a matrix of such products for a batch of tokens is normalised row
by row. A frequent token is a class of its own; others share the classes their last bytes hash to.
Inside a shared class, tokens follow their smoothed counts, so that the probabilities of all
tokens, with one share for unknown ones, add up to one.

Counts, classes and training cover all texts to learn from. Training goes in rounds: texts are dealt
to shards by a hash, each shard follows its own gradients from the same start in the hash's order, and
the mean of the models, weighted by tokens, starts the next round. There are as many shards as the
tokens ask for, so the model depends on the texts alone and not on how rows are spread. The noise of a
batch is drawn once and told from all its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import Shared, Words, buffers, fold, slices, stage, text_bytes

SPACES = b" \t\n\v\f\r"

#: Classes: the end of a text, the most frequent tokens, and the shared ones.
OWN_CLASSES = 128
SHARED_CLASSES = 128
CLASSES = OWN_CLASSES + SHARED_CLASSES

#: A token is known to every task if it makes up this share of all: a million are at most.
#: The counts of others are joined.
DICTIONARY_SHARE = 1_000_000

CONTEXT, WIDTH, NOISE, BATCH, RATE, SEED = 4, 32, 64, 256, 0.15, 11

#: Tokens of a round that one model learns from in turn; more make further shards. Tokens of a
#: shard that are shuffled among one another, and that a longer text is cut to in training.
SHARD_TOKENS, BLOCK_TOKENS = 1 << 20, 1 << 16

#: The token that ends every text; no hash of a word is made to equal it.
END = 1

#: Rows that average their models into one.
FAN_IN = 32


@dataclass
class Bilinear:
    """``inputs`` has a further row for places before a text; ``outputs`` and ``bias`` are per
    class; ``distance`` weighs the vector so many tokens back."""

    inputs: np.ndarray
    outputs: np.ndarray
    distance: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, shares: np.ndarray) -> Bilinear:
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        distance = np.ones((CONTEXT, WIDTH), np.float32) / np.arange(1, CONTEXT + 1)[:, None]
        return cls(
            draw(CLASSES + 1, WIDTH),
            draw(CLASSES, WIDTH),
            distance.astype(np.float32),
            np.log(shares).astype(np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.outputs, self.distance, self.bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float64)

    def unpacked(self, flat: np.ndarray) -> Bilinear:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Bilinear(*out)

    def weighed(self) -> list[np.ndarray]:
        """The vectors of all classes at each distance."""
        return [self.inputs * self.distance[i] for i in range(CONTEXT)]

    def predictions(self, contexts: np.ndarray, weighed: list[np.ndarray] | None = None) -> np.ndarray:
        weighed = weighed or self.weighed()
        total = weighed[0].take(contexts[:, 0], axis=0)
        for i in range(1, CONTEXT):
            total += weighed[i].take(contexts[:, i], axis=0)
        return total

    def log10(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of the target classes."""
        out = np.empty(len(targets))
        weighed, ones = self.weighed(), np.ones(CLASSES)
        for at in range(0, len(targets), 512):
            part = slice(at, at + 512)
            scores = self.predictions(contexts[part], weighed) @ self.outputs.T
            scores += self.bias
            own = scores[np.arange(len(scores)), targets[part]].astype(np.float64)
            highest = scores.max(axis=1, keepdims=True)
            scores -= highest
            np.exp(scores, out=scores)
            # A product adds up a row, in doubles: a likely token's terms differ by far.
            out[part] = own - highest[:, 0] - np.log(scores.astype(np.float64) @ ones)
        return out / np.log(10)


def contexts_of(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The ``CONTEXT`` classes before each token, nearest first; ``CLASSES`` before a text."""
    n = len(classes)
    place = np.arange(n) - np.repeat(first[:-1], np.diff(first))
    out = np.full((n, CONTEXT), CLASSES, np.int64)
    for i in range(CONTEXT):
        shift = i + 1
        reach = place >= shift
        out[reach, i] = classes[np.flatnonzero(reach) - shift]
    return out


class Learner:
    """Steps of one task."""

    def __init__(self, model: Bilinear, shares: np.ndarray, seed: int):
        self.model, self.shares = model, shares
        self.rng = np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * shares).astype(np.float32)
        self.squares = [np.full_like(a, 1e-2) for a in model.arrays()]
        self.cumulative = np.cumsum(shares)

    def step(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        """Tell the batch's tokens from the noise, given their contexts."""
        m = self.model
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1])
        noise = np.minimum(noise, CLASSES - 1)
        q = m.predictions(contexts)
        of_noise, of_data = m.outputs.take(noise, axis=0), m.outputs.take(targets, axis=0)
        data = (q * of_data).sum(axis=1) + m.bias[targets] - self.log_noise[targets]
        drawn = q @ of_noise.T + (m.bias[noise] - self.log_noise[noise])
        scale = np.float32(1 / len(targets))
        pull = -scale / (1 + np.exp(np.clip(data, -30, 30)))
        push = scale / (1 + np.exp(-np.clip(drawn, -30, 30)))
        to_q = push @ of_noise + pull[:, None] * of_data
        outputs = rows_added(np.concatenate((targets, noise)), np.concatenate((pull[:, None] * q, push.T @ q)), CLASSES)
        bias = np.bincount(targets, pull, CLASSES) + np.bincount(noise, push.sum(axis=0), CLASSES)
        # One sum of ``to_q`` by place and class serves the vectors and their weights.
        by_place = np.empty((CONTEXT, CLASSES + 1, WIDTH), np.float32)
        pulls = to_q.astype(np.float64)
        for i in range(CONTEXT):
            by_place[i] = rows_added(contexts[:, i], pulls, CLASSES + 1)
        inputs = np.einsum("pcw,pw->cw", by_place, m.distance)
        distance = np.einsum("pcw,cw->pw", by_place, m.inputs)
        for array, square, gradient in zip(
            m.arrays(), self.squares, (inputs, outputs, distance, bias.astype(np.float32))
        ):
            square += gradient * gradient
            array -= RATE * gradient / np.sqrt(square)


#: Cells of a class's row, in a matrix of rows one after the other.
CELLS = np.arange(CLASSES + 1)[:, None] * WIDTH + np.arange(WIDTH)


def rows_added(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``WIDTH`` added up by class."""
    cells = CELLS.take(index, axis=0).ravel()
    return np.bincount(cells, rows.ravel(), n * WIDTH).astype(np.float32).reshape(n, WIDTH)


# --- tokens ---------------------------------------------------------------------------------


def tokens_of(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, the shared class of each, and where texts start."""
    ends = table.ends
    raw = np.frombuffer(table.buf, np.uint8).astype(np.uint64)
    tail = np.zeros(len(ends), np.uint64)
    for j in range(1, 4):
        at = ends - j
        tail = (tail << np.uint64(8)) | np.where(at >= table.starts, raw[np.maximum(at, 0)], 0)
    shared = OWN_CLASSES + (fold(tail) % np.uint64(SHARED_CLASSES)).astype(np.int64)
    hashes = np.insert(table.hashes, table.first[1:], np.uint64(END))
    shared = np.insert(shared, table.first[1:], 0)
    return hashes, shared, table.first + np.arange(len(table.first))


def count_tokens(learn: DataFrame) -> DataFrame:
    """``token, n, shared`` of every token in the texts to learn from; tokens are 64-bit hashes."""

    def count(batches):
        words, held = Words(SPACES), []

        def settle():
            tokens = np.concatenate([h[0] for h in held])
            unique, first, where = np.unique(tokens, return_index=True, return_inverse=True)
            n = np.bincount(where, np.concatenate([h[1] for h in held])).astype(np.int64)
            held[:] = [(unique, n, np.concatenate([h[2] for h in held])[first])]

        for batch in slices(batches, "body"):
            hashes, shared, _ = tokens_of(words(buffers(batch, "body")))
            unique, first, n = np.unique(hashes, return_index=True, return_counts=True)
            held.append((unique, n, shared[first].astype(np.int32)))
            if sum(len(h[0]) for h in held) > 1 << 20:
                settle()
                if len(held[0][0]) > 1 << 19:
                    yield from counted(*held.pop())
        if held:
            settle()
            yield from counted(*held[0])

    def counted(tokens, n, shared):
        for i in range(0, len(tokens), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[part].view(np.int64)), pa.array(n[part]), pa.array(shared[part])],
                names=["token", "n", "shared"],
            )

    return stage(
        learn.select(text_bytes().alias("body"))
        .mapInArrow(count, "token long, n long, shared int")
        .groupBy("token")
        .agg(F.sum("n").alias("n"), F.max("shared").alias("shared")),
        "token-counts",
    )


@dataclass
class Vocabulary:
    """Counts of all tokens in sum, of shared classes, and of the tokens every task knows."""

    total: int
    distinct: int
    known: np.ndarray  # sorted hashes
    counts: np.ndarray
    classes: np.ndarray
    shares: np.ndarray  # of classes, in training tokens
    norms: np.ndarray  # log10 of what a class's smoothed counts add up to; 0 for own classes

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    told = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = told["n"] or 0, told["v"]
    least = max(1, -(-total // DICTIONARY_SHARE))
    rows = counts.where(F.col("n") >= least).toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    n = rows.column("n").to_numpy()
    classes = rows.column("shared").to_numpy().astype(np.int64)
    order = np.lexsort((tokens, -n, tokens != END))
    own = order[:OWN_CLASSES]
    classes = classes.copy()
    classes[own] = np.arange(len(own))
    own_tokens = [int(t) for t in tokens[own].view(np.int64)]
    shared = counts.where(~F.col("token").isin(own_tokens)) if own_tokens else counts
    sums = shared.groupBy("shared").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    mass[classes[own]] = n[own]
    for r in sums:
        mass[r["shared"]], kinds[r["shared"]] = r["n"], r["v"]
    norms = np.zeros(CLASSES)
    norms[OWN_CLASSES:] = np.log10(mass[OWN_CLASSES:] + 0.5 * (kinds[OWN_CLASSES:] + 1))
    by_hash = np.argsort(tokens)
    return Vocabulary(
        int(total), int(distinct), tokens[by_hash], n[by_hash], classes[by_hash],
        (mass + 0.5) / (mass + 0.5).sum(), norms,
    )


def encode(docs: DataFrame, vocab: Vocabulary, keep: list[str]) -> DataFrame:
    """Stored rows with the classes of a text's tokens, what its dictionary tokens add to the
    scores, and the tokens whose counts have to be joined."""
    shared = Shared(docs.sparkSession, vocab)

    def scan(batches):
        words, vocab = Words(SPACES), shared.value
        log_counts = np.log10(vocab.counts + 0.5)
        for batch in slices(batches, "body"):
            hashes, classes, first = tokens_of(words(buffers(batch, "body")))
            found = np.zeros(len(hashes), bool)
            weight = np.zeros(len(hashes))
            if len(vocab.known):
                at = np.minimum(np.searchsorted(vocab.known, hashes), len(vocab.known) - 1)
                found = vocab.known[at] == hashes
                classes = np.where(found, vocab.classes[at], classes)
                weight = np.where(found, log_counts[at], 0)
            shared_class = classes >= OWN_CLASSES
            sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  no text is without end
            edges = np.concatenate(([0], np.cumsum(~found)))[first]
            rare = pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), pa.array(hashes[~found].view(np.int64))
            )
            packed = classes.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(np.diff(first)),
                    pa.array(sums(found.astype(np.int64))),
                    pa.array(sums(weight)),
                    pa.array(sums(np.where(shared_class, weight, 0))),
                    pa.array(sums(vocab.norms[classes])),
                    pa.array([packed[a:b] for a, b in zip(first[:-1], first[1:])], pa.binary()),
                    rare,
                ],
                names=[*keep, "n_tokens", "n_found", "log_found", "log_shared", "norms", "classes", "rare"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return stage(
        docs.select(*keep, "body").mapInArrow(
            scan,
            f"{kinds}, n_tokens long, n_found long, log_found double, log_shared double, "
            "norms double, classes binary, rare array<long>",
        ),
        "encoded-texts",
    )


# --- training and scoring -------------------------------------------------------------------


def blocks_of(bodies: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Texts in lists of about ``BLOCK_TOKENS`` tokens; a longer text is cut."""
    held, n = [], 0
    for body in bodies:
        for at in range(0, len(body), BLOCK_TOKENS):
            held.append(body[at : at + BLOCK_TOKENS])
            n += len(held[-1])
            if n >= BLOCK_TOKENS:
                yield held
                held, n = [], 0
    if held:
        yield held


def train_round(encoded: DataFrame, model: Bilinear, shares: np.ndarray, shards: int) -> Bilinear:
    """One pass over the rows given, in every shard from the same model; the weighted mean."""
    shared = Shared(encoded.sparkSession, (model, shares))
    schema = "shard long, total binary, seen long"

    def learn(batches):
        model, shares = shared.value
        learner, seen, shard = Learner(model, shares, SEED), 0, None

        def bodies():
            nonlocal shard
            for batch in batches:
                for shard, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield body

        for block in blocks_of(bodies()):
            classes = np.frombuffer(b"".join(block), np.uint8).astype(np.int64)
            first = np.concatenate(([0], np.cumsum([len(b) for b in block])))
            contexts = contexts_of(classes, first)
            order = learner.rng.permutation(len(classes))
            for at in range(0, len(order), BATCH):
                picked = order[at : at + BATCH]
                learner.step(contexts[picked], classes[picked])
            seen += len(classes)
        if seen:
            yield mean_row(shard, learner.model.packed() * seen, seen)

    def mean_row(shard, total, seen):
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([total.tobytes()], pa.binary()), pa.array([seen], pa.int64())],
            names=["shard", "total", "seen"],
        )

    def add(batches):
        """Sums of the models of ``FAN_IN`` shards that follow one another, in their order."""
        group, total, seen = None, None, 0
        for batch in batches:
            for shard, packed, n in zip(*[c.to_pylist() for c in batch.columns]):
                if group != shard // FAN_IN:
                    if seen:
                        yield mean_row(group, total, seen)
                    group, total, seen = shard // FAN_IN, 0, 0
                total = total + np.frombuffer(packed, np.float64)
                seen += n
        if seen:
            yield mean_row(group, total, seen)

    key = F.xxhash64("doc_id", "classes")
    dealt = encoded.select(F.pmod(key, F.lit(shards)).alias("shard"), "classes", key.alias("key"))
    # A partition a shard, its rows in one order.
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int"))
    models = stage(
        dealt.sortWithinPartitions("key", "classes").select("shard", "classes").mapInArrow(learn, schema),
        "models",
    )
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        near = models.repartition(F.floor(F.col("shard") / FAN_IN)).sortWithinPartitions("shard")
        models = stage(near.mapInArrow(add, schema), "models")
    parts = models.orderBy("shard").collect()
    seen = sum(r["seen"] for r in parts)
    if not seen:
        return model
    return model.unpacked(sum(np.frombuffer(r["total"], np.float64) for r in parts) / seen)


def class_scores(encoded: DataFrame, model: Bilinear, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the sum of the classes' log-probabilities of each text."""
    shared = Shared(encoded.sparkSession, model)

    def score(batches):
        model = shared.value
        for batch in slices(batches, "classes"):
            bodies = buffers(batch, "classes")
            classes = np.frombuffer(b"".join(bodies), np.uint8).astype(np.int64)
            first = np.concatenate(([0], np.cumsum([len(b) for b in bodies])))
            logp = model.log10(contexts_of(classes, first), classes)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(np.add.reduceat(logp, first[:-1])),
                ],
                names=[*keep, "class_score"],
            )

    kinds = ", ".join(f"{c} {encoded.schema[c].dataType.simpleString()}" for c in keep)
    return encoded.select(*keep, "classes").mapInArrow(score, f"{kinds}, class_score double")


def score_texts(docs: DataFrame, learn_from: Column, rounds: list[Column]) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``.

    Learns from the rows where ``learn_from`` holds; ``held_out`` is its opposite, and a null
    there is held out. ``rounds`` say which of the rows learned from each round of training
    passes over, by ``doc_id``. A null or empty text is its end alone. Scores are log10
    probabilities of whole texts: ``base_score`` by smoothed counts of tokens, ``score`` by the
    model. Rows repeating an id are scored each. With nothing to learn from, both scores give
    every class and token the same share. An empty table gives no rows.
    """
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (~F.coalesce(learn_from, F.lit(False))).alias("held_out"),
        text_bytes().alias("body"),
    )
    learn = docs.where(F.coalesce(learn_from, F.lit(False)))
    counts = count_tokens(learn)
    vocab = vocabulary(counts)
    encoded = encode(marked, vocab, ["row", "doc_id", "held_out"])
    model = Bilinear.start(vocab.shares)
    shards = max(1, -(-vocab.total // (SHARD_TOKENS * max(len(rounds), 1))))
    for chosen in rounds:
        model = train_round(encoded.where(~F.col("held_out") & chosen), model, vocab.shares, shards)

    # Tokens no task knows are rare by definition, so no key of this join is hot.
    asked = encoded.select("row", F.explode("rare").alias("token"))
    n = F.coalesce("n", F.lit(0))
    rare = (
        asked.join(counts.select("token", "n"), "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(n + 0.5)).alias("log_rare"),
            F.sum((n > 0).cast("long")).alias("n_rare_known"),
        )
    )
    keep = [
        "row", "doc_id", "held_out", "n_tokens", "n_found", "log_found", "log_shared", "norms",
    ]
    scored = class_scores(encoded, model, keep).join(rare, "row", "left")
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_found") + F.coalesce("n_rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("log_found") + log_rare - F.col("n_tokens") * vocab.base_norm).alias("base_score"),
        (F.col("class_score") + F.col("log_shared") + log_rare - F.col("norms")).alias("score"),
    )
