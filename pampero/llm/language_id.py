"""Language identification by interpolated Kneser-Ney character models.

Characters are lower-cased letters, with every run of others as one space. Counts of four-character
grams are taken per language over all documents to learn from; lower orders count the distinct
characters before a gram, as Kneser and Ney do. Counts, continuation counts and the totals of
contexts are taken over all grams, on the cluster. The model that tasks hold is bounded: it has the
most frequent contexts of each order, each with all that any language ever saw follow it. Grams of a
text in other contexts are joined with the statistics themselves, so every gram counts as learned.

An order of all languages is one sorted array of hashes, each with the languages that hold the gram
and their shares, so a gram is looked up once for all of them and the model's size follows what
languages hold, not their number. A text gets the language in which its cross-entropy per character
is lowest.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import Shared, buffers, fold, slices, stage, text_bytes

ORDER = 4
DISCOUNT = 0.75
UNKNOWN = "und"

#: Grams of all languages together that tasks hold of each order but the lowest, which they hold
#: whole. Grams beyond are looked up by joins: the bound moves work, not results.
MODEL_GRAMS = 400_000

#: Steps to a doubling in which counts of contexts are told apart when the highest are held.
COUNT_STEPS = 8

#: Characters times languages scored at once.
CELLS = 1 << 20

#: Steps of the fit of the score, which ends before them once they no longer move it.
FIT_STEPS = 50

#: Parts a range of values is counted in, to find the value at one place of their order.
PARTS = 4096

SPACE = 32


def symbol_table() -> np.ndarray:
    """Symbol of each code point: letters in lower case, all else a space."""
    table = np.full(0x110000, SPACE, np.uint16)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            # Letters beyond 16 bits share the numbers that no character has.
            table[c] = low if low < 0x10000 else 0xD800 + low % 0x800
    return table


class Alphabet:
    """Texts as symbols of 16 bits."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts, three spaces before each; where each starts; letters in each."""
        pad = " " * (ORDER - 1)
        padded = [pad + t.decode("utf-8", "replace") for t in texts]
        points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
        lengths = [len(t) for t in padded]
        starts = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        symbols = self.table[points]
        space = symbols == SPACE
        kept = np.ones(len(symbols), bool)
        kept[1:] = ~(space[1:] & space[:-1])
        for j in range(len(pad)):
            kept[starts[:-1] + j] = True
        total = np.concatenate(([0], np.cumsum(kept)))
        letters = np.concatenate(([0], np.cumsum(~space)))
        return symbols[kept], total[starts], np.diff(letters[starts])


def grams(symbols: np.ndarray) -> np.ndarray:
    """The four symbols that end at each position, packed; meaningless at the first three."""
    s = symbols.astype(np.uint64)
    key = s.copy()
    for j in range(1, ORDER):
        key[j:] |= s[:-j] << np.uint64(16 * j)
    return key


def inner(starts: np.ndarray, n: int) -> np.ndarray:
    """Positions behind the padding of each text."""
    own = np.ones(n, bool)
    for j in range(ORDER - 1):
        own[starts[:-1] + j] = False
    return own


@dataclass
class Held:
    """What languages hold under keys: sorted hashes, where the entries of each start, and per
    entry its language and value."""

    keys: np.ndarray
    first: np.ndarray
    language: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, language: np.ndarray, value: np.ndarray) -> Held:
        hashed = fold(keys)
        order = np.lexsort((language, hashed))
        unique, first = np.unique(hashed[order], return_index=True)
        return cls(
            unique,
            np.append(first, len(order)),
            language[order].astype(np.int32),
            value[order].astype(np.float32),
        )

    def has(self, asked: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(asked), bool)
        hashed = fold(asked)
        at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
        return self.keys[at] == hashed

    def entries(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``asked``, language and value of every entry under the keys asked for."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
        hashed = fold(asked)
        at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == hashed)
        start = self.first[at[rows]]
        n = self.first[at[rows] + 1] - start
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        return np.repeat(rows, n), self.language[place], self.value[place]


@dataclass
class Level:
    """Shares of grams in their contexts, and what each context leaves to the order below.

    Contexts are held in all languages and with all their grams, or not at all, so probabilities
    add up to one either way. ``whole`` if none was left out."""

    shares: Held
    backoff: Held
    whole: bool = True


@dataclass
class Model:
    languages: list[str]
    unseen: np.ndarray  # probability of a character never met, by language
    single: Held  # probabilities of single characters
    levels: list[Level]  # of two characters and more
    slope: float = 1.0
    offset: float = 0.0
    reject_above: float = np.inf
    rest: Statistics | None = None  # where to look up what the levels leave out, if they do

    def settled(self, keys: np.ndarray) -> np.ndarray:
        """Whether ``log10`` of a gram is what the whole statistics say: its contexts are held."""
        out = np.ones(len(keys), bool)
        for order, level in enumerate(self.levels, 2):
            if not level.whole:
                short = keys & np.uint64((1 << 16 * order) - 1)
                out &= level.backoff.has(short >> np.uint64(16))
        return out

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol after those before it, a column per language."""
        out = np.repeat(self.unseen[None, :], len(keys), axis=0)
        rows, language, value = self.single.entries(keys & np.uint64(0xFFFF))
        out[rows, language] = value
        for order, level in enumerate(self.levels, 2):
            short = keys & np.uint64((1 << 16 * order) - 1)
            rows, language, value = level.backoff.entries(short >> np.uint64(16))
            out[rows, language] *= value
            rows, language, value = level.shares.entries(short)
            out[rows, language] += value
        return np.log10(out)

    def entropies(self, texts: list[bytes], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol in each language, and letters, of each text."""
        sums, symbols, letters, _ = self.sums(texts, alphabet)
        return -sums / np.maximum(symbols, 1)[:, None], letters

    def sums(
        self, texts: list[bytes], alphabet: Alphabet
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Log-probability of the settled grams in each language, symbols and letters of each text,
        and, if any are left out, its other grams with their counts."""
        symbols, starts, letters = alphabet(texts)
        own = inner(starts, len(symbols))
        keys = grams(symbols)[own]
        edges = np.concatenate(([0], np.cumsum(own)))[starts]
        sums = np.zeros((len(texts), len(self.languages)))
        step = max(CELLS // len(self.languages), 1)
        for at in range(0, len(keys), step):
            # A gram decides its probability, so each is worked out once.
            unique, where = np.unique(keys[at : at + step], return_inverse=True)
            told = self.log10(unique)
            told[~self.settled(unique)] = 0
            cuts = np.clip(edges - at, 0, len(where))
            texts_in = np.flatnonzero(np.diff(cuts))
            sums[texts_in] += np.add.reduceat(told[where], cuts[texts_in], axis=0)
        others = []
        if not all(level.whole for level in self.levels):
            other = ~self.settled(keys)
            others = [
                np.unique(keys[a:b][other[a:b]], return_counts=True)
                for a, b in zip(edges[:-1], edges[1:])
            ]
        return sums, np.diff(edges), letters, others

    def confidence(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def count_grams(learn: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all documents to learn from."""

    table = learn.sparkSession.sparkContext.broadcast(symbol_table())

    def count(batches):
        alphabet, held = Alphabet(table.value), {}

        def settle(lang):
            keys = np.concatenate([k for k, _ in held[lang]])
            keys, where = np.unique(keys, return_inverse=True)
            n = np.bincount(where, np.concatenate([c for _, c in held[lang]])).astype(np.int64)
            held[lang] = [(keys, n)]

        for batch in slices(batches, "body"):
            langs = batch.column(0).to_pylist()
            bodies = buffers(batch, "body")
            for lang in set(langs):
                texts = [b for b, x in zip(bodies, langs) if x == lang]
                symbols, starts, _ = alphabet(texts)
                keys = grams(symbols)[inner(starts, len(symbols))]
                held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held[lang]) > 1 << 20:
                    settle(lang)
        for lang in held:
            settle(lang)
            keys, n = held[lang][0]
            for i in range(0, len(keys), 1 << 16):
                part = keys[i : i + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part), pa.array(n[i : i + (1 << 16)])],
                    names=["lang", "gram", "n"],
                )

    return (
        learn.select(F.col("lang").cast("string").alias("lang"), text_bytes().alias("body"))
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def orders_of(counted: DataFrame) -> list[DataFrame]:
    """``lang, gram, n`` of each order, the lowest first: counts of the highest, and of others the
    distinct characters before a gram."""
    orders = [counted]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        shorter = orders[0].groupBy("lang", suffix).agg(F.count(F.lit(1)).alias("n"))
        orders.insert(0, stage(shorter, "gram-kinds"))
    return orders


def context_of(order: int, gram: str = "gram") -> Column:
    """What precedes the last symbol of the last ``order`` ones."""
    short = F.col(gram).bitwiseAND(F.lit((1 << 16 * order) - 1 if order < ORDER else -1))
    return F.shiftrightunsigned(short, 16)


def totals_of(counts: DataFrame) -> DataFrame:
    """``lang, context, total, kinds``: how often a language saw a context, and its grams."""
    return counts.groupBy("lang", context_of(ORDER).alias("context")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
    )


def held_contexts(totals: DataFrame) -> DataFrame | None:
    """The contexts that tasks hold: those of the highest counts, as many steps of these as
    ``MODEL_GRAMS`` has room for the grams of; contexts of one step stay or go together. Nothing
    if there is room for all."""
    contexts = totals.groupBy("context").agg(F.sum("total").alias("n"), F.sum("kinds").alias("grams"))
    step = F.floor(F.log2("n") * COUNT_STEPS)
    # Counts have some hundred steps at most.
    steps = contexts.groupBy(step.alias("step")).agg(F.sum("grams").alias("grams")).collect()
    room, least = MODEL_GRAMS, None
    for row in sorted(steps, reverse=True):
        room -= row["grams"]
        if room < 0:
            return contexts.where(F.lit(False) if least is None else step >= least).select("context")
        least = row["step"]
    return None


def level_of(counts: DataFrame, totals: DataFrame, languages: list[str]) -> Level:
    """Shares and back-off weights of one order, from the counts of all its grams."""
    held = held_contexts(totals)
    kept = counts.withColumn("context", context_of(ORDER))
    if held is not None:
        kept = kept.join(held, "context", "left_semi")
    rows = kept.join(totals, ["lang", "context"]).select("lang", "gram", "n", "total").toArrow()
    keys = rows.column("gram").to_numpy().view(np.uint64)
    language = numbers_of(rows, languages)
    total = rows.column("total").to_numpy()
    share = (rows.column("n").to_numpy() - DISCOUNT) / total
    # What the grams leave of their context: the discounts.
    contexts = keys >> np.uint64(16)
    order = np.lexsort((language, contexts))
    contexts, spoken = contexts[order], language[order]
    new = np.append(True, (contexts[1:] != contexts[:-1]) | (spoken[1:] != spoken[:-1]))[: len(order)]
    left = 1 - np.bincount(np.cumsum(new) - 1, share[order], new.sum())
    backoff = Held.of(contexts[new], spoken[new], left)
    return Level(Held.of(keys, language, share), backoff, held is None)


@dataclass
class Statistics:
    """Counts of all grams, by order, and totals of all contexts, of two characters and more."""

    counts: list[DataFrame]
    totals: list[DataFrame]

    def log10(self, asked: DataFrame, model: Model) -> DataFrame:
        """``gram, language, told``: log-probability of distinct grams in every language, by joins
        with the statistics."""
        listed = [(i, x, float(u)) for i, (x, u) in enumerate(zip(model.languages, model.unseen))]
        known = asked.sparkSession.createDataFrame(listed, "language int, lang string, p double")
        rows = asked.crossJoin(F.broadcast(known))
        for order, counts in enumerate(self.counts, 1):
            mask = (1 << 16 * order) - 1 if order < ORDER else -1
            seen = counts.select("lang", F.col("gram").alias("short"), "n")
            rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit(mask)))
            rows = rows.join(seen, ["lang", "short"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
            if order == 1:
                p = F.col("p") * (2 * F.col("n") + 1)
            else:
                rows = rows.withColumn("context", context_of(order))
                rows = rows.join(self.totals[order - 2], ["lang", "context"], "left")
                own = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0))
                mixed = (own + DISCOUNT * F.col("kinds") * F.col("p")) / F.col("total")
                p = F.coalesce(mixed, F.col("p"))
            rows = rows.select("gram", "lang", "language", p.alias("p"))
        return rows.select("gram", "language", F.log10("p").alias("told"))


def numbers_of(rows: pa.Table, languages: list[str]) -> np.ndarray:
    found = pc.index_in(rows.column("lang"), pa.array(languages, pa.string()))
    return found.to_numpy().astype(np.int64)


def train(learn: DataFrame) -> Model | None:
    """Model of all languages in ``lang``; nothing if there is no letter to learn from."""
    orders = orders_of(stage(count_grams(learn), "gram-counts"))
    first, *others = orders
    # Single characters: 65,536 a language at most.
    rows = first.toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    if not languages:
        return None
    keys = rows.column("gram").to_numpy().view(np.uint64)
    language, n = numbers_of(rows, languages), rows.column("n").to_numpy()
    total = np.bincount(language, n, len(languages)) + 0.5 * (len(np.unique(keys)) + 1)
    single = Held.of(keys, language, (n + 0.5) / total[language])
    totals = [stage(totals_of(counts), "gram-contexts") for counts in others]
    levels = [level_of(c, t, languages) for c, t in zip(others, totals)]
    whole = all(level.whole for level in levels)
    rest = None if whole else Statistics(orders, totals)
    return Model(languages, 0.5 / total, single, levels, rest=rest)


def score_texts(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``letters, best, margin, entropy`` of each text."""
    if model.rest is not None:
        return score_with_rest(docs, model, keep)
    shared = Shared(docs.sparkSession, (model, symbol_table()))

    def score(batches):
        model, table = shared.value
        alphabet = Alphabet(table)
        names = np.array(model.languages, object)
        for batch in slices(batches, "body"):
            entropies, letters = model.entropies(buffers(batch, "body"), alphabet)
            order = np.sort(entropies, axis=1)
            margin = order[:, 1] - order[:, 0] if len(names) > 1 else np.full(len(order), 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(letters.astype(np.int64)),
                    pa.array(names[entropies.argmin(axis=1)], pa.string()),
                    pa.array(margin),
                    pa.array(order[:, 0]),
                ],
                names=[*keep, "letters", "best", "margin", "entropy"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_bytes().alias("body")).mapInArrow(
        score, f"{kinds}, letters long, best string, margin double, entropy double"
    )


def score_with_rest(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """`score_texts` where the model leaves grams out: tasks add up what they hold, the grams of
    other contexts are looked up in the statistics, each once, and added by text."""
    shared = Shared(docs.sparkSession, (replace(model, rest=None), symbol_table()))
    n_languages = len(model.languages)

    def add_up(batches):
        model, table = shared.value
        alphabet = Alphabet(table)
        # Rows are stored with these numbers before they are joined by them.
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "body"):
            sums, symbols, letters, others = model.sums(buffers(batch, "body"), alphabet)
            edges = np.concatenate(([0], np.cumsum([len(k) for k, _ in others]))).astype(np.int32)
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([k for k, _ in others]).view(np.int64)),
                    pa.array(np.concatenate([c for _, c in others]).astype(np.int64)),
                ],
                names=["gram", "n"],
            )
            spans = np.arange(len(sums) + 1, dtype=np.int32) * n_languages
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(np.arange(number, number + len(sums))),
                    pa.array(letters.astype(np.int64)),
                    pa.array(symbols.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(spans), pa.array(sums.ravel())),
                    pa.ListArray.from_arrays(pa.array(edges), pairs),
                ],
                names=[*keep, "text_number", "letters", "symbols", "sums", "others"],
            )
            number += len(sums)

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    added = docs.select(*keep, text_bytes().alias("body")).mapInArrow(
        add_up,
        f"{kinds}, text_number long, letters long, symbols long, sums array<double>, "
        "others array<struct<gram: long, n: long>>",
    )
    added = stage(added, "language-sums")
    others = added.select("text_number", F.explode("others").alias("o")).select("text_number", "o.*")
    told = model.rest.log10(others.select("gram").distinct(), model)
    by_language = others.join(told, "gram").groupBy("text_number", "language").agg(
        F.sum(F.col("n") * F.col("told")).alias("sum")
    )
    further = by_language.groupBy("text_number").agg(
        F.sort_array(F.collect_list(F.struct("language", "sum")))["sum"].alias("further")
    )
    none = F.array_repeat(F.lit(0.0), n_languages)
    both = F.zip_with("sums", F.coalesce("further", none), lambda a, b: a + b)
    symbols = F.greatest("symbols", F.lit(1))
    entropies = added.join(further, "text_number", "left").withColumn(
        "entropies", F.transform(both, lambda x: -x / symbols)
    )
    least = F.array_min("entropies")
    place = F.array_position("entropies", least).cast("int") - 1
    second = F.get(F.array_sort("entropies"), F.lit(1)) - least
    return entropies.select(
        *keep,
        "letters",
        F.get(F.array(*[F.lit(x) for x in model.languages]), place).alias("best"),
        F.coalesce(second, F.lit(1.0)).alias("margin"),
        least.alias("entropy"),
    )


def calibrate(model: Model, scored: DataFrame) -> None:
    """Fit the score to how often a margin between the best two languages is right, and the
    rejection to the entropies of texts in their own language.

    ``scored`` are all learned texts, stored, as `score_texts` has them with their ``lang``. Every
    step of the fit adds them up on the cluster; one row reaches the driver."""
    told = scored.where("letters > 0").select(
        "margin", "entropy", F.coalesce(F.col("best") == F.col("lang").cast("string"), F.lit(False)).alias("right")
    )
    n, n_right, total = told.agg(F.count(F.lit(1)), F.count_if("right"), F.sum("margin")).first()
    if not n:
        return
    # Two invented rows, one right and one wrong, at a margin of none keep the fit finite.
    scale = max(total / (n + 2), 1e-9)
    slope, offset = fit(told, scale)
    # Sums of doubles depend on the order of rows in their last digits: these are left out.
    model.slope, model.offset = float(f"{slope / scale:.9g}"), float(f"{offset:.9g}")
    if n_right:
        right = told.where("right").select("entropy")
        place = 0.999 * (n_right - 1)
        low = at_place(right, "entropy", int(place))
        high = at_place(right, "entropy", min(int(place) + 1, n_right - 1))
        model.reject_above = (low + (place - int(place)) * (high - low)) * 1.1


def fit(told: DataFrame, scale: float) -> tuple[float, float]:
    """Slope over ``margin / scale`` and offset of the logistic curve through ``right``, by
    Newton's steps; one that does not lessen the loss is halved."""
    ridge = 1e-3 * np.eye(2)

    def sums(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss at a curve, its slopes and their slopes."""
        x, y = F.col("margin") / scale, F.col("right").cast("double")
        z = F.col("x") * float(at[0]) + float(at[1])
        p = 1 / (1 + F.exp(-z))
        w, off = F.col("p") * (1 - F.col("p")), F.col("y") - F.col("p")
        loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        rows = told.select(x.alias("x"), y.alias("y")).withColumn("z", z).withColumn("p", p)
        parts = [loss, off * F.col("x"), off, w * F.col("x") * F.col("x"), w * F.col("x"), w]
        lost, down_a, down_b, aa, ab, bb = rows.agg(*[F.sum(c) for c in parts]).first()
        # The invented rows, at x = 0.
        q = 1 / (1 + np.exp(-at[1]))
        lost += 2 * np.logaddexp(0, at[1]) - at[1] + at @ ridge @ at / 2
        down = np.array([down_a, down_b + 1 - 2 * q]) - ridge @ at
        bend = np.array([[aa, ab], [ab, bb + 2 * q * (1 - q)]]) + ridge
        return lost, down, bend

    at = np.zeros(2)
    lost, down, bend = sums(at)
    step = np.linalg.solve(bend, down)
    for _ in range(FIT_STEPS):
        if np.abs(step).max() <= 1e-9 * max(np.abs(at).max(), 1.0):
            break
        tried = sums(at + step)
        # Sums are as exact as doubles are.
        if tried[0] <= lost + 1e-12 * abs(lost):
            at, (lost, down, bend) = at + step, tried
            step = np.linalg.solve(bend, down)
        else:
            step = step / 2
    return float(at[0]), float(at[1])


def at_place(values: DataFrame, column: str, place: int) -> float:
    """The value that ``place`` others precede in order. Ranges are counted in ever smaller parts
    until one of them holds a single value, so that no row moves."""
    value, before = F.col(column), 0
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        part = F.floor((value - low) / (high - low) * PARTS)
        counted = values.where(value.between(low, high)).groupBy(part.alias("part"))
        # As many rows as there are parts, at most, reach the driver.
        for row in sorted(counted.agg(F.count(F.lit(1)), F.min(column), F.max(column)).collect()):
            if before + row[1] > place:
                low, high = row[2], row[3]
                break
            before += row[1]
    return low


def identify(docs: DataFrame, learn_from: Column) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, rejected``.

    Learns from ``text`` and non-null ``lang`` of rows where ``learn_from`` holds, ``held_out``
    being its opposite; a null there is held out. Texts that are null or have no letter are
    ``und`` with score 0. ``rejected`` marks texts unlike any language learned; their best guess
    still stands. With nothing to learn from every text is ``und``. An empty table gives no rows.
    """
    marked = docs.select(
        "doc_id", "text", "lang", (~F.coalesce(learn_from, F.lit(False))).alias("held_out")
    )
    learn = marked.where(~F.col("held_out") & F.col("lang").isNotNull())
    model = train(learn)
    if model is None:
        return marked.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(True).alias("rejected"),
        )
    scored = stage(score_texts(marked, model, ["doc_id", "held_out", "lang"]), "language-scores")
    calibrate(model, scored.where(~F.col("held_out") & F.col("lang").isNotNull()))
    has_letters = F.col("letters") > 0
    confidence = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.offset)))
    return scored.select(
        "doc_id",
        "held_out",
        F.when(has_letters, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(has_letters, confidence).otherwise(0.0).alias("score"),
        (~has_letters | (F.col("entropy") > model.reject_above)).alias("rejected"),
    )
