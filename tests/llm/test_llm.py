"""The training-data operators against brute force, SQL, and awkward tables."""

import base64
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from pampero.llm import (  # noqa: E402
    bpe,
    decontamination,
    exact_dedup,
    language_id,
    language_model,
    line_dedup,
    ngram_join,
    periodic_runs,
    resampling,
    source_mix,
    suffix_dedup,
    toxicity,
    warc,
)
from pampero.llm.common import prepare  # noqa: E402
from pampero.llm.queries import ORACLES, QUERIES, remainder  # noqa: E402
from pampero.workspace import new_path  # noqa: E402

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, rank int"
LONG = " ".join(f"word{i}" for i in range(3000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here today"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here today"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (None, "a text without an id that is long enough to be looked at by all of them here"),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "x" * 400),
    (9, "x" * 400),
    (10, "Éléphant ñandú 漢字 😀 <|endoftext|> it's\r\n\r\nWARC/1.1"),
]


@pytest.fixture
def docs(spark):
    prepare(spark)
    rows = [(i, t, "en", "s", None, 1, 2) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def fold(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


def tables(spark):
    labels = spark.createDataFrame(
        [(1, 1, 1), (6, 0, 0), (7, 0, 0), (8, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    benchmark = spark.createDataFrame(
        [(1, "over the lazy dog and runs far away from here"), (2, "ONE"), (3, None), (4, "")],
        "item_id long, text string",
    )
    return labels, benchmark


def operators(spark, docs):
    import public_tokenizers

    labels, benchmark = tables(spark)
    file = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "model": lambda: language_model.score_texts(docs, fold(5) != 1, [fold(5) == 0, fold(5) > 1]),
        "bpe": lambda: bpe.encode_texts(docs, file, long=100, leaf=30),
        "decontamination": lambda: decontamination.decontaminate(docs, benchmark),
        "exact": lambda: exact_dedup.exact_dedup(docs),
        "lines": lambda: line_dedup.dedup_lines(docs),
        "toxicity": lambda: toxicity.score_toxicity(docs, labels, fold(5) != 0),
        "suffix": lambda: suffix_dedup.remove_repeats(docs),
        "jaccard": lambda: ngram_join.jaccard_components(docs),
        "language": lambda: language_id.identify(docs, fold(3) != 1),
        "runs": lambda: periodic_runs.detect_runs(docs),
        "mix": lambda: source_mix.mix_sources(docs, [3, 1, 2]),
        "resample": lambda: resampling.resample(docs, benchmark),
    }


NAMES = [
    "model", "bpe", "decontamination", "exact", "lines", "toxicity", "suffix", "jaccard", "language",
    "runs", "mix", "resample",
]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_are_all_answered(spark, docs, name):
    got = operators(spark, docs)[name]().select("doc_id").collect()
    assert Counter(r[0] for r in got) == Counter(i for i, _ in TEXTS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, empty, name):
    assert operators(spark, empty)[name]().collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "TABLES", [*compare.TABLES, "documents", "pages", "benchmark", "labels"])
    con = compare.connect(DATA)
    assert compare.differences(spark, con, QUERIES[name], ORACLES[name], DATA) == []


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


# --- language model -------------------------------------------------------------------------


def test_language_model_counts_and_beats_the_base(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    words = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in rows}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 5 == 1}
    counts = Counter(w for i, ws in words.items() if i not in held for w in ws)
    norm = math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    got = QUERIES["op1_language_model"](spark, DATA).collect()
    assert len(got) == len(rows)
    for r in got:
        base = sum(math.log10(counts[w] + 0.5) - norm for w in words[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.n_tokens == len(words[r.doc_id]) and r.train_tokens == sum(counts.values())
        assert r.n_known == sum(counts[w] > 0 for w in words[r.doc_id])
        assert r.held_out == (r.doc_id in held)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_language_model_is_the_same_however_rows_lie(spark, monkeypatch):
    """Many shards, averaged in a tree, and texts cut in training."""
    monkeypatch.setattr(language_model, "FAN_IN", 2)
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 300)
    docs = prepare(spark).read.parquet(f"{DATA}/documents.parquet")
    for size in (1 << 20, 2000):
        monkeypatch.setattr(language_model, "SHARD_TOKENS", size)
        found = []
        for parts in (1, 8, 64):
            got = language_model.score_texts(
                docs.repartition(parts), remainder(5) != 1, [remainder(5) == r for r in (0, 2, 3, 4)]
            ).collect()
            found.append({r.doc_id: r.score for r in got})
            held = [r for r in got if r.held_out]
            if size > 2000:
                assert sum(r.score for r in held) > sum(r.base_score for r in held)
        for other in found[1:]:
            assert all(math.isclose(v, found[0][k], rel_tol=1e-6) for k, v in other.items())


def test_language_model_is_normalised():
    rng = np.random.default_rng(0)
    shares = rng.random(language_model.CLASSES)
    model = language_model.Bilinear.start(shares / shares.sum())
    contexts = rng.integers(0, language_model.CLASSES + 1, (1, language_model.CONTEXT))
    every = np.repeat(contexts, language_model.CLASSES, axis=0)
    total = (10 ** model.log10(every, np.arange(language_model.CLASSES))).sum()
    assert total == pytest.approx(1, abs=1e-5)


# --- tokens ----------------------------------------------------------------------------------


def test_tree_concatenation_equals_the_library(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(file), bpe.Tokenizer(file)
    rng = random.Random(1)
    kinds = ["ab", "abcdefghij", "the of and ing ", "éèüß字漢", "a1 '.\n", "it's 've ", " \n\t a", "😀 x", "0123, ", "0123456789", "=-'~.", "-'s ", "<|endoftext|>"]
    for _ in range(300):
        parts = ["".join(rng.choices(rng.choice(kinds), k=rng.randrange(1, 900))) for _ in range(2)]
        text = rng.choice(["", "<|endoftext|>"]).join(parts)
        leaf = rng.choice([50, 97, 300])
        monkeypatch.setattr(bpe, "WINDOW", rng.choice([4, 16, 64]))
        leaves = [text[i : i + leaf] for i in range(0, len(text), leaf)]
        ids = bpe.tree([bpe.Piece(x, own.encode(x), own) for x in leaves], own).ids
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == text


@pytest.mark.parametrize("unit", ["abcdefghij", "0123456789", "=-_*#'~.", "<|endoftext|>word 12 -- "])
def test_joining_encodes_little_anew(unit, monkeypatch):
    """Work at the joins of an unsplit text does not grow with its length."""
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(file), bpe.Tokenizer(file)
    rng = random.Random(5)
    text = unit * 3000 if "<" in unit else "".join(rng.choices(unit, k=60_000))
    leaves = [text[i : i + 4001] for i in range(0, len(text), 4001)]
    pieces = [bpe.Piece(x, own.encode(x), own) for x in leaves]
    anew, encode = [], own.encode
    monkeypatch.setattr(own, "encode", lambda t: anew.append(len(t)) or encode(t))
    ids = bpe.tree(pieces, own).ids
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(anew) < len(leaves) * 3000


def test_bpe_query_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, DATA).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


# --- decontamination ---------------------------------------------------------------------------


def test_every_shared_window_is_found(spark):
    prepare(spark)
    rng = random.Random(2)
    word = lambda: rng.choice("abcdef")
    items = [[word() for _ in range(rng.choice([0, 1, 3, 9, 10, 25]))] for _ in range(12)]
    texts = []
    for _ in range(40):
        words = [word() for _ in range(rng.randrange(60))]
        for item in rng.sample(items, 2):
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[: rng.randrange(8, 26)]
        texts.append(words)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.decontaminate(docs, bench).collect()}
    for i, words in enumerate(texts):
        hit, met = set(), set()
        for j, item in enumerate(items):
            n = min(len(item), 10)
            windows = {tuple(item[a : a + n]) for a in range(len(item) - n + 1)} if n else set()
            for a in range(len(words) - n + 1):
                if tuple(words[a : a + n]) in windows:
                    met.add(str(j))
                    hit.update(range(a, a + n))
        assert (got[i].n_hit, got[i].n_items) == (len(hit), len(met))
        assert got[i].items_sha256 == hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()


def brute_force_hits(words, items, window=10):
    hit, met = set(), set()
    for j, item in enumerate(items):
        n = min(len(item), window)
        for a in range(len(words) - n + 1) if n else ():
            if any(words[a : a + n] == item[b : b + n] for b in range(len(item) - n + 1)):
                met.add(str(j))
                hit.update(range(a, a + n))
    return len(hit), len(met)


def test_signs_that_only_python_takes_for_blanks_are_words(spark):
    """No-break and ideographic spaces, line separators and the like are parts of words."""
    prepare(spark)
    rng = random.Random(6)
    kinds = ["a", "b", "c", "\u00a0", "\u3000", "\u2028", "a\u00a0b", "\u0085", "\u202fc", "b\u2009"]
    items = [rng.choices(kinds, k=n) for n in (1, 3, 10, 10, 10, 14, 25)]
    texts = []
    for _ in range(40):
        words = rng.choices(kinds, k=rng.randrange(30))
        item = rng.choice(items)
        at = rng.randrange(len(words) + 1)
        words[at:at] = item[: rng.randrange(8, 26)]
        texts.append(words)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.decontaminate(docs, bench).collect()}
    for i, words in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (len(words), *brute_force_hits(words, items))


# --- duplicates ----------------------------------------------------------------------------------


def test_exact_dedup_keeps_either_end(spark, docs):
    small = {r.doc_id: r for r in exact_dedup.exact_dedup(docs, keep="smallest").collect()}
    large = {r.doc_id: r for r in exact_dedup.exact_dedup(docs, keep="largest").collect()}
    assert (small[2].keep_id, small[1].kept, large[1].keep_id, large[2].kept) == (1, True, 2, True)
    assert large[3].keep_id == 4 and large[3].group_size == 2  # null counts as empty


def test_banded_distance_equals_the_full_one(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        kind = rng.choice(["ab", "abcdé", "abcdefghijklmn "])
        a = rng.choices(kind, k=rng.randrange(40))
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choices(kind, k=rng.randrange(2))
        pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "s string, t string")
    for edits in (1, 2, 3):
        near = df.where(F.abs(F.length("s") - F.length("t")) <= edits)
        near = near.withColumns(
            {f"{c}_chars": line_dedup.characters(F.col(c), edits) for c in "st"}
        ).cache()
        told = near.select(
            line_dedup.within_edits(F.col("s_chars"), F.col("t_chars"), edits).alias("own"),
            (F.levenshtein("s", "t") <= edits).alias("full"),
        )
        assert told.where("own <> full").count() == 0


def test_suffix_collection_is_sorted():
    rng = random.Random(3)
    for _ in range(60):
        kind = rng.choice([b"ab", b"abc", b"abcdefgh"])
        strings = [bytes(rng.choices(kind, k=rng.randrange(30))) for _ in range(rng.randrange(1, 10))]
        got = suffix_dedup.Collection(strings)
        suffixes = [strings[o][len(strings[o]) - n :] for o, n in zip(got.owner, got.size)]
        assert suffixes == sorted(s[i:] for s in strings for i in range(len(s) + 1))
        common = [0]
        for a, b in zip(suffixes, suffixes[1:]):
            common.append(next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))))
        assert got.common.tolist() == common


@pytest.mark.parametrize("hot", [65_536, 2])
def test_repeats_are_removed_as_by_brute_force(spark, monkeypatch, hot):
    """With hot keys at any size, too, the way they are settled window by window."""
    monkeypatch.setattr(suffix_dedup, "HOT_KEY", hot)
    prepare(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 3000")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    seen: dict[bytes, int] = {}
    for doc_id, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 49):
            if seen.setdefault(body[k : k + 50], doc_id) < doc_id:
                gone[k : k + 50] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        r = got[doc_id]
        assert (r.n_removed, r.n_spans) == (int(gone.sum()), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_open_pieces_are_shuffled_once(spark, monkeypatch):
    """Without hot keys texts of pieces are not shuffled to look for them, the table of flags is
    deleted once it was read, and open pieces do not hold their texts a second time."""
    prepare(spark)
    plans = []
    settled = suffix_dedup.repeats_of

    def looked_at(opened, length):
        assert "text" not in opened.schema["open"].dataType.elementType.names
        found = settled(opened, length)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(suffix_dedup, "repeats_of", looked_at)
    body = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, body), (2, "before " + body), (3, body + " after")], "doc_id long, text string"
    )
    before = len(suffix_dedup.STAGED)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: len(body), 3: len(body)}
    assert plans[0].count("Exchange hashpartitioning") == 1
    flags = [p for p in suffix_dedup.STAGED[before:] if "/piece-flags-" in p]
    assert len(flags) == 1 and not Path(flags[0]).exists()


def test_stretches_hold_all_windows_met_again():
    rng = random.Random(7)
    cutter = suffix_dedup.Cutter(5)
    for _ in range(300):
        strings = [bytes(rng.choices(b"abc", k=rng.randrange(14))) for _ in range(rng.randrange(1, 12))]
        seen = Counter(s[i : i + 5] for s in strings for i in range(len(s) - 4))
        want = []
        for j, s in enumerate(strings):
            met = [i for i in range(len(s) - 4) if seen[s[i : i + 5]] > 1]
            if met:
                want.append((j, met[0], met[-1]))
        assert cutter.sharing(strings) == want


def test_pieces_are_the_same_only_if_their_whole_hashes_are():
    """Three pieces of one key: two alike in the low 40 bits of their hashes, two altogether."""
    keys = np.full(3, (1 << 63) + 12345, np.uint64)
    hashes = np.array([(7 << 40) + 99, (8 << 40) + 99, (7 << 40) + 99], np.uint64)
    body = suffix_dedup.pack(keys, hashes)
    got_keys, got_hashes = suffix_dedup.unpack(body)
    assert (got_keys == 12345).all() and (got_hashes == hashes).all()
    one = np.int32(1).tobytes()
    frame = pd.DataFrame(
        {
            "part": [3] * 3,
            "ranks": [np.int64(r).tobytes() for r in (10, 20, 30)],
            "variants": [np.int64(0).tobytes()] * 3,
            "counts": [one] * 3,
            "pieces": [body[i * 12 : i * 12 + 12] for i in range(3)],
        }
    )
    flags = {r.rank: r.flags[0] for r in suffix_dedup.compare(frame).itertuples(index=False)}
    assert flags == {10: suffix_dedup.OPEN, 20: suffix_dedup.OPEN, 30: suffix_dedup.COVERED}


# --- learned labels ------------------------------------------------------------------------------


def test_languages_are_told_apart(spark):
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    judged = got.join(truth, "doc_id").where("lang_pred <> 'und'")
    right = judged.where("lang_pred = lang").count() / judged.count()
    assert right > 0.98


def brute_kneser_ney(texts, alphabet):
    """Probability of a symbol after three others, from plain counts of one language's texts."""
    symbols, starts, _ = alphabet([t.encode() for t in texts])
    counts = Counter()
    for a, b in zip(starts[:-1], starts[1:]):
        text = [int(x) for x in symbols[a:b]]
        counts.update(tuple(text[i - 3 : i + 1]) for i in range(3, len(text)))
    orders = [counts]
    for k in (3, 2, 1):
        orders.insert(0, Counter(g[1:] for g in orders[0]))
    first = orders[0]

    def probability(gram):
        if len(gram) == 1:
            return (first[gram] + 0.5) / (sum(first.values()) + 0.5 * (len(first) + 1))
        same = {g: n for g, n in orders[len(gram) - 1].items() if g[:-1] == gram[:-1]}
        lower = probability(gram[1:])
        if not same:
            return lower
        total = sum(same.values())
        return max(same.get(gram, 0) - 0.75, 0) / total + 0.75 * len(same) / total * lower

    return probability, sorted(first)


def packed(gram):
    return sum(c << 16 * (len(gram) - 1 - i) for i, c in enumerate(gram))


def test_language_models_add_up_however_much_is_cut(spark, monkeypatch):
    texts = {
        "a": ["the cat sat on the mat", "the hat", "", "12 !"],
        "b": ["der hut und der hund", "Der Mond"],
    }
    learn = spark.createDataFrame([(x, t) for x, many in texts.items() for t in many], "lang string, text string")
    alphabet = language_id.Alphabet(language_id.symbol_table())
    rng = np.random.default_rng(3)
    for bound in (400_000, 24, 1):
        monkeypatch.setattr(language_id, "MODEL_GRAMS", bound)
        model = language_id.train(learn)
        for i, lang in enumerate(model.languages):
            _, seen = brute_kneser_ney(texts[lang], alphabet)
            letters = [int(g[0]) for g in seen]
            grams = [tuple(int(x) for x in rng.choice(letters, 4)) for _ in range(8)]
            grams += [(32, 32, 32, ord("t")), tuple(map(ord, "the ")), tuple(map(ord, "der "))]
            # All symbols of any language and one for those never met share the whole.
            every = sorted({int(k) for x in texts for k, in brute_kneser_ney(texts[x], alphabet)[1]})
            for g in grams:
                asked = np.array([packed((*g[:3], c)) for c in [*every, 0xFFFE]], np.uint64)
                assert np.isclose((10 ** model.log10(asked)[:, i]).sum(), 1, atol=1e-5)


def test_grams_beyond_the_model_count_too(spark, monkeypatch):
    """However few contexts tasks hold, every text is judged by all that was learned."""
    rng = np.random.default_rng(5)
    rows = [
        (i, None if i % 9 == 8 else " ".join("".join(rng.choice(list("abcdeé"[i % 3 :]), 4)) for _ in range(6)), "xyz"[i % 3])
        for i in range(60)
    ]
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def judged(bound):
        monkeypatch.setattr(language_id, "MODEL_GRAMS", bound)
        model = language_id.train(docs.where("doc_id % 4 <> 1").select("lang", "text"))
        got = language_id.score_texts(docs, model, ["doc_id"]).orderBy("doc_id").collect()
        return model, got

    whole, expected = judged(400_000)
    assert whole.rest is None and len(expected) == len(rows)
    for bound in (200, 40, 1):
        model, got = judged(bound)
        assert model.rest is not None
        assert all(len(x.shares.value) <= bound for x in model.levels)
        assert [(r.doc_id, r.letters, r.best) for r in got] == [(r.doc_id, r.letters, r.best) for r in expected]
        for name in ("margin", "entropy"):
            assert np.allclose([r[name] for r in got], [r[name] for r in expected], atol=1e-5)


def test_one_language_alone_is_kneser_ney(spark):
    texts = ["the cat sat on the mat", "the hat", "that is it"]
    alphabet = language_id.Alphabet(language_id.symbol_table())
    model = language_id.train(spark.createDataFrame([("a", t) for t in texts], "lang string, text string"))
    probability, seen = brute_kneser_ney(texts, alphabet)
    letters = [int(g[0]) for g in seen]
    rng = np.random.default_rng(3)
    grams = [tuple(int(x) for x in rng.choice(letters, 4)) for _ in range(200)]
    got = 10 ** model.log10(np.array([packed(g) for g in grams], np.uint64))[:, 0]
    assert np.allclose(got, [probability(g) for g in grams], rtol=1e-5)


def test_three_hundred_languages(spark):
    """A language each of few letters: the model holds what they hold, not languages times grams."""
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    rows = []
    for i in range(300):
        own = letters[3 * i : 3 * i + 3] + ["e", "n"]
        rows += [(j * 300 + i, " ".join("".join(rng.choice(own, 5)) for _ in range(12)), f"l{i:03}") for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs.select("lang", "text"))
    assert len(model.languages) == 300
    entries = sum(len(x.shares.value) for x in model.levels) + len(model.single.value)
    assert entries < 300 * 1000
    got = language_id.identify(docs, F.col("doc_id") < 600)
    told = {r.doc_id: r.lang_pred for r in got.collect()}
    right = sum(told[i] == lang for i, _, lang in rows if i >= 600)
    assert right == 300


def test_the_score_is_fitted_on_every_learned_text(spark):
    """More texts than any sample of before: score and rejection are those of a fit on all."""
    prepare(spark)
    rng = np.random.default_rng(11)
    letters = {"a": "abcde", "b": "cdefg", "c": "efgab"}
    rows = []
    for i in range(3000):
        lang = "abc"[i % 3]
        rows.append((i, "".join(rng.choice(list(letters[lang]), int(rng.integers(1, 9)))), lang))
    rows += [(3000, "abc", None), (3001, None, "a"), (3002, "12", "b"), (None, "cdab", "a"), (3003, "fga", "c"), (3003, "fga", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).cache()
    learn = docs.where("lang is not null")
    told = language_id.score_texts(learn, language_id.train(learn), ["lang"]).where("letters > 0").toPandas()
    margin, right = told["margin"].to_numpy(), (told["best"] == told["lang"]).to_numpy()
    assert 0.2 < right.mean() < 0.95 and len(told) == 3003
    x, y = np.append(margin, [0, 0]), np.append(right, [1, 0]).astype(float)
    scale, at = np.abs(x).mean(), np.zeros(2)
    design = np.stack((x / scale, np.ones(len(x))))
    for _ in range(50):
        p = 1 / (1 + np.exp(-(at @ design)))
        bend = (design * p * (1 - p)) @ design.T + 1e-3 * np.eye(2)
        at = at + np.linalg.solve(bend, design @ (y - p) - 1e-3 * at)
    above = np.quantile(told["entropy"].to_numpy()[right], 0.999) * 1.1
    scored = language_id.score_texts(docs, language_id.train(learn), ["doc_id", "text"]).toPandas()
    scored = scored[scored["letters"] > 0].sort_values("text")
    expected = 1 / (1 + np.exp(-(at[0] * scored["margin"] / scale + at[1])))
    got = language_id.identify(docs.select("doc_id", "text", "lang"), F.lit(True))
    texts = docs.select(F.col("doc_id").alias("id"), "text").distinct()
    got = got.join(texts, got["doc_id"].eqNullSafe(texts["id"])).where("lang_pred <> 'und'").toPandas()
    got = got.sort_values("text")
    assert got["text"].tolist() == scored["text"].tolist()
    assert np.allclose(got["score"], expected, atol=1e-6)
    assert got["rejected"].tolist() == (scored["entropy"] > above).tolist()
    docs.unpersist()


def test_a_value_is_found_at_its_place_of_the_order(spark):
    rng = np.random.default_rng(5)
    values = np.sort(np.concatenate((rng.exponential(2.0, 500), [1.5] * 300, [1e-9, 4e6])))
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "v double")
    for place in (0, 1, 250, 400, 700, len(values) - 2, len(values) - 1):
        assert language_id.at_place(df, "v", place) == values[place]


def test_letterless_texts_have_no_language(spark, docs):
    got = {r.doc_id: r for r in language_id.identify(docs, fold(3) != 1).collect()}
    assert {got[i].lang_pred for i in (3, 4, 5)} == {"und"} and got[3].score == 0


def test_toxicity_learns_pairs(spark):
    """Neither word alone is told by a weight: only both together bear the label."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (2000, 2))
    rows = [np.flatnonzero(r).astype(np.int32) for r in x]
    labels = (x.sum(axis=1) == 2).astype(float)
    machine = toxicity.fit(np.zeros(1, np.int32), rows, labels, 2)
    told = [machine.score(r) for r in ([0], [1], [0, 1], [])]
    assert told[2] > 0.5 > max(told[0], told[1], told[3])


def test_toxicity_learns_pairs_of_terms_neutral_alone(spark):
    """A text is toxic with both of two words or neither, so each alone goes with both labels."""
    prepare(spark)
    rng = random.Random(8)
    rows = []
    for i in range(800):
        pair = [w for w in ("salt", "lamp") if rng.random() < 0.5]
        fill = rng.sample(["river", "stone", "cloud", "table", "paper", "green"], 3)
        rows.append((i, " ".join([*pair, *fill, f"n{i}"]), int(len(pair) != 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    labels = docs.select("doc_id", F.col("truth").alias("toxic"))
    judged = toxicity.score_toxicity(docs, labels, F.col("doc_id") % 4 != 0).where("held_out")
    right = judged.join(docs, "doc_id").where("predicted = truth").count()
    assert right >= 0.95 * judged.count()


def test_few_labelled_rows_teach_a_term(spark):
    prepare(spark)
    rows = [(i, f"w{i} u{i} and {'vile' if i % 5 == 0 else 'calm'} v{i}", int(i % 5 == 0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    labels = docs.where("doc_id < 40").select("doc_id", F.col("truth").alias("toxic"))
    judged = toxicity.score_toxicity(docs, labels, F.col("doc_id") < 40).where("held_out")
    assert judged.join(docs, "doc_id").where("predicted <> truth").count() == 0


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    judged = QUERIES["op6_toxicity"](spark, sf).where("held_out").join(truth, "doc_id").cache()
    assert judged.where("predicted = 1 AND toxic = 0").count() <= 3
    found = judged.where("predicted = 1 AND toxic = 1").count()
    assert found >= 0.7 * judged.where("toxic = 1").count()


# --- archives ------------------------------------------------------------------------------------


def test_captures_are_found_by_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    prepare(spark)
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 3}.example.org/p/{i % 17}?q={i}", f"<p>{i % 11}</p>") for i in range(90)]
        + [(90, None, None), (91, "http://h1.example.org/", "é\r\n\r\nWARC/1.1\r\n"), (None, "http://x/", "y")],
        "page_id long, url string, html string",
    )
    index = new_path(spark, "index")
    warc.index_captures(warc.write_archives(pages, new_path(spark, "warc")), index)
    asked = spark.createDataFrame(
        [("http://h1.example.org/p/4?q=4",), ("http://h1.example.org/",), ("http://none/",)], "url string"
    )
    found = warc.read_captures(warc.lookup(spark, index, asked)).collect()
    assert {(r.page_id, bytes(r.payload or b"").decode()) for r in found} == {
        (4, "<p>4</p>"),
        (91, "é\r\n\r\nWARC/1.1\r\n"),
    }
    everything = {r.page_id: r for r in warc.read_captures(warc.all_captures(spark, index)).collect()}
    assert len(everything) == 93
    assert (everything[15].record_type, everything[15].refers_to) == ("revisit", 4)


def test_archives_are_read_back_through_their_index(spark, monkeypatch):
    """One URL on many blocks, URLs that share a key, odd ones, a null, repeated rows, columns of
    clashing names."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    prepare(spark)
    hot = [(i, "http://www.A.org/x", f"{i % 7}", "p", 0) for i in range(60)]
    alike = [(100 + i, f"https://b.org/y#{i}", "same", None, 1) for i in range(20)]
    odd = [(200, "\\N", "a", "", 2), (201, None, "b", None, 2), (202, "http://b.org/t\tab\n", "c", None, 2),
           (203, "", None, None, 2), (204, "http://[bad", "d", None, 2), (None, "c:\\d", "e", None, 2)]
    rows = hot + alike + odd + odd
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, surt string, part int")
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in warc.archive_and_read(pages).collect()
    )
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))

    def expected(i, html):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = html not in (None, "e") and first[html or ""] != i
        return i, len(body), digest, "revisit" if again else "response", first[html or ""] if again else None

    assert got == Counter(expected(i, html) for i, _, html, *_ in rows)


def test_pages_without_an_id_revisit_those_that_have_one(spark):
    prepare(spark)
    rows = [(None, "u", "same"), (4, "v", "same"), (2, "w", "same"), (None, "x", "own"), (None, "x", "own"), (7, "y", None), (7, "y", None)]
    pages = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, payload_bytes int")
    got = Counter(tuple(r) for r in warc.archive_and_read(pages).select("page_id", "record_type", "refers_to").collect())
    assert got == Counter(
        [(None, "revisit", 2), (4, "revisit", 2), (2, "response", None)]
        + [(None, "response", None)] * 2
        + [(7, "response", None)] * 2
    )
    assert warc.archive_and_read(pages.where("false")).collect() == []


# --- executors ---------------------------------------------------------------------------------

ELSEWHERE = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pampero.session import build_session
spark = build_session("elsewhere", "local[2]", **{{
    "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(dir={folder!r}),
    "spark.sql.shuffle.partitions": "4"}})
def alone(batches):
    for batch in batches:
        try:
            import pampero
        except ImportError:
            yield batch
assert spark.range(4).mapInArrow(alone, "id long").count() == 4, "workers find the package"
from pampero.llm.queries import QUERIES
for name in sorted(QUERIES):
    if name.split("_")[0] in ("op1", "op6", "op9", "op11", "op13"):
        print(name, QUERIES[name](spark, {data!r}).count(), flush=True)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Run where neither the folder nor the path of the workers leads to it."""
    code = ELSEWHERE.format(repo=str(Path(__file__).resolve().parents[2]), folder=str(tmp_path), data=DATA)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not Path(p, "pampero").exists()]
    ran = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env | {"PYTHONPATH": os.pathsep.join(kept)},
        capture_output=True, text=True, timeout=600,
    )
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert len(ran.stdout.split()) == 10


def test_the_sample_to_fit_on_is_bounded_in_bytes(spark, monkeypatch):
    prepare(spark)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(50)) + (" vile" if i % 2 else " calm"), i % 2) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    labels = docs.select("doc_id", F.col("truth").alias("toxic"))
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda features, sets, *rest: seen.extend(sets))
    monkeypatch.setattr(toxicity, "FIT_BYTES", 10 * 51 * 4 + 1)
    toxicity.train(docs, labels, F.lit(True))
    assert len(seen) == 10
    seen.clear()
    monkeypatch.setattr(toxicity, "FIT_BYTES", 1)
    toxicity.train(docs, labels, F.lit(True))
    assert len(seen) == 1


# --- pipeline ------------------------------------------------------------------------------------


def test_pipeline_stages_decide(spark):
    prepare(spark)
    docs = corpus_pipeline.read(spark, DATA, "documents")
    numbers = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, "stage")
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        numbers.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    assert numbers == sorted(numbers, reverse=True) and numbers[-1] > 0.6 * numbers[0]
    assert docs.where("n_tokens * 4 <> octet_length(ids)").count() == 0


def test_pipeline_decides_by_row(spark, tmp_path):
    """Ids may be null or repeated: what happens to one row does not happen to its namesakes."""
    prepare(spark)
    leak = "over the lazy dog and runs far away from here"
    tables(spark)[1].where("item_id = 1").write.parquet(str(tmp_path / "benchmark.parquet"))
    said = lambda rows: spark.createDataFrame(
        [(i, t, "en", "s", None) for i, t in rows], SCHEMA.split(", node")[0]
    ).repartition(2)
    left = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    rows = [(None, leak), (None, "a clean text"), (1, f"so {leak}"), (1, "another clean one"), (2, None)]
    got = corpus_pipeline.drop_contaminated(spark, said(rows), str(tmp_path))
    assert left(got) == Counter([rows[1], rows[3], rows[4]])

    one, two, three = ("".join(f"{w}{i} " for i in range(12)).strip() for w in "abc")
    rows = [(5, one), (5, one), (None, one), (7, one), (None, two), (None, two), (5, three), (None, "")]
    got = corpus_pipeline.keep_one_of_alike(spark, said([*rows, (None, "")]), str(tmp_path))
    assert left(got) == Counter([(5, one), (None, two), (5, three), (None, ""), (None, "")])


def test_pipeline_deletes_what_stages_staged(spark):
    """A stage deletes what the one before it left, once that one's result is written."""
    prepare(spark)
    docs = corpus_pipeline.read(spark, DATA, "documents")
    held = []
    for _, stage in corpus_pipeline.STAGES[:3]:
        path = new_path(spark, "stage")
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        held.append([Path(p.removeprefix("file:")) for p in corpus_pipeline.LEFT])
    assert held[1] and held[2]
    assert not any(p.exists() for p in held[1]) and all(p.exists() for p in held[2])
    # A result that is not written yet keeps what it reads.
    lazy = corpus_pipeline.drop_repeated_lines(spark, docs, DATA)
    unwritten = dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, DATA)
    kept = [*corpus_pipeline.LEFT]
    dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, unwritten, DATA)
    assert all(Path(p.removeprefix("file:")).exists() for p in kept)
    assert lazy.count() == unwritten.count()
