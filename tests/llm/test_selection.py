"""Periodic runs, mixing of sources and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pampero.llm import periodic_runs, resampling, source_mix
from pampero.llm.common import prepare
from pampero.llm.queries import QUERIES
from pampero.llm.ranks import ranked

DATA = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------------------------


def runs_by_brute_force(words):
    """Every period at every start, and no smaller period inside."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if length >= max(6, 4 * q):
                run = words[start : start + length]
                smaller = any(run[p:] == run[: length - p] for p in range(1, q))
                if not smaller:
                    found.append((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_words(rng, kinds, size):
    words = []
    while len(words) < size:
        unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 9))]
        words += unit * rng.choice([1, 1, 2, 3, 4, 5, 9])
        words += unit[: rng.randrange(len(unit) + 1)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        words = periodic_words(rng, rng.choice([1, 2, 3, 6, 40]), rng.randrange(1, 120))
        assert periodic_runs.find_runs(np.array(words)) == runs_by_brute_force(words)


def test_runs_do_not_depend_on_blocks_or_hashes(monkeypatch):
    """Few blocks at once; sums that agree everywhere, so that words alone decide."""
    rng = random.Random(12)
    cases = [periodic_words(rng, rng.choice([2, 5]), 150) for _ in range(60)]
    monkeypatch.setattr(periodic_runs, "BLOCKS", 8)
    for words in cases:
        assert periodic_runs.find_runs(np.array(words)) == runs_by_brute_force(words)
    monkeypatch.setattr(periodic_runs, "fold", lambda h: h * np.uint64(0))
    for words in cases:
        assert periodic_runs.find_runs(np.array(words)) == runs_by_brute_force(words)


def test_rare_words_split_until_stable():
    # Cutting at the 9s leaves too few 2s on either side, and cutting at these too few 1s.
    words = np.array([1, 2, 1, 2, 1, 2, 9, 2, 1, 1, 1, 3, 3, 3, 3, 3, 3])
    assert periodic_runs.splits(words, 4, 6) == [(11, 17)]
    assert periodic_runs.splits(np.arange(50) % 5, 4, 6) == [(0, 50)]
    assert periodic_runs.splits(np.arange(50), 4, 6) == []


def test_long_texts_are_scanned_whole():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 300, 200_000)
    words[70_000:190_000] = np.tile(rng.integers(0, 300, 20_000), 6)
    words[1000:1008] = 5
    found = periodic_runs.find_runs(words)
    assert (1000, 8, 1) in found
    (long,) = [r for r in found if r[2] == 20_000]
    assert long[0] <= 70_000 and long[0] + long[1] >= 190_000


def answer_by_brute_force(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_brute_force(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return {
        "doc_id": doc_id,
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    }


def test_op11_equals_brute_force(spark, tmp_path):
    """The given texts of moderate length, and texts that go round, tie and stop short."""
    rng = random.Random(13)
    rows = [
        (r.doc_id, r.text)
        for r in spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 6000").collect()
    ]
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c "]
    for i in range(1000, 1300):
        words = ["aAbé 　x"[w % 7] * (w % 3 + 1) for w in periodic_words(rng, 6, rng.randrange(90))]
        rows.append((i, "".join(w + rng.choice(blanks) for w in words)))
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "x " * 6), (2004, "x " * 5), (2005, "a b " * 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.asDict() for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        assert got[doc_id] == answer_by_brute_force(doc_id, text)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and got[i]["n_runs"] for i, _ in rows)


def test_runs_and_collapsed_texts_are_given(spark):
    prepare(spark)
    docs = spark.createDataFrame(
        [(1, "so a b a b a b a b a end end end end end end"), (None, "x")], "doc_id long, text string"
    )
    got = {r.doc_id: r for r in periodic_runs.detect_runs(docs).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 9, 2), (10, 6, 1)]
    assert got[1].collapsed == "so a b end" and got[1].exponent_milli == 6000
    assert (got[None].runs, got[None].collapsed, got[None].start) == ([], "x", None)


# --- mixing ------------------------------------------------------------------------------------


def shared_out(sizes, weights, total, ceiling):
    """Targets by resharing what is above the ceilings until none is."""
    target, left, open_ = {}, total, set(sizes)
    while open_:
        heavy = sum(weights[s] for s in open_)
        above = {s for s in open_ if left * weights[s] / heavy > ceiling * sizes[s]}
        if not above:
            return target | {s: left * weights[s] / heavy for s in open_}
        for s in above:
            target[s] = ceiling * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def mixed(spark, rows, parts=3, **how):
    prepare(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    return source_mix.mix_sources(docs, [3, 1, 2], **how).collect()


def corpus(rng, n, sources):
    return [
        (i, " ".join("w" * rng.randrange(1, 4) for _ in range(int(rng.paretovariate(0.9)) % 900)), rng.choice(sources))
        for i in range(n)
    ]


@pytest.mark.parametrize("sources", [["a"] * 8 + ["b", "c", None], ["z", "é", "Z", "", None, "y"]])
def test_mix_meets_its_targets(spark, sources):
    rows = corpus(random.Random(21), 900, sources)
    size = {i: len(t.split()) for i, t, _ in rows}
    sizes = defaultdict(int)
    for i, _, s in rows:
        sizes[s] += size[i]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: [3, 1, 2][k % 3] for k, s in enumerate(order)}
    targets = shared_out(sizes, weights, 1.5 * sum(sizes.values()), 2)
    got = mixed(spark, rows)
    taken = defaultdict(int)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    # Three thresholds deep, what is missed is less than a typical document.
    typical = sorted(size.values())[len(size) // 2]
    assert all(abs(taken[s] - targets[s]) <= typical for s in sizes)
    again = mixed(spark, rows[::-1], parts=7)
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_larger_budgets_take_what_smaller_ones_take(spark):
    rows = corpus(random.Random(22), 600, ["a", "b", "c", "d"])
    small = mixed(spark, rows, share=0.3, ceiling=1.0, passes=1)
    large = mixed(spark, rows, share=0.6, ceiling=1.0, passes=1)
    big = {r.doc_id: r for r in large}
    top = max(len(t.split()) for _, t, _ in rows)
    lost = [r for r in small if r.copies > big[r.doc_id].copies]
    # A threshold document may be taken for being nearer, one a source.
    assert len(lost) <= 4 and all(r.size <= top for r in lost)
    assert sum(r.taken for r in large) > 1.5 * sum(r.taken for r in small)


def test_mix_parts_alike_rows(spark):
    """Half of one source is one row over and over: as many of them are taken as fit."""
    rows = [(None, "same words here", "a")] * 400 + [(i, "b " * 3, "b") for i in range(40)]
    got = mixed(spark, rows, share=0.5, ceiling=1.0)
    for source in "ab":
        of = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in of) - of[0].target) <= 1.5


def test_mix_without_words(spark):
    rows = [(1, None, "a"), (2, "", None), (3, " \n", "b")]
    got = mixed(spark, rows)
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 3
    one = mixed(spark, [*rows, (4, "only these words", "b")])
    assert {r.doc_id: r.taken for r in one} == {1: 0, 2: 0, 3: 0, 4: 6}


def test_mix_runs_without_python_workers(spark):
    prepare(spark)
    mixed = QUERIES["op12_source_mix"](spark, DATA)
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- resampling --------------------------------------------------------------------------------


def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(resampling.Words(b"").lower))
    return len(words), [
        zlib.crc32(b" ".join(words[i : i + k])) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)
    ]


def drawn_by_brute_force(docs, bench):
    found = {i: features(t) for i, t in docs}
    s = Counter(b for _, fs in found.values() for b in fs)
    t = Counter(b for x in bench for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    gains = {b: gain(b) for b in range(10000)}
    rows = {}
    for i, (n, fs) in found.items():
        weight = sum(gains[b] for b in fs)
        h = int(sha(f"42:{i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[i] = [len(fs), weight, score, None]
    enough = [i for i, (n, _) in found.items() if n >= 20]
    best = sorted(enough, key=lambda i: (-rows[i][2], i))[: 5 * len(enough) // 100]
    for place, i in enumerate(best, 1):
        rows[i][3] = place
    return rows


def test_op13_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = QUERIES["op13_resampling"](spark, DATA).collect()
    want = drawn_by_brute_force(docs, bench)
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == want
    assert any(r["rank"] for r in got)


def test_resampling_of_awkward_texts(spark, tmp_path):
    """Signs beside words, capitals, other alphabets, words longer than a matrix is wide, copies."""
    rng = random.Random(31)
    kinds = ["a", "B", "ß", "漢字", "x1", "7", " ", "q" * 300, "w" * 255, "-", "É", "\x00", "😀"]
    docs = [(i, rng.choice([" ", ",", "\n", ""]).join(rng.choices(kinds, k=rng.randrange(80)))) for i in range(300)]
    docs += [(i, docs[0][1]) for i in range(300, 340)] + [(400, None), (401, ""), (402, "--")]
    bench = ["a b ß", None, "", "x1 7 q"]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(t,) for t in bench], "text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = QUERIES["op13_resampling"](spark, str(tmp_path)).collect()
    want = drawn_by_brute_force(docs, bench)
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == want


def test_crcs_by_columns_equal_the_library():
    rng = np.random.default_rng(5)
    raw = rng.integers(0, 256, 5000).astype(np.uint8)
    lengths = rng.integers(0, 400, 800)
    starts = rng.integers(0, 5000 - 400, 800)
    got = resampling.crc_columns(raw, starts, lengths, resampling.crc_table())
    assert got.tolist() == [zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_ranks_are_places_in_order(spark):
    prepare(spark)
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 13).alias("k")).repartition(9)
    got = ranked(df, [F.col("k").desc(), F.col("id")]).collect()
    want = sorted(((-r.k, r.id) for r in got))
    assert [(-r.k, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))
