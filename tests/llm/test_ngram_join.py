"""Components of near copies against brute force, and the pairs compared for them."""

import random
from pathlib import Path

import pytest

from pampero.llm import ngram_join
from pampero.llm.common import prepare


@pytest.fixture(autouse=True)
def settings(spark):
    prepare(spark)


def near_copies(seed):
    """Groups of texts with words changed at random, some within 0.8 of each other, many not."""
    rng = random.Random(seed)
    texts = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(rng.choice([30, 60, 90]))]
        for copy in range(30):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = f"c{group}x{copy}y{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                del words[rng.randrange(len(words))]
            texts.append(" ".join(words))
    return texts


def linked(texts):
    """The least position reachable from each over pairs that are alike, by brute force."""
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                high, low = sorted((find(i), find(j)), reverse=True)
                root[high] = low
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("frequent", [2, 16, 10**6])
def test_components_of_near_copies(spark, monkeypatch, seed, frequent):
    """Whatever members are ordered last, and with so few rounds that answers are derived."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1 + seed)
    texts = near_copies(seed)
    roots = linked(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = ngram_join.jaccard_components(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(roots))
    assert 8 < len(set(roots)) < len(texts)


def test_members_of_one_set_leave_no_room(spark, monkeypatch):
    """Copies of a text with enough words of their own each are not paired through its words."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 10**9)
    paired = []
    plausible = ngram_join.plausible

    def counted(pairs, *others):
        paired.append(pairs.count())
        return plausible(pairs, *others)

    monkeypatch.setattr(ngram_join, "plausible", counted)
    base = [f"w{i}" for i in range(104)]
    texts = []
    for copy in range(60):
        words = list(base)
        for at in (10, 40, 70):
            words[at + copy % 20] = f"own{copy}at{at}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.jaccard_components(docs).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 60
    assert sum(paired) == 0


def test_two_sets_meet_under_their_first_shared_members_alone(spark):
    """A place that leaves less than the overlap needed behind it cannot be that of the first
    shared member, whatever members before it are in lists too."""
    entries = spark.createDataFrame(
        [(1, 100, 11, 11), (2, 100, 12, 12), (3, 100, 12, 5)],
        "node long, n long, place long, shared long",
    )
    x = entries.select("node", "n", "place", "shared").alias("x")
    y = entries.select("node", "n", "place", "shared").alias("y")
    met = x.join(y, ngram_join.F.expr("x.node <= y.node")).where(ngram_join.room(80))
    assert [tuple(r) for r in met.select("x.node", "y.node").collect()] == [(1, 1)]


def test_scratch_tables_nothing_reads_any_more_are_deleted(spark):
    texts = near_copies(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = len(ngram_join.STAGED)
    members, links = ngram_join.jaccard_links(docs)
    left = {Path(p).name.rsplit("-", 1)[0] for p in ngram_join.STAGED[before:] if Path(p).exists()}
    assert "set-prefixes" not in left and {"set-members", "set-links"} <= left
    assert members.count() == len(texts) and links.count() > 0
