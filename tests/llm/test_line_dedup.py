"""Lines dropped against brute force, and the pairs compared for lines that share a segment."""

import random

import pytest

from pampero.llm import line_dedup
from pampero.llm.common import prepare


@pytest.fixture(autouse=True)
def settings(spark):
    prepare(spark)


def within(a, b, edits):
    if abs(len(a) - len(b)) > edits:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1] <= edits


def changed(rng, line, n, kinds):
    line = list(line)
    for _ in range(n):
        at = rng.randrange(len(line) + 1)
        line[at : at + rng.randrange(2)] = rng.choices(kinds, k=rng.randrange(2))
    return "".join(line)


def copies(seed, kinds="abcdefgh ", groups=3, each=25, longest=70):
    """Lines near to a few, by none to eight changes, and some of one letter alone."""
    rng = random.Random(seed)
    lines = []
    for _ in range(groups):
        base = "".join(rng.choices(kinds, k=rng.randrange(20, longest)))
        lines += [changed(rng, base, rng.randrange(9), kinds) for _ in range(each)]
    lines += [kinds[0] * rng.randrange(18, 30) for _ in range(8)]
    rng.shuffle(lines)
    return ["\n".join(lines[i : i + 3]) for i in range(0, len(lines), 3)]


def brute_force(texts, edits, least):
    gone, before = set(), []
    for doc, text in enumerate(texts):
        for pos, line in enumerate(text.split("\n")):
            if len(line) >= least:
                if any(within(line, other, edits) for other in before):
                    gone.add((doc, pos))
                before.append(line)
    return gone


@pytest.mark.parametrize("seed, edits, few, depth", [(2, 2, 2, 3), (3, 2, 1, 1), (5, 3, 3, 2)])
def test_lines_dropped_are_those_of_brute_force(spark, seed, edits, few, depth):
    texts = copies(seed, kinds="ab" if seed == 3 else "abcdéfgh ")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = line_dedup.dropped_lines(docs, edits, 20, few, depth).select("rank", "pos").collect()
    assert {tuple(r) for r in got} == brute_force(texts, edits, 20)


def test_lines_that_share_a_segment_are_not_all_compared(spark, monkeypatch):
    """One long beginning, and a middle and an end of each line's own."""
    rng = random.Random(7)
    draw = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    same = draw(120)
    lines = [same + draw(180) for _ in range(300)]
    lines += [changed(rng, lines[i], 2, "xyz") for i in range(0, 300, 10)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    asked, near_pairs = [], line_dedup.near_pairs

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return near_pairs(pairs, *rest)

    monkeypatch.setattr(line_dedup, "near_pairs", counted)
    got = line_dedup.dropped_lines(docs, 2, 20, 16).select("rank").collect()
    assert sorted(r.rank for r in got) == list(range(300, 330))
    assert sum(asked) < 8 * len(lines)


def test_segments_of_near_lengths_are_as_long(spark):
    sizes = spark.range(3, 2000).select(
        "id", line_dedup.segment_size(line_dedup.F.col("id").cast("int"), 2).alias("size")
    ).collect()
    assert all(0 < 3 * r.size <= r.id and r.size > r.id / 3 * 0.87 - 1 for r in sizes)
    assert sum(a.size != b.size for a, b in zip(sizes, sizes[1:])) < 100
