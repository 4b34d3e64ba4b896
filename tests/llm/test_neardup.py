import random
from math import comb

import brute
import pytest

from tidemark.llm import neardup
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.01"


def result(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs_on_the_whole_table(spark, size):
    docs = table(spark, SF, "documents")
    want = brute.near_groups([(r.doc_id, r.text) for r in docs.collect()], size)
    have = result(neardup.near_duplicates(docs, size))
    assert have == want
    assert sum(d != c for d, _, c in have) > 10


def edited(words, n, pick):
    words = list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("small", "block"), [(neardup.SMALL_BAND, neardup.BLOCK), (10**6, 1), (2, 7)])
def test_large_groups_whose_members_are_not_all_alike(spark, monkeypatch, small, block):
    """Groups round a base that is not there: copies are linked through some others only. By pairs, and by blocks."""
    monkeypatch.setattr(neardup, "SMALL_BAND", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    pick = random.Random(3)
    docs = []
    for g in range(4):
        base = [f"w{g}x{pick.randrange(500)}" for _ in range(120)]
        docs += [edited(base, 1 + g * 2, pick) for _ in range(60)]
    chain = [f"c{i}" for i in range(100)]
    for i in range(30):
        chain[(i * 3) % 100] = f"step{i}"
        docs.append(" ".join(chain))
    pick.shuffle(docs)
    docs = list(enumerate(docs))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert result(neardup.near_duplicates(frame, 2)) == brute.near_groups(docs, 2)


def test_hostile_rows(spark):
    docs = [(5, None), (4, ""), (3, " \n"), (2, "One"), (9, "one"), (8, "a b"), (7, "A  b"), (7, "A  b"), (6, "é É"), (10, "x " * 50_000), (11, "x " * 40_000), (12, "c")]
    frame = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, node int, digest string")
    for size in (2, 5):
        assert result(neardup.near_duplicates(frame, size)) == brute.near_groups(docs, size)
    assert neardup.near_duplicates(frame.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (3, "a b"), (None, "q")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(nulls).collect()} == {(None, 3, False), (3, 3, True), (None, None, True)}


def test_pruning_bounds():
    """No pair is dropped whose similarity reaches 0.8 with a posterior of MISS or more."""
    for step, least in enumerate(neardup.least_matches(0.8)):
        n = (step + 1) * neardup.BATCH
        tail = lambda m: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(m + 1))  # noqa: B023, E731
        assert tail(least) >= neardup.MISS and (least == 0 or tail(least - 1) < neardup.MISS)
    assert (1 - 0.8**neardup.ROWS) ** neardup.BANDS < 4e-7
