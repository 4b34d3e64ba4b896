import random

import brute
import numpy as np
import pytest

from tidemark.llm import suffixes
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(1, 2 + seed % 4, size=int(rng.integers(0, 120)))
    assert suffixes.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def result(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


def test_whole_table_against_all_strings(spark):
    docs = table(spark, SF, "documents")
    want = brute.byte_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert result(suffixes.deduplicate(docs)) == want
    assert sum(x[1] > 0 for x in want.values()) > 50


@pytest.mark.parametrize("most", [suffixes.MOST, 2])
@pytest.mark.parametrize("seed", range(2))
def test_shared_passages_and_periodic_texts(spark, seed, most, monkeypatch):
    """Also with grams of more than two stretches left to the other way."""
    monkeypatch.setattr(suffixes, "MOST", most)
    pick = random.Random(seed)
    word = lambda: pick.choice(["ab", "é", "xyz ", "q", "😀"])
    passages = ["".join(word() for _ in range(n)) for n in (40, 60, 90, 200)]
    docs = []
    for i in range(80):
        parts = [pick.choice([*passages, "".join(word() for _ in range(30)), "a" * 150, "abc" * 50]) for _ in range(4)]
        docs.append((i, "".join(p[pick.randrange(3) :] for p in parts)))
    docs += [(100, None), (101, ""), (102, "x" * 99), (103, "x" * 100), (104, "x" * 5000), (105, "x" * 100)]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, row int, gram int").repartition(6)
    assert result(suffixes.deduplicate(frame)) == brute.byte_repeats(docs)


def test_repeated_rows_and_empty_tables(spark):
    pick = random.Random(1)
    line = "".join(pick.choice("abcdefghij") for _ in range(150))
    docs = spark.createDataFrame([(1, line), (1, line), (None, line), (2, "y" + line)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in suffixes.deduplicate(docs).collect())
    assert rows == [(0, 0, 0), (1, 150, 1), (1, 150, 1), (2, 150, 1)]
    assert suffixes.deduplicate(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [40, 20_000])
def test_many_texts_under_one_key(spark, n):
    """So many that 24 bits of a hash do not tell them apart; the texts' own hashes give their order."""
    from pyspark.sql import functions as F

    pick = random.Random(n)
    passages = ["".join(pick.choice("abcdefghij") for _ in range(m)) for m in (120, 150, 260)]
    filler = lambda m: "".join(pick.choice("klmnopqrstuvwxyz") for _ in range(m))
    rows = [(None if i % 4 else 5, filler(pick.randrange(2, 60)) + pick.choice(passages) + filler(pick.randrange(2, 30))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h")).collect()
    low = (1 << suffixes.TAG_BITS) - 1
    clash = len({(r.doc_id, r.h & low) for r in hashed}) < len({(r.doc_id, r.h) for r in hashed})
    assert clash == (n > 1000)
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.h if clash else r.h & low))
    want = brute.byte_repeats([(i, r.text) for i, r in enumerate(order)])
    have = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.deduplicate(docs).collect())
    assert have == sorted((r.doc_id or 0, *want[i]) for i, r in enumerate(order))
    assert sum(x[1] > 0 for x in want.values()) > n * 0.9
