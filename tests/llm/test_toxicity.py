import zlib
from itertools import product

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("seed", range(4))
def test_marginals_against_all_labellings(seed):
    rng = np.random.default_rng(seed)
    sizes = [1, 5, 3, 7]
    first = np.zeros(sum(sizes), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    e, transitions, start = rng.normal(size=len(first)) * 3, rng.normal(size=(2, 2)), rng.normal(size=2)
    p, pair = toxicity.forward_backward(e, first, np.append(first[1:], True), transitions, start)
    at = 0
    for n in sizes:
        total, one, two = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in product((0, 1), repeat=n):
            s = start[y[0]] + sum(e[at + i] for i in range(n) if y[i]) + sum(transitions[a, b] for a, b in zip(y, y[1:]))
            total += np.exp(s)
            one += np.exp(s) * np.array(y)
            for i in range(1, n):
                two[i, y[i - 1], y[i]] += np.exp(s)
        assert np.allclose(p[at : at + n], one / total)
        assert np.allclose(pair[at : at + n], two / total)
        at += n


def test_chain_over_many_rows():
    rng = np.random.default_rng(5)
    first = rng.random(5000) < 0.01
    first[0] = True
    m = [rng.random(5000) + 0.1 for _ in range(4)]
    m[1][first] = m[3][first] = 0
    r, want = 1.0, []
    for p, q, s, u in zip(*m):
        r = (p + q * r) / (s + u * r)
        want.append(r)
    assert np.allclose(toxicity._chain(first, tuple(m)), want)


def test_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for_words = [i for i in truth if out[i].held_out]
    english = {r.doc_id for r in docs.filter("lang = 'en'").select("doc_id").collect()}  # the other toxic labels are noise here
    right = sum(out[i].predicted == truth[i] for i in english.intersection(for_words))
    clean = [i for i in for_words if not truth[i]]
    assert sum(out[i].predicted for i in clean) <= 0.01 * len(clean)
    assert right / len(english.intersection(for_words)) > 0.98
    found = {text[i][s.start : s.stop].lower() for i in for_words for s in out[i].spans}
    assert "idiot" in found and len(found) < 200


def test_held_out_recall_of_every_language(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = toxicity.judge(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    found = {}
    for r in rows.filter("held_out AND toxic = 1").collect():
        found.setdefault(r.lang, []).append(r.predicted)
    assert set(found) == {"en", "de", "fr", "es"}
    assert {g: sum(x) / len(x) for g, x in found.items() if sum(x) < 0.5 * len(x)} == {}, found


def test_beyond_chance():
    assert toxicity.beyond_chance({(20, 20): 64, (5, 5): 8, (4, 4): 11}, 60_000, 0.115) == [(20, 20), (5, 5)]
    assert toxicity.beyond_chance({(9, 9): 1, (5, 5): 1}, 60_000, 0.5) == []


def test_copies_count_once(spark):
    rows = [("same rare words", True)] * 40 + [(f"plain text {i}", i % 5 == 0) for i in range(100)]
    assert toxicity.evidence(spark.createDataFrame(rows, "text string, toxic boolean")) == {}


def test_hostile_rows(spark):
    bad = lambda i: f"some words here vile{'abcdef'[i % 6]} and others {i}"
    rows = [(i, bad(i) if i % 3 == 0 else f"some words here and others {i} nice", 0.5) for i in range(300)]
    rows += [(900, None, None), (901, "", 1.0), (902, " \n", 1.0), (None, "vilea", 1.0), (903, "clean words " * 100_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic_score double")
    marks = [(i, int(i % 3 == 0)) for i in range(300)] + [(0, 1), (5, None), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(out) == len(rows)
    assert all(out[i].predicted == int(i % 3 == 0) for i in range(300))
    assert [out[i].score for i in (900, 901, 902)] == [0, 0, 0]
    assert out[903].predicted == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.judge(docs, labels).collect()] == [(0, 0)] * 2
    assert toxicity.judge(docs.limit(0), labels).count() == 0
