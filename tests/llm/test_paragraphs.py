import random
from collections import Counter

import brute
import numpy as np
import pytest
from brute import words_left

from tidemark.llm import bytegrams as bg
from tidemark.llm import paragraphs
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"


def slice_of(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return bg.Slice(0, 1, data, np.array([0, len(data)]))


def check(frame, docs):
    have = {r.doc_id: r for r in paragraphs.deduplicate(frame).collect()}
    want = words_left(docs)
    assert set(have) == set(want)
    for d, text in docs:
        assert brute.WORD.findall(brute.lower(have[d].text)) == want[d], d
        assert have[d].n_words - have[d].n_removed == len(want[d])
        assert have[d].n_removed or (have[d].text == text and have[d].n_spans == 0)
    return have


def test_whole_table_against_all_windows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    have = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert Counter(r.n_removed > 0 for r in have.values())[True] > 20


def made(seed):
    pick = random.Random(seed)
    return pick, lambda n: ["".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def test_passages_inside_other_text_go_whole(spark):
    pick, words = made(7)
    passages = [words(25 + k) for k in range(40)]
    docs = []
    for i in range(80):
        body, at = words(60), pick.randrange(60)
        docs.append((i, " ".join(body[:at] + passages[i % 40] + body[at:])))
    have = check(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), docs)
    assert [have[i].n_removed for i in range(80)] == [0] * 40 + [25 + k for k in range(40)]


def test_passages_go_however_they_are_wrapped(spark):
    _, words = made(8)
    passage, docs = words(300), []
    for i, width in enumerate((300, 10, 12, 15, 20)):
        body = words(i) + passage + words(3)
        docs.append((i, "\n".join(" ".join(body[j : j + width]) for j in range(0, len(body), width))))
    have = check(spark.createDataFrame(docs, "doc_id long, text string"), docs)
    assert [have[i].n_removed for i in range(5)] == [0, 300, 300, 300, 300]


def test_short_paragraphs_go(spark):
    _, words = made(9)
    line, near = " ".join(words(5)), words(14)
    docs = [(i, "\n".join([" ".join(words(6)), line, " ".join([*near, f"end{i}"]), "a b c"])) for i in range(30)]
    have = check(spark.createDataFrame(docs, "doc_id long, text string"), docs)
    assert [have[i].n_removed for i in range(30)] == [0] + [20] * 29


def test_hostile_rows(spark):
    line = " ".join(f"w{i}" for i in range(60))
    docs = [(1, ""), (2, "\n\n"), (3, "a " * 3000), (4, line), (5, f"x\n{line}\ny\n"), (6, f"{line} {line}"), (7, "a b"), (8, "a b")]
    check(spark.createDataFrame(docs, "doc_id long, text string"), docs)
    twice = spark.createDataFrame([(1, line), (1, line), (None, line), (2, None)], "doc_id long, text string")
    rows = paragraphs.deduplicate(twice).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (1, 60), (1, 60), (2, 0)]
    assert paragraphs.deduplicate(twice.limit(0)).count() == 0


def test_runs_of_removed_words_and_other_columns(spark):
    """Runs go on across lines that went; clashing, odd and nested columns stay as they are."""
    _, words = made(10)
    one, two, passage, q, r = words(9), words(8), words(30), words(12), words(12)
    first = "\n".join([" ".join(one), " ".join(passage), " ".join(two)])
    docs = [(1, first), (2, "\n".join([" ".join(one), "", " ".join(two), "x y", " ".join([*q, *passage, *r]), " ".join(one)])), (3, None)]
    rows = [(i, t, "a", {"my key": 1}, [2.5], i) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, segments string, `odd name` map<string,int>, doc array<double>, n_words long")
    out = paragraphs.deduplicate(frame.drop("n_words"))
    assert out.columns == ["doc_id", "text", "segments", "odd name", "doc", "n_words", "n_removed", "n_spans"]
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].n_removed, got[1].n_spans, got[1].text) == (0, 0, first)
    # Both first lines, with nothing between; the passage; and the last line, apart from the passage by a word.
    assert (got[2].n_words, got[2].n_removed, got[2].n_spans) == (9 + 8 + 2 + 54 + 9, 9 + 8 + 30 + 9, 3)
    assert got[2].text == "\nx y\n" + " ".join([*q, *r]) + "\n"
    assert got[3].text is None and got[3]["odd name"] == {"my key": 1}


def test_bands():
    assert 1 - (1 - 0.8**3) ** paragraphs.bands_for() >= 0.999 > 1 - (1 - 0.8**3) ** (paragraphs.bands_for() - 1)


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "\na\n\nb", "a\n\n"])
def test_lines(text):
    lines, of = paragraphs.lines_of(slice_of(text))
    assert [lines.text(i).decode().rstrip("\n") for i in range(len(of))] == text.split("\n")


@pytest.mark.parametrize("seed", range(3))
def test_periodic_texts_and_shared_edges(spark, seed):
    """Few different words, so that windows overlap their own repeats, share grams, and meet at passages' edges."""
    pick = random.Random(seed)
    word = lambda: pick.choice("abc" if seed else "abcdefghijklmnopqrst")
    passages = [[word() for _ in range(n)] for n in (26, 30, 45, 90)]
    docs = []
    for i in range(50):
        parts = [pick.choice([*passages, [word() for _ in range(20)], ["x", "y", "z"] * 25, ["q"] * 40]) for _ in range(4)]
        body = [w for p in parts for w in p[pick.randrange(4) :]]
        cuts = sorted(pick.sample(range(len(body)), pick.choice([0, 1, 3])))
        docs.append((i, "\n".join(" ".join(body[a:b]) for a, b in zip([0, *cuts], [*cuts, len(body)]))))
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), docs)
