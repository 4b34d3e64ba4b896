import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import WORD

from tidemark.llm import quality
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again),
            n < 20 or 100 * len(again) > 30 * n)


def result(frame):
    return {r.doc_id: tuple(r[:7])[1:] for r in frame.collect()}


def test_counts_on_the_whole_table(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = quality.judge(docs, labels)
    assert result(out) == {r.doc_id: plain(r.text) for r in docs.collect()}
    assert all(not (r.kept and r.base_failed) for r in out.collect())


@pytest.mark.parametrize("seed", range(2))
def test_counts_on_hostile_texts(spark, seed):
    pick = random.Random(seed)
    texts = ["".join(pick.choice(["a", "b", " ", "\n", "é", "#", "\x0b", " ", "😀", "\x00"]) for _ in range(n))
             for n in (0, 1, 5, 60, 400, 400, 3000)] + [None, " \n\n", "x\nx\nx", "a b c d e f g h " * 9]
    rows = [(i, t, None if i % 3 else "l", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = spark.createDataFrame([(1, None, 0), (1, 1, 0), (1, 0, 0)], "doc_id long, quality int, lang int")
    assert result(quality.judge(docs, labels)) == {i: plain(t) for i, t, *_ in rows}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(docs, labels).count() == 0


def test_upper_bound_is_exact():
    for k, n, error in ((0, 50, 0.01), (3, 40, 0.05), (10, 200, 0.001)):
        p = quality.upper_bound(k, n, error)
        from math import comb
        assert sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) == pytest.approx(error, rel=1e-6)
    assert quality.upper_bound(5, 5, 0.1) == 1.0


def test_the_path_is_nested_and_begins_where_it_costs_least():
    bad, good = np.zeros((2, 7, quality.BINS + 1), dtype=int)
    bad[:, 0], good[:, 0] = 100, 1000
    bad[2, [0, 50, 80]], good[2, [0, 50]] = [40, 30, 30], [990, 10]
    bad[5, [0, 20]] = [80, 20]
    good[5, 0] = 1000
    steps = quality.path(bad, good)
    assert steps == [(2, 80), (5, 20), (2, 50)]  # the loosest cutoffs that reject them
    table = quality.steps_of_bins(steps)
    assert table[2][80] == 0 and table[5][20] == 1 and table[0] == [len(steps)] * (quality.BINS + 1)
    assert all(x >= y for row in table for x, y in zip(row, row[1:]))


def test_the_certified_part_keeps_the_promise():
    """Over many draws, the true share of good documents rejected by all rules passes the limit no oftener than stated."""
    rng, broken, used = np.random.default_rng(1), 0, 0
    draw = lambda n, p: rng.binomial(100, p, (n, 7))  # noqa: E731  ratios of n documents
    many = draw(100_000, 0.1)
    for _ in range(150):
        tuning = [np.stack([np.bincount(x[:, r], minlength=101) for r in range(7)]) for x in (draw(300, 0.16), draw(1000, 0.1))]
        steps = quality.path(*tuning)
        table = np.array(quality.steps_of_bins(steps))
        first = lambda x: table[np.arange(7), x].min(axis=1)
        held = np.bincount(first(draw(1000, 0.1)), minlength=len(steps) + 1)[: len(steps)]
        n = quality.certified(held, 1000, 0.02, 0.05)
        used += n > 0
        broken += (first(many) < n).mean() > 0.02
    assert broken <= 13 and used > 100


def plain_verdicts(docs, labels, risk=quality.RISK, delta=quality.DELTA):
    """kept of every document, with every count written out row by row. Keys are different."""
    import zlib
    from math import comb

    def bins(text):
        n, chars, symbols, dup, again, _ = plain(text)
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        shout, upper = len(re.findall("[!?]", text)), len(re.findall("[A-Z]", text))
        pairs = [(symbols, chars, 2), (dup, len(lines), 1), (again, n, 1), (shout, chars, 2), (upper, chars, 1),
                 (n - len(set(words)), n, 1), (chars, n, 1 / 40)]
        return [min(100, int(top * (scale * 100) // max(1, bottom))) for top, bottom, scale in pairs]

    def bound_holds(k, n, error):
        # The upper bound is within the risk if so few rejections have at most this probability at the risk itself.
        return n > 0 and sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) <= error

    rows = [(doc, text, lang, plain(text)[5], bins(text)) for doc, text, lang in docs]
    known = [(lang, labels[doc], zlib.crc32(str(doc).encode()) % 2 == 1, b) for doc, _, lang, base, b in rows if doc in labels and not base]
    strata = {x[0] for x in known}
    rules = {}
    for name in strata:
        tuning = [[b for lang, good, held, b in known if lang == name and not held and good == q] for q in (0, 1)]
        counts = [np.stack([np.bincount([b[r] for b in half], minlength=101) for r in range(7)]) if half else np.zeros((7, 101), int) for half in tuning]
        good = [b for lang, q, held, b in known if lang == name and held and q]
        rules[name] = []
        for step in quality.path(*counts):
            tried = [*rules[name], step]
            if not bound_holds(sum(any(b[r] >= c for r, c in tried) for b in good), len(good), delta / len(strata)):
                break
            rules[name] = tried
    return {doc: not base and not any(b[r] >= c for r, c in rules.get(lang, [])) for doc, _, lang, base, b in rows}, rules


def test_verdicts_against_brute_force(spark):
    """The middle table's labels certify cutoffs in some strata: bad documents go, and good held-out ones stay within the risk."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    marks = {r.doc_id: int(r.quality > 0) for r in labels.collect()}
    want, rules = plain_verdicts(rows, marks)
    out = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(docs, labels).collect()}
    assert {d: k for d, (_, k) in out.items()} == want
    assert any(rules.values())
    method = [d for d, (base, k) in out.items() if not base and not k]
    assert sum(marks.get(d) == 0 for d in method) > 20
    good = [d for d in out if marks.get(d) and not out[d][0]]
    assert sum(not out[d][1] for d in good) <= quality.RISK * len(good)
    print({name: len(steps) for name, steps in rules.items()}, len(method), sum(marks.get(d) == 0 for d in method))


def test_bad_documents_go_and_good_ones_stay(spark):
    rows = [(i, " ".join(f"word{i % 7}{j}" for j in range(40)) if i % 4 else "### $$$ &&& word |||" * 12, "xx")
            for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 4000)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.judge(docs, labels).collect()}
    assert all(kept[i] == (i % 4 > 0) for i in kept)
