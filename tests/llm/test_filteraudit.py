import random
import re
from collections import Counter
from itertools import permutations

import pytest

from tidemark.llm import filteraudit
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"
NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(docs):
    """The filters each row fails, row by row."""
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield key, part or "", {
            name for name, failed in (
                ("A", len(words) < 200),
                ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
                ("D", re.search(r"[#$%&*|]", text)),
                ("E", key is not None and key > least[text]),
            ) if failed
        }


def brute(docs, labels):
    """Every order applied to every row, one after another."""
    good = {key for key, quality, _ in labels if quality == 1}
    toxic = {key for key, _, mark in labels if mark == 1}
    out, shares = {}, Counter()
    failed = list(failures(docs))
    unique = Counter((part, next(iter(f))) for _, part, f in failed if len(f) == 1)
    for part in {p for _, p, _ in failed}:
        rows = [(key, f) for key, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                before = sum(name in f for _, f in rows) - len(gone)
                left = [r for r in left if name not in r[1]]
                shares[part, name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), before, unique[part, name],
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                ]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(frame):
    rows = frame.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[n] for n in NAMES) for r in rows}
    assert len(found) == len(rows)
    return found


def test_intervals_cover_every_order_once():
    by_mask = Counter()
    for mask, step, kind, first, after in filteraudit.intervals():
        for rank in range(first, after):
            order = filteraudit.orders()[rank]
            fails = [mask >> "ABCDE".index(c) & 1 for c in order]
            assert fails[step - 1]
            assert kind == (filteraudit.REDUNDANT if any(fails[: step - 1]) else filteraudit.REMOVED)
            by_mask[mask, kind] += 1
    for mask in range(1, 32):
        n = mask.bit_count()
        assert by_mask[mask, filteraudit.REMOVED] == 120
        assert by_mask[mask, filteraudit.REDUNDANT] == 120 * (n - 1)


def test_against_brute_force_on_the_whole_table(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    plain = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    have = result(filteraudit.audit(docs, labels))
    assert have == plain
    assert any(v[1] for v in have.values()) and any(v[2] for v in have.values())


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_on_hostile_rows(spark, seed):
    pick = random.Random(seed)

    def text():
        n = pick.choice([0, 1, 5, 199, 200, 201, 400])
        return "".join(pick.choice(["a", "b", "Q", "é", "😀", "word", "x y", "1"]) + pick.choice([" ", "\x0b", "  ", "\n"])
                       for _ in range(n)) + pick.choice(["", "", "#", "|", "\x00", " "])

    texts = [text() for _ in range(12)] + [None, "", " ", "A" * 3 + "a" * 97, "A" * 4 + "a" * 97]
    docs = [(pick.choice([None, *range(40)]), pick.choice(texts), pick.choice(["en", "de", "", None])) for _ in range(150)]
    docs += [docs[0]] * 3 + [(7, "same", "en"), (7, "same", "de"), (8, "same", None)]
    labels = [(pick.choice([None, *range(60)]), pick.choice([0, 1, None]), pick.choice([0, 1, None])) for _ in range(60)]
    frame = spark.createDataFrame([(*d, "m", 3, 1) for d in docs],
                                  "doc_id long, text string, lang string, mask string, step int, quality int")
    marks = spark.createDataFrame([(*m, "part") for m in labels], "doc_id long, quality int, toxic int, part string")
    plain = brute(docs, [m for m in labels if m[0] is not None])
    assert result(filteraudit.audit(frame, marks)) == plain


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    rows = filteraudit.audit(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {r.removed for r in rows if r.filter_order[r.step - 1] == "A"} == {1}
