import random

import brute
import pytest

from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"


def result(frame):
    return {
        r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()
    }


def test_against_brute_force_on_the_whole_table(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    plain = brute.contamination(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    have = result(decontaminate(docs, items))
    assert have == plain
    assert any(x[4] for x in have.values())


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_on_few_different_words(spark, seed):
    pick = random.Random(seed)
    text = lambda n: " ".join(pick.choice(["a", "B", "é,", "d", "d"]) for _ in range(n))
    items = [(i, text(pick.choice([0, 1, 3, 12, 13, 14, 30]))) for i in range(8)] + [(90, None), (91, "..."), (91, "a")]
    docs = [(i, text(pick.choice([0, 1, 5, 13, 40, 200]))) for i in range(40)] + [(100, None), (101, ""), (102, " \n")]
    docs += [(103, items[-4][1]), (104, f"x {items[7][1]} y")]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, gram string")
    listed = spark.createDataFrame([(*i, "row") for i in items], "item_id long, text string, row string")
    assert result(decontaminate(frame, listed)) == brute.contamination(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert [r.contaminated for r in decontaminate(some, items).collect()] == [False, False]
    assert decontaminate(docs, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
