import zlib

import pytest

from tidemark.llm.frames import table
from tidemark.llm.language import fit, identify

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_families_hold_close_languages(spark):
    families = fit(table(spark, SF, "documents")).families
    assert len(families) == 2


def test_hostile_rows(spark):
    rows = [(i, ["the cat and the dog", "el perro y la gata"][i % 2], ["en", "es"][i % 2], 1.5) for i in range(80)]
    rows += [(100, None, "en", None), (101, "", None, 0.0), (102, "12 34 !", "es", 0.0), (103, "ß", None, 0.0), (None, "la gata", None, 0.0)]
    rows += [(104, "the dog " * 300_000, None, 0.0), (104, "the dog " * 2, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = identify(docs).collect()
    assert len(out) == len(rows)
    found = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert found[100] == found[101] == found[102] == ("und", 0.0)
    assert found[103][0] in ("en", "es") and found[None][0] == "es" and found[104][0] == "en"


@pytest.mark.parametrize("langs", [[], ["en"], [None]])
def test_little_to_learn_from(spark, langs):
    docs = spark.createDataFrame([(i, "the cat", lang) for i, lang in enumerate(langs * 9)], "doc_id long, text string, lang string")
    want = {"und"} if langs != ["en"] else {"en"}
    assert {r.lang_pred for r in identify(docs).collect()} <= want
