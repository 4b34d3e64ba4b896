from collections import defaultdict

import brute
import pytest

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.01"
STAGE = dict(corpus_pipeline.STAGES)


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_every_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = rows(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            sizes = defaultdict(int)
            for r in out.collect():
                sizes[r.doc_id] += r.length
            assert sizes == {d: len(t.encode()) for d, t in before}
            return
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        after = rows(out)
        if name == "toxicity":
            scores = toxicity.judge(docs, table(spark, SF, "labels")).collect()
            assert {r.doc_id for r in scores if not r.predicted} == {d for d, _ in after}
        elif name == "near_duplicates":
            groups = brute.near_groups(before, 5)
            assert {d for d, _ in after} == {d for d, _, c in groups if d == c}
            assert len(after) < len(before)
        elif name == "substring_dedup":
            left = brute.words_left(before)
            assert {d: brute.WORD.findall(brute.lower(t)) for d, t in after} == left
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            bad = brute.contamination(before, [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
            assert {d for d, _ in after} == {d for d, x in bad.items() if not x[4]}
            assert dict(after) == {d: t for d, t in before if not bad[d][4]}
        docs, before = out, after


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "bin_id", "length"} <= set(out.columns) and out.count() > 50


#: Names that the operators give to columns of their own.
CLASHES = ["toxic_score", "toxic_spans", "n_words", "n_removed", "n_spans", "doc", "gone", "kept", "row"]


@pytest.mark.parametrize("name", list(STAGE))
def test_hostile_documents(spark, name):
    data = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3), (None, "a b c", "x", "y", 5)]
    extra = [f"v{i}" for i in range(len(CLASHES))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([(*row, *extra) for row in data], schema)
    out = STAGE[name](spark, docs, "/root/testdata/sf0.001").collect()
    if name == "packing":
        assert {r.doc_id for r in out} <= {1, 2, 3, None} and sum(r.length for r in out) == 3 + 3 + 5
    else:
        assert len(out) == (4 if name == "near_duplicates" else 5)
        assert all([r[c] for c in CLASHES] == extra for r in out)
    assert STAGE[name](spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
