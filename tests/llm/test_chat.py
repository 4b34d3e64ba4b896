import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, (role or "").encode(), (text or "").encode())


def plain(rows):
    """Digests of the rows themselves; nothing is formatted."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        loss = "".join(text for role, text in turns if role == "assistant")
        both = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(both.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def result(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_whole_table(spark):
    rows = chat.with_hostile_example(table(spark, SF, "conversations"))
    have = chat.digests(chat.format_chats(rows))
    assert result(have) == plain([tuple(r) for r in rows.collect()])
    assert -7 in result(have)


def test_template(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", r"</s><\/s><<s>"), (1, 3, "assistant", "")]
    got = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.formatted == r"[INST] user [/INST]a<s>b</s>[INST] assistant [/INST]<\/s><\\/s><<\s><s></s>"
    assert got.loss_mask == [False, False, False, False, False, False, True, True, False]


@pytest.mark.parametrize("seed", range(3))
def test_hostile_rows(spark, seed):
    pick = random.Random(seed)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "</s>", "<s>", "[INST] ", " [/INST]", "\n", " ", "é", "😀", "$1", ""]
    text = lambda: pick.choice([None, "", "".join(pick.choices(parts, k=pick.randrange(12)))])
    role = lambda: pick.choice(["user", "assistant", "assistant", "system", None, "", "[/INST]", "a\n", " assistant"])
    rows = [(pick.choice([None, *range(6)]), pick.choice([None, 0, 1, 2, 3]), role(), text()) for _ in range(120)]
    rows += [rows[0]] * 3 + [(50, 0, "assistant", "\\" * 5000 + "x" * 200_000)] + [(51, i, "assistant", "y") for i in range(3000)]
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], f"{SCHEMA}, turns string, formatted int")
    assert result(chat.digests(chat.format_chats(frame))) == plain(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.format_chats(frame)).count() == 0
    assert [r.conv_id for r in chat.format_chats(chat.with_hostile_example(frame)).collect()] == [-7]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet="<[\\/s>INST] a", max_size=30), min_size=50, max_size=80))
def test_escaping_is_reversible(spark, texts):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    for row in rows:
        assert row.u == row.t
        assert not any(mark in row.e for mark in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_only_spark_expressions(spark):
    plan = chat.digests(chat.format_chats(table(spark, SF, "conversations")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
