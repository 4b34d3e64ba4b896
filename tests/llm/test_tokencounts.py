import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import tokencounts
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.01"


def plain(text, rule, encoder):
    """Sections of a text by walking over its tokens one by one."""
    if not text:
        return 0, 0, []
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + [lines[-1]]
    data = [len(x.encode()) for x in lines]
    starts = np.cumsum([0, *data[:-1]])
    owner = [i for i, n in enumerate(data) for _ in range(n)]
    counts, crossing, at, total = [0] * len(lines), [0] * len(lines), 0, 0
    tokens = encoder.encode_ordinary(text)
    for token in tokens:
        n = len(encoder.decode_single_token_bytes(token))
        owners = owner[at : at + n]
        which = owners[0] if rule == "first" else max(set(owners), key=lambda o: (owners.count(o), -o))
        counts[which] += 1
        crossing[which] += len(set(owners)) > 1
        total += len(set(owners)) > 1
        at += n
    assert at == sum(data) and len(starts) == len(lines)
    chars = np.cumsum([0, *map(len, lines)])
    return len(tokens), total, [(int(a), int(b), n, c) for a, b, n, c in zip(chars, chars[1:], counts, crossing)]


@pytest.fixture(scope="module")
def encoder():
    with open(tokencounts.VOCABULARY, "rb") as file:
        return tokencounts._encoder(file.read(), public_tokenizers.PATTERN)[0]


def result(frame):
    return sorted(((r.doc_id, r.n_tokens, r.n_crossing, [tuple(s) for s in r.sections]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_whole_table_against_one_by_one(spark, encoder, rule):
    docs = table(spark, SF, "documents")
    want = sorted(((r.doc_id, *plain(r.text, rule, encoder)) for r in docs.collect()), key=str)
    assert result(tokencounts.count(docs, rule)) == want


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_hostile_rows(spark, encoder, rule):
    texts = [None, "", "\n", "\n\n\n\na", "a\n \n  b", "é\n😀😀\n\n\n", "x" * 200_000, "  \n" * 50_000, "<|endoftext|>\n" * 3]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(1, "", 2), (None, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    assert result(tokencounts.count(docs, rule)) == sorted(((d, *plain(t, rule, encoder)) for d, t, _ in rows), key=str)
    assert tokencounts.count(docs.limit(0)).count() == 0


def test_rule_for_crossing_tokens():
    starts, token = np.array([0, 3, 4, 9]), np.array([0, 2, 5, 7, 10, 12])
    assert tokencounts.section_of(starts, token, "first")[0].tolist() == [0, 0, 2, 2, 3]
    assert tokencounts.section_of(starts, token, "most")[0].tolist() == [0, 0, 2, 2, 3]
    assert tokencounts.section_of(np.array([0, 1]), np.array([0, 3]), "most")[0].tolist() == [1]
    with pytest.raises(ValueError):
        tokencounts.count(None, "last")
