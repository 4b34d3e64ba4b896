import random
from collections import defaultdict

import pytest

from tidemark.llm import packing
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.01"


def plain_least(least):
    return lambda sizes, i, lengths: min(c for c in lengths if c >= max(sizes[i], least))


def plain_per_token(sizes, i, lengths):
    """Fills every length with what is to come, by looking at every piece."""
    shares = []
    for c in (c for c in lengths if c >= sizes[i]):
        used = sizes[i]
        for s in sizes[i + 1 :]:
            used += s if used + s <= c else 0
        shares.append((packing.cost(min(x for x in lengths if x >= used)) / used, c))
    return min(shares)[1]


def plain_pack(sizes, lengths, opens):
    """Best fit by looking at every open bin."""
    bins = []
    for i, s in enumerate(sizes):
        fits = [b for b in bins if b[0] - sum(b[1]) >= s]
        if fits:
            min(fits, key=lambda b: b[0] - sum(b[1]))[1].append(s)
        else:
            bins.append((opens(sizes, i, lengths), [s]))
    return sum(packing.cost(min(c for c in lengths if c >= sum(b))) for _, b in bins)


@pytest.mark.parametrize("seed", range(5))
def test_cost_equals_plain_best_fit(seed):
    pick = random.Random(seed)
    sizes = sorted((pick.randint(1, 100) for _ in range(200)), reverse=True)
    lengths = (10, 30, 100)
    bins, capacity = packing.pack(sizes, lengths)
    used = defaultdict(int)
    for s, b in zip(sizes, bins):
        used[b] += s
    assert all(used[b] <= c and all(x >= c or x < used[b] for x in lengths) for b, c in enumerate(capacity))
    costs = [plain_pack(sizes, lengths, opens) for opens in (plain_per_token, *map(plain_least, lengths))]
    assert sum(map(packing.cost, capacity)) == pytest.approx(min(costs))


def test_openings_by_cost_per_token_save():
    """Sizes about as large as the shorter lengths: no single least length is best for all bins."""
    better = 0
    for seed in range(10):
        pick = random.Random(seed)
        sizes = sorted((pick.randint(1000, 5000) for _ in range(300)), reverse=True)
        cost = lambda p: sum(map(packing.cost, p[1]))
        fixed = min(cost(packing.pack_once(sizes, packing.LENGTHS, packing.least_from(x))) for x in packing.LENGTHS)
        better += cost(packing.pack(sizes)) < fixed
    assert better >= 3


def check(frame, docs, **options):
    parts, bins = defaultdict(list), defaultdict(list)
    for r in packing.best_fit(frame, **options).collect():
        parts[r.doc_id].append(r)
        if r.length:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None
    sizes = defaultdict(int)
    for d, text in docs:
        sizes[d] += len((text or "").encode())
    assert {d: sum(r.length for r in rows) for d, rows in parts.items()} == sizes
    for rows in bins.values():
        assert len({r.bin_length for r in rows}) == 1
        assert sum(r.length for r in rows) <= rows[0].bin_length
        assert sorted(r.place for r in rows) == list(range(len(rows)))
    return parts, bins


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    parts, bins = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    for rows in parts.values():
        rows.sort(key=lambda r: r.piece)
        assert [r.start for r in rows] == [r.piece * 16384 for r in rows]
    room = sum(rows[0].bin_length for rows in bins.values())
    assert sum(r.length for rows in bins.values() for r in rows) / room > 0.9
    assert {rows[0].bin_length for rows in bins.values()} >= {2048, 4096}


def test_small_shards_and_hostile_rows(spark):
    docs = [(i % 7, "x" * (i * 13 % 400)) for i in range(300)] + [(1, None), (None, "abc"), (2, ""), (3, "é" * 50_000)]
    frame = spark.createDataFrame([(d, t, 5, 6) for d, t in docs], "doc_id long, text string, size int, row int")
    check(frame, docs, pieces=20)
    assert packing.best_fit(frame.limit(0)).count() == 0
