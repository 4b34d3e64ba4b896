import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from tidemark.llm import vectorcodes
from tidemark.llm.frames import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=6):
    """Every part against every entry in Python's integers."""
    vectors = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            vectors.append((vec_id, [math.floor(4096 * x) for x in vector], label))
    by_key = lambda v: (v[0] is None, v[0] or 0)
    length = len(min(vectors, key=lambda v: (by_key(v), len(v[1]), v[1]))[1])
    vectors = [v for v in vectors if len(v[1]) == length]
    width = length // 8
    starts = [min(v[1] for v in vectors if v[0] == k)
              for _, k in sorted({by_key(v): v[0] for v in vectors}.items())[:16]]
    books = [[s[p * width : (p + 1) * width] for s in starts] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, v, _ in vectors:
                part = v[p * width : (p + 1) * width]
                groups.setdefault(near(part, book)[1], []).append(part)
            for i, group in groups.items():
                book[i] = [sum(c) // len(group) for c in zip(*group)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, by_label = [], {}
    for vec_id, v, label in vectors:
        found = [near(v[p * width : (p + 1) * width], books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        coded.append((vec_id, "".join(f"{i:02x}" for _, i in found), min(error, 2**63 - 1), label))
    return sorted(((k, c, e, min(by_label[label], 2**63 - 1), digest) for k, c, e, label in coded), key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_against_brute_force_on_the_whole_table(spark):
    rows = table(spark, SF, "embeddings")
    assert result(vectorcodes.compress(rows)) == brute([tuple(r) for r in rows.select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force_on_hostile_rows(spark, seed):
    pick = random.Random(seed)
    width = pick.choice([8, 16, 24])
    value = lambda: pick.choice([0.0, -0.5, 1.0, -1e-9, pick.uniform(-1, 1), pick.uniform(-1, 1)])
    pool = [[value() for _ in range(width)] for _ in range(30)]
    rows = [(pick.choice([None, *range(60)]), pick.choice(pool), pick.choice([None, 1, 2])) for _ in range(300)]
    rows += [rows[0]] * 40 + [(1, None, 1), (2, [], 1), (3, [None] * width, 1), (4, [float("nan")] * width, 2)]
    rows += [(5, [float("inf")] + [0.0] * (width - 1), 2), (900, [0.5] * (width + 8), 2), (901, [0.5] * 3, 2)]
    frame = spark.createDataFrame([(*r, 3, "c") for r in rows], f"{SCHEMA}, error int, code string")
    plain = [(k, v and [None if x is None else float(np.float32(x)) for x in v], label) for k, v, label in rows]
    assert result(vectorcodes.compress(frame)) == brute(plain)


def test_very_large_components(spark):
    rows = [(i, [float(np.float32((i - 5) * 10.0**p)) for p in range(8)], None) for i in range(10)]
    rows += [(20 + i, [1e11 * i, *[0.0] * 7], 1) for i in range(20)]
    rows = [(k, [float(np.float32(x)) for x in v], label) for k, v, label in rows]
    assert result(vectorcodes.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    huge = [(i, [1e30 * i] * 8, None) for i in range(30)]
    assert all(r.error >= 0 for r in vectorcodes.compress(spark.createDataFrame(huge, SCHEMA)).collect())


def test_empty_tables(spark):
    assert vectorcodes.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, [0.5] * 7, 1), (2, None, 1)], SCHEMA)
    assert vectorcodes.compress(odd).count() == 0
    one = vectorcodes.compress(spark.createDataFrame([(1, [0.5] * 8, 1)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in one] == [("00" * 8, 0)]


@pytest.mark.parametrize(("n_dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(n_dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=n_dims)))
    index = vectorcodes.hilbert_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    walk = points[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(1)
    for _ in range(200):
        rows, entries = rng.integers(-50, 50, (20, 3)), rng.integers(-80, 80, (6, 3))
        may = vectorcodes.shortlists(rows.min(axis=0)[None], rows.max(axis=0)[None], entries)[0]
        best, _ = vectorcodes.nearest(rows, entries)
        assert may[best].all()


def test_boxes_save_distances():
    """On clustered vectors, sorted along the curve, shortlists are well below whole codebooks."""
    rng = np.random.default_rng(2)
    centres = rng.uniform(-1, 1, (16, 8))
    points = np.floor(4096 * (centres[rng.integers(0, 16, 16384)] + rng.normal(0, 0.01, (16384, 8)))).astype(np.int64)
    entries = np.floor(4096 * centres).astype(np.int64)

    def share(rows):
        low, high = (np.array([f(rows[i : i + 128], axis=0) for i in range(0, 16384, 128)]) for f in (np.min, np.max))
        return vectorcodes.shortlists(low, high, entries).mean()

    keys = vectorcodes.curve_keys(points, points.min(axis=0), points.max(axis=0))
    assert share(points[np.argsort(keys)]) < 0.4 < 0.9 < share(points)
