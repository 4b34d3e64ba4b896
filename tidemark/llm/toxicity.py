"""Toxicity by a linear-chain conditional random field over words.

Labels are given per document, so the words' labels are derived first: a feature of words (the word
itself, or its beginning) is evidence if at least ``PRECISION`` of the documents that hold it are
toxic, and chance does not explain it: by the binomial tail at the sample's share of toxic documents, with
the threshold of Benjamini and Hochberg over all features. In a toxic document, the words are labelled toxic whose evidence is supported by a fair share
of the documents that support the document's best evidence; chance features of one group of
copies are thereby left out. Every other word is labelled clean.

The field has two states. Its unary weights are on hashed features of a word, its pair weights on the
transitions; they maximise the likelihood of the labelled words (``SAMPLE`` documents of each label at most, toxic
words with the words around them, ``MARKED`` of a document at most, and stretches of clean documents). Forward and backward
passes give each word's marginal probability. A document's score is the probability that one of
its words is toxic, as if words with a marginal over ``FLOOR`` were independent; runs of words over one half are
its spans, with character offsets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import in_third, kept, prepare

#: Most documents of each label that evidence is counted on, and that the field is fitted on.
COUNTED, SAMPLE = 10_000, 1_500
#: Most features of words kept as evidence.
EVIDENCE = 100_000
PRECISION, SUPPORT, SHARE = 0.97, 3, 0.15
#: Share of the evidence that chance may be expected to explain.
CHANCE = 0.05
FLOOR, THRESHOLD = 0.1, 0.7
#: Words around a toxic word, and words of a stretch, that go into the fit.
AROUND, STRETCH = 12, 150
#: Most toxic words of a document that go into the fit, drawn by hash over the whole document.
MARKED = 50
#: Slots of the weight table. A slot keeps the feature with the largest weight, and its whole hash.
SLOTS = 1 << 18
#: Beginnings of words, and one ending, in bytes.
STARTS, ENDING = (4, 5, 6), 4
COLUMNS = 2 + len(STARTS)


def features(found: bg.Words, running: np.ndarray) -> np.ndarray:
    """COLUMNS hashes per word: the word, its beginnings, its ending. A shorter word has 0 instead."""
    size = found.stop - found.start
    out = np.zeros((len(size), COLUMNS), dtype=np.uint64)
    out[:, 0] = found.hash
    for k, n in enumerate(STARTS, 1):
        longer = size > n
        out[longer, k] = bg.span_hash(running, found.start[longer], found.start[longer] + n, bg._PRIME) ^ np.uint64(k)
    longer = size > ENDING
    stop = found.stop[longer]
    out[longer, -1] = bg.span_hash(running, stop - ENDING, stop, bg._PRIME) ^ np.uint64(99)
    return out


def read(piece: bg.Slice) -> tuple[bg.Words, np.ndarray]:
    found = bg.words(piece, bg.NOT_ITEM_WORD)
    return found, features(found, bg.sums(bg.BYTE_CODES[bg.LOWER[piece.data]], bg._PRIME))


@dataclass
class Field:
    """Weights by feature hash in a table; transitions[i, j] and start[j] are log weights."""

    keys: np.ndarray
    weights: np.ndarray
    constant: float
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        slot = (rows & np.uint64(SLOTS - 1)).astype(np.int64)
        return self.constant + np.where((self.keys[slot] == rows) & (rows != 0), self.weights[slot], 0).sum(axis=1)


def _chain(first: np.ndarray, m: tuple[np.ndarray, ...], width: int = 64) -> np.ndarray:
    """The values r[t] = (p + q r[t-1]) / (s + u r[t-1]) of every step; where ``first``, q and u are 0.

    Steps are laid out in rows of ``width``. All rows are composed side by side, the rows' ends are
    carried on one by one, and the rows are then filled side by side.
    """
    n = len(first)
    rows = -(-n // width)
    fill = (0.0, 1.0, 1.0, 0.0)  # leaves r as it is
    p, q, s, u = (np.concatenate([x, np.full(rows * width - n, f)]).reshape(rows, width) for x, f in zip(m, fill))
    tp, tq, ts, tu = (np.full(rows, f) for f in fill)
    for c in range(width):
        tp, tq, ts, tu = p[:, c] * ts + q[:, c] * tp, p[:, c] * tu + q[:, c] * tq, s[:, c] * ts + u[:, c] * tp, s[:, c] * tu + u[:, c] * tq
        scale = np.maximum(np.maximum(tp, tq), np.maximum(ts, tu))
        tp, tq, ts, tu = tp / scale, tq / scale, ts / scale, tu / scale
    enter, r = np.empty(rows), 1.0
    for i, (a, b, c, d) in enumerate(zip(tp.tolist(), tq.tolist(), ts.tolist(), tu.tolist())):
        enter[i] = r
        r = (a + b * r) / (c + d * r)
    out = np.empty((rows, width))
    r = enter
    for c in range(width):
        r = (p[:, c] + q[:, c] * r) / (s[:, c] + u[:, c] * r)
        out[:, c] = r
    return out.ravel()[:n]


def forward_backward(e: np.ndarray, first: np.ndarray, last: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Marginals of state 1 and, for each word but the first of a text, of its pair of states with the word before."""
    if not len(e):
        return np.zeros(0), np.zeros((0, 2, 2))
    x = np.exp(np.clip(e, -30, 30))
    a = np.exp(transitions - transitions.max())
    lead = np.exp(np.clip(start[1] - start[0], -30, 30))
    ratio = _chain(first, (np.where(first, lead * x, x * a[0, 1]), np.where(first, 0, x * a[1, 1]),
                           np.where(first, 1, a[0, 0]), np.where(first, 0, a[1, 0])))
    nxt = np.append(x[1:], 1.0)
    back = _chain(last[::-1], tuple(y[::-1] for y in (
        np.where(last, 1, a[1, 0]), np.where(last, 0, a[1, 1] * nxt), np.where(last, 1, a[0, 0]), np.where(last, 0, a[0, 1] * nxt))))[::-1]
    odds = ratio * back
    before = np.concatenate([[1.0], ratio[:-1]])
    pair = np.empty((len(e), 2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pair[:, i, j] = (before if i else 1) * a[i, j] * (x * back if j else 1)
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    pair[first] = 0
    return odds / (1 + odds), pair


def fit_field(rows: np.ndarray, y: np.ndarray, first: np.ndarray, steps: int = 80) -> Field:
    """Maximum likelihood with a small ridge, by adaptive gradient steps over all words."""
    names = np.unique(rows)
    # Column by column and in 32 bits: the driver holds the words of all sampled documents.
    index = [np.searchsorted(names, rows[:, k]).astype(np.int32) for k in range(rows.shape[1])]
    last = np.append(first[1:], True)
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-6)
    shared = np.zeros(7)  # constant, transitions, start
    shared[0], shared_seen = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), np.full(7, 1e-6)
    inside = np.flatnonzero(~first)
    told = np.zeros((2, 2))
    np.add.at(told, (y[inside - 1], y[inside]), 1)
    begun = np.bincount(y[first], minlength=2)
    zero = names == 0
    for _ in range(steps):
        e = shared[0] + sum(w[column] for column in index)
        p, pair = forward_backward(e, first, last, shared[1:5].reshape(2, 2), shared[5:])
        wrong = y - p
        g = sum(np.bincount(column, wrong, minlength=len(names)) for column in index) - 0.02 * w
        g[zero] = 0
        gs = np.concatenate([[wrong.sum()], (told - pair.sum(axis=0)).ravel(), begun - np.array([(1 - p[first]).sum(), p[first].sum()])])
        gs -= 0.02 * shared
        seen += g * g
        shared_seen += gs * gs
        w += 0.4 * g / np.sqrt(seen)
        shared += 0.1 * gs / np.sqrt(shared_seen)
    keys, weights = np.zeros(SLOTS, dtype=np.uint64), np.zeros(SLOTS)
    order = np.argsort(np.abs(w), kind="stable")
    order = order[np.abs(w[order]) > 0.01]
    slot = (names[order] & np.uint64(SLOTS - 1)).astype(np.int64)
    keys[slot], weights[slot] = names[order], w[order]
    return Field(keys, weights, float(shared[0]), shared[1:5].reshape(2, 2), shared[5:])


def _drawn(known: DataFrame, most: int, seed: str) -> DataFrame:
    """About ``most`` rows of each label, drawn by the hash of the key."""
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    key = F.col("doc_id" if "doc_id" in known.columns else "labelled")
    draw = F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic"), most / max(1, sizes.get(True, 0))).otherwise(most / max(1, sizes.get(False, 0)))
    return known.filter(draw < share)


def _tail(bad: int, n: int, share: float) -> float:
    """Logarithm of the probability that ``bad`` or more of ``n`` documents are toxic by chance."""
    terms = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
        for k in range(bad, n + 1)
    ]
    return max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))


def beyond_chance(cells: dict[tuple[int, int], int], tested: int, share: float) -> list[tuple[int, int]]:
    """The cells (bad, n) whose features are no chance; ``cells`` has the number of features in each of interest."""
    tails = sorted((_tail(bad, n, share), (bad, n)) for bad, n in cells)
    total, last = 0, 0
    for i, (tail, cell) in enumerate(tails, 1):
        total += cells[cell]
        if tail <= math.log(CHANCE * total / tested):
            last = i
    return [cell for _, cell in tails[:last]]


def evidence(known: DataFrame) -> dict[int, int]:
    """Features nearly all of whose documents are toxic, with the number of those; EVIDENCE of them at most.

    Each feature is judged by its own documents alone, so those of a rare language or kind count like others.
    Copies of a text count once, with the worst label.
    """
    known = known.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for piece in bg.slices(batch.column(0)):
                found, rows = read(piece)
                text = np.repeat(found.text, COLUMNS)
                order = np.lexsort((rows.ravel(), text))
                f, t = rows.ravel()[order], text[order]
                new = np.ones(len(f), dtype=bool)
                new[1:] = (f[1:] != f[:-1]) | (t[1:] != t[:-1])
                f, bad = f[new], toxic[piece.first : piece.last][t[new]]
                names, of = np.unique(f, return_inverse=True)
                bad_n = np.bincount(of, bad, minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int64)), pa.array(bad_n), pa.array(np.bincount(of, minlength=len(names)))],
                    names=["feature", "bad", "n"],
                )

    counts = kept(
        known.select("text", "toxic").mapInArrow(count, "feature bigint, bad bigint, n bigint")
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        .filter((F.col("feature") != 0) & (F.col("n") >= SUPPORT))
    )
    pure = counts.filter((F.col("bad") >= SUPPORT) & (F.col("bad") >= PRECISION * F.col("n")))
    cells = {(r.bad, r.n): r["count"] for r in pure.groupBy("bad", "n").count().collect()}
    good_cells = beyond_chance(cells, counts.count(), bad / (bad + good)) if cells else []
    if not good_cells:
        return {}
    chosen = known.sparkSession.createDataFrame(good_cells, "bad bigint, n bigint")
    rows = pure.join(F.broadcast(chosen), ["bad", "n"]).orderBy(F.desc("bad"), "feature").limit(EVIDENCE).collect()
    return {r.feature: r.bad for r in rows}


def _label_words(rows: np.ndarray, text: np.ndarray, toxic: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1 for words with fair evidence, within toxic texts."""
    names, support = known
    if not len(names) or not len(rows):
        return np.zeros(len(rows), dtype=np.int64)
    at = np.minimum(np.searchsorted(names, rows), len(names) - 1)
    of_word = np.where(names[at] == rows, support[at], 0).max(axis=1) * toxic[text]
    best = np.zeros(len(toxic), dtype=np.int64)
    np.maximum.at(best, text, of_word)
    return ((of_word > 0) & (of_word >= SHARE * best[text])).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """The field of the labelled documents outside the held-out fold, or None if one of the labels is missing."""
    prepare(docs.sparkSession)
    judged = (
        labels.filter(F.col("toxic").isNotNull() & in_third("doc_id", 3, 1)).groupBy(F.col("doc_id").alias("labelled"))
        .agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic"))
    )
    # The draw is made among the labels, so that few keys instead of all texts are moved; the limit bounds them.
    chosen = F.broadcast(_drawn(judged, COUNTED, "evidence").limit(4 * COUNTED))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = kept(texts.join(chosen, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic"))
    found = evidence(known)
    if not found:
        return None
    names = np.array(sorted(found), dtype=np.int64).view(np.uint64)
    names.sort()
    support = np.array([found[int(n)] for n in names.view(np.int64)], dtype=np.int64)

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for piece in bg.slices(batch.column(0)):
                words, rows = read(piece)
                y = _label_words(rows, words.text, toxic[piece.first : piece.last].astype(np.int64), (names, support))
                out = []
                for i, (a, b) in enumerate(zip(words.of, words.of[1:])):
                    near = np.zeros(b - a, dtype=bool)
                    marked = np.flatnonzero(y[a:b])
                    if len(marked) > MARKED:
                        draw = bg.mix(words.hash[a + marked] ^ marked.astype(np.uint64))
                        marked = marked[np.argsort(draw, kind="stable")[:MARKED]]
                    for t in marked:
                        near[max(0, t - AROUND) : t + AROUND + 1] = True
                    if not toxic[piece.first + i] and b > a:
                        begin = int(words.hash[a] % np.uint64(max(1, b - a - STRETCH)))
                        near[begin : begin + STRETCH] = True
                    use = np.flatnonzero(near) + a
                    if len(use):
                        cut = np.concatenate([[1], np.diff(use) > 1]).astype(np.int8)
                        out.append((rows[use].tobytes(), y[use].astype(np.int8).tobytes(), cut.tobytes()))
                columns = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.binary()) for c in columns], names=["rows", "y", "first"])

    got = _drawn(known, SAMPLE, "field").select("text", "toxic").mapInArrow(excerpts, "rows binary, y binary, first binary").limit(4 * SAMPLE).collect()
    if not got:
        return None
    rows = np.concatenate([np.frombuffer(r.rows, dtype=np.uint64) for r in got]).reshape(-1, COLUMNS)
    y = np.concatenate([np.frombuffer(r.y, dtype=np.int8) for r in got]).astype(np.int64)
    first = np.concatenate([np.frombuffer(r["first"], dtype=np.int8) for r in got]) > 0
    del got
    return fit_field(rows, y, first) if y.any() else None


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def tag(piece: bg.Slice, field: Field | None) -> tuple[np.ndarray, pa.Array]:
    """Score and toxic spans (character offsets) of each text."""
    texts = len(piece.bounds) - 1
    score, spans = np.zeros(texts), [[] for _ in range(texts)]
    if field is None:
        return score, pa.array(spans, type=_SPANS)
    words, rows = read(piece)
    first = np.zeros(len(rows), dtype=bool)
    first[words.of[:-1][words.count > 0]] = True
    p, _ = forward_backward(field.emissions(rows), first, np.append(first[1:], True), field.transitions, field.start)
    text = words.text
    clean = np.where(p >= FLOOR, np.log1p(-np.minimum(p, 1 - 1e-12)), 0)
    score = -np.expm1(np.bincount(text, clean, minlength=texts)) if len(p) else score
    bad = p > 0.5
    if bad.any():
        chars = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
        begins = np.flatnonzero(bad & ~np.concatenate([[False], bad[:-1] & ~first[1:]]))
        ends = np.flatnonzero(bad & ~np.concatenate([bad[1:] & ~first[1:], [False]]))
        for a, b in zip(begins, ends):
            offset = chars[piece.bounds[text[a]]]
            spans[text[a]].append({"start": int(chars[words.start[a]] - offset), "stop": int(chars[words.stop[b]] - offset)})
    return score, pa.array(spans, type=_SPANS)


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents with ``toxic_score`` and ``toxic_spans``; columns of these names are replaced. Null and empty texts score 0."""
    prepare(docs.sparkSession)
    docs = docs.drop("toxic_score", "toxic_spans")
    sent = docs.sparkSession.sparkContext.broadcast(field)
    names, at = list(docs.columns), docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bg.slices(batch.column(at).cast(pa.large_string())):
                found, spans = tag(piece, sent.value)
                same = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(found, type=pa.float64()), spans],
                    names=[*names, "toxic_score", "toxic_spans"],
                )

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    found = [T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_spans", T.ArrayType(span))]
    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, *found]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and the spans found.

    Null and empty texts score 0; so does every document if the labels leave nothing to learn from.
    Of several labels of a document the worst counts. Repeated rows are scored alike.
    """
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        (~in_third("doc_id", 3, 1)).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("toxic_spans").alias("spans"),
    )
