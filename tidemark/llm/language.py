"""Language identification in two steps: first the family, then the language within it.

Families come from the data: the languages' mean profiles are merged by average cosine similarity
until about the square root of their number is left. One linear support vector machine per family
tells it from the rest; within a family one machine per pair of languages votes, so that close
languages are told apart by features that separate just those two.

Profiles are the counts of hashed words and byte trigrams, root-scaled and of unit length. The machines
are fitted on ``SAMPLE`` documents at most, the same number for each language, drawn by the hash of
the key. Every document is then classified by its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import in_third, prepare

#: Documents that the machines are fitted on, all languages together, and per language.
SAMPLE, PER_LANGUAGE = 4000, 600
#: Hashed features of a profile: the first half trigrams, the second half words.
FEATURES = 4096
UNDETERMINED = "und"
_LETTERS = (bg.LOWER >= 97) & (bg.LOWER <= 122)
_NOT_WORD = bg.byte_class("00-40,5B-60,7B-7F")


def profiles(piece: bg.Slice) -> np.ndarray:
    """One row per text: root-scaled counts of byte trigrams within words and of words, of unit length."""
    half, texts = FEATURES // 2, len(piece.bounds) - 1
    found = bg.words(piece, _NOT_WORD)
    data = np.where(_NOT_WORD[piece.data], 32, bg.LOWER[piece.data]).astype(np.uint32)
    shift = np.uint32(32 - int(half).bit_length() + 1)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761) >> shift
    of = np.repeat(np.arange(texts), np.diff(piece.bounds))[: len(code)]
    inner = piece.bounds[1:][of] - np.arange(len(code)) >= 3
    keys = [of[inner] * FEATURES + code[inner], found.text * FEATURES + half + (found.hash % np.uint64(half)).astype(np.int64)]
    counts = np.bincount(np.concatenate(keys).astype(np.int64), minlength=texts * FEATURES)
    x = np.sqrt(counts.reshape(texts, FEATURES).astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(piece: bg.Slice) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(_LETTERS[piece.data])])
    out = total[piece.bounds[1:]] > total[piece.bounds[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in piece.text(i).decode("utf-8", "replace"))
    return out


def fit_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, steps: int = 150) -> np.ndarray:
    """Weights, the last one the constant, of a squared-hinge machine (accelerated gradient steps, classes balanced)."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    weight = (cost / (2 * share * len(x))).astype(np.float32)
    rate = 1 / (1e-2 + 4 * cost)
    w = before = np.zeros(x.shape[1], dtype=np.float32)
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - before)
        slack = np.maximum(0, 1 - y * (x @ ahead))
        before, w = w, ahead - rate * (1e-2 * ahead - 2 * x.T @ (weight * y * slack))
    return w


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages in families, by merging the two with the most similar profiles on average."""
    groups = [[lang] for lang in sorted(means)]
    like = {(a, b): float(means[a] @ means[b]) for a in means for b in means}
    while len(groups) > max(1, round(len(means) ** 0.5)):
        mean = {(i, j): np.mean([like[a, b] for a in groups[i] for b in groups[j]])
                for i, j in combinations(range(len(groups)), 2)}
        i, j = max(mean, key=mean.get)
        groups[i] += groups.pop(j)
    return [sorted(g) for g in groups]


@dataclass
class Model:
    families: list[list[str]]
    family: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of each profile, and the product of the family's and the language's share of belief."""
        x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
        which, belief = _soft(x @ self.family.T)
        lang, score = np.empty(len(x), dtype=object), belief.copy()
        for f, langs in enumerate(self.families):
            rows = np.flatnonzero(which == f)
            votes = np.zeros((len(rows), len(langs)), dtype=np.float32)
            for (i, a), (j, b) in combinations(enumerate(langs), 2):
                margin = x[rows] @ self.pairs[a, b]
                votes[:, i] += (margin > 0) + 0.1 * np.tanh(margin)
                votes[:, j] += (margin <= 0) - 0.1 * np.tanh(margin)
            best, share = _soft(votes)
            lang[rows] = np.array(langs, dtype=object)[best]
            score[rows] *= share
        return lang, np.clip(score, 0, 1)


def _soft(margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest column of each row, its softmax share."""
    power = np.exp(3 * (margins - margins.max(axis=1, keepdims=True)))
    return margins.argmax(axis=1), (power.max(axis=1) / power.sum(axis=1)).astype(np.float64)


def fit(docs: DataFrame) -> Model | None:
    """The model of the documents outside the held-out fold, or None if none of them has a language."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & in_third("doc_id", 4, 2))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE).collect()}
    if not sizes:
        return None
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(sizes)))
    # A uniform draw by key hash that leaves about ``each`` documents of a language; the limit only bounds chance.
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, each / n))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bg.slices(batch.column(1)):
                good = np.flatnonzero(has_letter(piece))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first).take(pa.array(good)),
                        pa.array([row.astype(np.float16).tobytes() for row in profiles(piece)[good]], type=pa.binary()),
                    ],
                    names=["lang", "profile"],
                )

    chosen = known.filter(draw < share[F.col("lang")]).select("lang", F.col("text").cast("string").alias("text"))
    rows = chosen.mapInArrow(scan, "lang string, profile binary").limit(2 * SAMPLE).collect()
    if not rows:
        return None
    x = np.stack([np.frombuffer(r.profile, dtype=np.float16) for r in rows]).astype(np.float32)
    y = np.array([r.lang for r in rows], dtype=object)
    families = families_of({lang: x[y == lang].mean(axis=0) for lang in set(y)})
    family = np.stack([fit_svm(x, np.isin(y, langs)) if len(families) > 1 else np.zeros(FEATURES + 1) for langs in families])
    pairs = {}
    for langs in families:
        for a, b in combinations(langs, 2):
            both = (y == a) | (y == b)
            pairs[a, b] = fit_svm(x[both], y[both] == a)
    return Model(families, family.astype(np.float32), pairs)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score.

    The language is ``und`` with score 0 where the text is null or has no letter, and everywhere if
    there is nothing to learn from. Repeated rows are classified alike; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    model = fit(docs)
    sent = spark.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bg.slices(batch.column(1)):
                good = has_letter(piece) & (sent.value is not None)
                lang = np.full(len(good), UNDETERMINED, dtype=object)
                score = np.zeros(len(good))
                if good.any():
                    lang[good], score[good] = sent.value.predict(profiles(piece)[good])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, piece.last - piece.first), pa.array(lang, type=pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    out = source.mapInArrow(scan, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", (~in_third("doc_id", 4, 2)).alias("held_out"), "lang_pred", "score")
