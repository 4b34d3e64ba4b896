"""Quality rules whose cutoffs carry a guarantee.

Each rule compares one ratio of a document with a cutoff, and a document goes if any rule rejects it. In each stratum
the rules are tightened along one *path*: a sequence of (rule, cutoff) that begins with no cutoffs at all and goes on with
the step that rejects most bad documents for the good ones it costs. The labelled documents of the tuning half (crc32 of the
key, even) give the path, and it ends where a step costs more than it brings.

The holdout half says how far the path may be followed. A point of it may be used if the exact binomial upper bound
of the share of good documents that all rules together reject there stays within ``risk``. The points are tested
from the loosest on, and testing ends at the first that fails (fixed sequence), which needs no correction; across strata the error
probability is divided by their number (Bonferroni). So with probability ``1 - delta`` no stratum loses more than
``risk`` of its good documents to the rules, however many rules and cutoffs there are. Documents that fail the base rule are
no matter of these rules and are left out on both sides.

Strata are the languages with most labelled documents, all others together, and documents
without a language: ``MAX_STRATA`` at most, which bounds the histograms that the driver reads. With no good held-out document
rejected, a stratum of four needs 217 of them for a first cutoff.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import in_third, kept, prepare

MAX_STRATA = 32
BINS = 100
RISK, DELTA = 0.02, 0.05
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
SHOUT = np.isin(np.arange(256), np.frombuffer(b"!?", dtype=np.uint8))
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_shout", "n_upper")

#: Rule: ratio in hundredths, 0 to BINS; a document fails if it is the cutoff or more.
RULES = {
    "symbols": ("n_symbols", "word_chars", 2.0),
    "duplicate_lines": ("n_dup_lines", "n_lines", 1.0),
    "repeated_words": ("n_repeat_words", "n_words", 1.0),
    "shouting": ("n_shout", "word_chars", 2.0),
    "capitals": ("n_upper", "word_chars", 1.0),
    "same_words": ("n_same", "n_words", 1.0),
    "long_words": ("word_chars", "n_words", 1 / 40),
}


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _pairs(text: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, how often its value occurs in its text; and whether it is the first."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    order = np.lexsort((values, text))
    t, v = text[order], values[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])])
    group = np.cumsum(new) - 1
    times, first = np.empty(len(v), dtype=np.int64), np.empty(len(v), dtype=bool)
    times[order], first[order] = np.bincount(group)[group], new
    return times, first


def counts_of(piece: bg.Slice) -> list[np.ndarray]:
    """The COUNTS of each text of a slice."""
    data, bounds, texts = piece.data, piece.bounds, len(piece.bounds) - 1
    found = bg.words(piece, lower=False)
    text = found.text
    inside, starts_char = ~bg.SPACES[data], (data & 0xC0) != 0x80

    at = bg.whole(found, 8)
    times, _ = _pairs(text[at], bg.grams(found, 8)[at])
    again = at[times > 1]
    step = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(step, again, 1)
    np.add.at(step, again + 8, -1)
    repeated = np.bincount(text[np.cumsum(step[:-1]) > 0], minlength=texts)

    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    stop = np.sort(np.concatenate([bounds[1:], breaks]))
    of = np.repeat(np.arange(texts), 1 + _per_text(data == 10, bounds))
    worded = np.searchsorted(found.start, stop) > np.searchsorted(found.start, start)
    lines = bg.span_hash(bg.sums(bg.BYTE_CODES[data], bg._PRIME), start, stop, bg._PRIME)[worded]
    of = of[worded]
    times, first = _pairs(of, lines)
    _, new = _pairs(text, found.hash)
    return [
        found.count,
        _per_text(inside & starts_char, bounds),
        _per_text(SYMBOLS[data], bounds),
        np.bincount(of[~first], minlength=texts),
        repeated,
        np.bincount(of, minlength=texts),
        np.bincount(text[new], minlength=texts),
        _per_text(SHOUT[data], bounds),
        _per_text(UPPER[data], bounds),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the COUNTS of every document. A null text has none; a missing ``lang`` column is null."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bg.slices(batch.column(2)):
                n = piece.last - piece.first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, n), batch.column(1).slice(piece.first, n)]
                    + [pa.array(x, type=pa.int64()) for x in counts_of(piece)],
                    names=["doc_id", "lang", *COUNTS],
                )

    prepare(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select("doc_id", lang.alias("lang"), F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {kind}, lang string, " + ", ".join(f"{c} bigint" for c in COUNTS))


def ratios() -> list[Column]:
    """Each rule's ratio in hundredths, as an integer from 0 to BINS."""
    columns = []
    for name, (top, bottom, scale) in RULES.items():
        n = F.col("n_words") - F.col("n_distinct") if top == "n_same" else F.col(top)
        value = F.floor(n * F.lit(scale * BINS) / F.greatest(F.col(bottom), F.lit(1)))
        columns.append(F.least(value, F.lit(BINS)).cast("int").alias(name))
    return columns


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function (Lentz's evaluation)."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(tiny, 1 - (a + b) * x / (a + 1), key=abs)
    out = d
    for m in range(1, 5000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / max(tiny, 1 + num * d, key=abs)
            c = max(tiny, 1 + num / c, key=abs)
            out *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return out


def beta_cdf(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    log = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(log) * _beta_fraction(a, b, x) / a
    return 1 - math.exp(log) * _beta_fraction(b, a, 1 - x) / b


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact (Clopper-Pearson) upper bound of a share of which k of n were seen."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - beta_cdf(middle, k + 1, n - k) > error else (low, middle)
    return high


def path(bad: np.ndarray, good: np.ndarray) -> list[tuple[int, int]]:
    """The order in which cutoffs are tightened: (rule, cutoff) pairs, from tuning counts by (rule, bin).

    Each pair is the step, of any rule to any lower cutoff, that rejects the largest share of bad documents for the share of good
    ones, the first rule and loosest cutoff of equals. Steps that bring no more than ten times their cost are left out.
    """
    tails = [np.concatenate([x[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros((len(x), 1), dtype=np.int64)], axis=1) for x in (bad, good)]
    n_bad, n_good = max(1, int(bad[0].sum())), max(1, int(good[0].sum()))
    now, out = [BINS + 1] * len(bad), []
    while True:
        best, best_ratio = None, 10.0
        for rule, at in enumerate(now):
            lower = np.arange(at - 1, 0, -1)
            if not len(lower):
                continue
            gain = (tails[0][rule, lower] - tails[0][rule, at]) / n_bad
            cost = (tails[1][rule, lower] - tails[1][rule, at] + 0.5) / n_good
            ratio = gain / cost
            i = int(ratio.argmax())
            if ratio[i] > best_ratio:
                best, best_ratio = (rule, int(lower[i])), float(ratio[i])
        if best is None:
            return out
        out.append(best)
        now[best[0]] = best[1]


def steps_of_bins(steps: list[tuple[int, int]]) -> list[list[int]]:
    """By rule and bin: the number of the first step that rejects it, or the number of steps if none does."""
    out = [[len(steps)] * (BINS + 1) for _ in RULES]
    for number, (rule, cutoff) in reversed(list(enumerate(steps))):
        out[rule][cutoff:] = [number] * (BINS + 1 - cutoff)
    return out


def certified(rejected: np.ndarray, n: int, risk: float, error: float) -> int:
    """How many steps may be used: ``rejected`` counts the good held-out documents, of ``n``, that go first at each step."""
    for number, k in enumerate(np.cumsum(rejected)):
        if not n or upper_bound(int(k), n, error) > risk:
            return number
    return len(rejected)


def _strata_rows(frame: DataFrame, paths: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """The rows with ``step``: the first step of their stratum's path that rejects them, null if no stratum or step does."""
    known = [(name, *steps_of_bins(steps)) for name, steps in paths.items() if steps]
    fields = ", ".join(f"s{i} array<int>" for i in range(len(RULES)))
    # One row per stratum.
    tables = F.broadcast(frame.sparkSession.createDataFrame(known, f"in_stratum string, {fields}"))
    joined = frame.join(tables, F.col("stratum") == F.col("in_stratum"), "left")
    step = F.least(*[F.get(F.col(f"s{i}"), F.col(rule)) for i, rule in enumerate(RULES)])
    return joined.withColumn("step", step).drop("in_stratum", *[f"s{i}" for i in range(len(RULES))])


def fit(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> dict[str, list[tuple[int, int]]]:
    """{stratum: the part of its path that may be used}, with every language that is a stratum.

    The driver reads histograms of at most strata x rules x bins and strata x steps rows.
    """
    judged = (
        labels.filter(F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg((F.min("quality") > 0).alias("good"))
    )
    known = kept(
        measured.filter(~base_failed()).join(judged, measured.doc_id == judged.labelled)
        .select("lang", "good", in_third("doc_id", 2, 0).alias("held"), *ratios())
    )
    top = known.filter("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    langs = [r.lang for r in top.orderBy(F.desc("n"), "lang").limit(MAX_STRATA).collect()]
    known = known.withColumn("stratum", stratum(langs))
    bins = F.explode(F.map_from_arrays(F.array(*[F.lit(i) for i in range(len(RULES))]), F.array(*RULES))).alias("rule", "bin")
    tables: dict[str, np.ndarray] = {}
    for r in known.filter("NOT held").select("stratum", "good", bins).groupBy("stratum", "good", "rule", "bin").count().collect():
        found = tables.setdefault(r.stratum, np.zeros((2, len(RULES), BINS + 1), dtype=np.int64))
        found[int(r.good), r.rule, r.bin] += r["count"]
    paths = {name: path(found[0], found[1]) for name, found in tables.items()}
    held = _strata_rows(known.filter("held AND good"), paths).groupBy("stratum", "step").count().collect()
    error = delta / max(1, len({*tables, *[r.stratum for r in held]}))
    out = {f"={lang}": [] for lang in langs}
    for name, steps in paths.items():
        counts = {r.step: r["count"] for r in held if r.stratum == name}
        rejected = np.array([counts.get(i, 0) for i in range(len(steps))], dtype=np.int64)
        out[name] = steps[: certified(rejected, sum(counts.values()), risk, error)]
    return out


def base_failed() -> Column:
    """The base rule: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stratum(langs: list[str]) -> Column:
    """A document's stratum: its language if it is one of ``langs``, ``other`` or ``none``. Marked to keep them apart."""
    lang = F.col("lang")
    named = F.when(lang.isin(langs), F.concat(F.lit("="), lang)) if langs else F.when(F.lit(False), lang)
    return F.when(lang.isNull(), F.lit("none")).otherwise(F.coalesce(named, F.lit("other")))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept.

    A null or empty text has no words and fails the base rule (fewer than 20 words, or over 30 % of the
    words in repeated 8-word windows). Without labels, or with too few for a guarantee, no cutoff is
    used and ``kept`` is the opposite of ``base_failed``. Several labels of a document count as the worst.
    """
    measured = kept(measure(docs))
    found = fit(measured, labels, risk, delta)
    langs = [name[1:] for name in found if name.startswith("=")]
    ruled = measured.select("doc_id", "lang", *COUNTS[:5], base_failed().alias("base_failed"), *ratios())
    ruled = _strata_rows(ruled.withColumn("stratum", stratum(langs)), found)
    # A step past the last one stands for no rejection.
    last = F.lit(0)
    for name, steps in found.items():
        last = F.when(F.col("stratum") == name, F.lit(len(steps))).otherwise(last)
    fails = F.coalesce(F.col("step") < last, F.lit(False))
    return ruled.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & ~fails).alias("kept"))
