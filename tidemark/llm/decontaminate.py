"""Benchmark decontamination by winnowing.

Of every 6 consecutive 8-word grams the one with the smallest hash is kept, the rightmost of
equals. Any 13 words that a document shares with an item hold 6 such grams, and both sides keep
the same one: no shared window is missed. Kept grams of documents and items are joined, and each
hit is extended to the windows that hold it by comparing the windows' own hashes.

An item of fewer than 13 words is one window; documents are searched for it by the rolling hash
of that many words.

The tasks that read documents have a bitmap of the items' grams (16 MB at most, however many
items there are), so only grams that may hit are shuffled. The join that follows is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import Bitmap, bitmap, kept, prepare

WINDOW, GRAM = 13, 8
WIDTH = WINDOW - GRAM + 1
CONFIRM = 0x5851F42D4C957F2D
_HIT = pa.struct([("length", pa.int32()), ("at", pa.int32()), ("gram", pa.int64()), ("windows", pa.list_(pa.int64()))])
_HIT_DDL = "array<struct<length:int,at:int,gram:bigint,windows:array<bigint>>>"


def _marks(piece: bg.Slice, lengths: list[int], hits: Bitmap | None) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    """Words and marks of each text, and all marks. A mark is a kept gram with the hashes of the windows around it.

    ``lengths`` are those of short windows to look for everywhere; without ``hits`` the texts are
    items, and a short window is an item's whole text.
    """
    found = bg.words(piece, bg.NOT_ITEM_WORD)
    n, text = found.count, found.text
    grams, confirm = bg.grams(found, GRAM), bg.grams(found, WINDOW, CONFIRM)
    at = bg.rightmost_minima(grams, bg.whole(found, WINDOW), WIDTH)
    at = at[hits.has(grams[at])] if hits else at
    begin = at[:, None] - np.arange(WIDTH)
    fits = (begin >= found.of[text[at]][:, None]) & (begin + WINDOW <= found.of[text[at] + 1][:, None])
    windows = np.where(fits, confirm[np.where(fits, begin, 0)] if len(confirm) else 0, 0).astype(np.int64)
    parts = [(text[at], np.full(len(at), WINDOW), at - found.of[text[at]], grams[at], windows, fits)]
    for k in range(1, WINDOW) if hits is None else lengths:
        gram, sure = bg.grams(found, k), bg.grams(found, k, CONFIRM)
        at = bg.whole(found, k)
        at = at[n[text[at]] == k] if hits is None else at[hits.has(gram[at] ^ np.uint64(k))]
        alone = np.zeros((len(at), WIDTH), dtype=bool)
        alone[:, 0] = True
        windows = np.where(alone, sure[at].astype(np.int64)[:, None] if len(at) else 0, 0)
        parts.append((text[at], np.full(len(at), k), at - found.of[text[at]], gram[at] ^ np.uint64(k), windows, alone))
    of, length, place, gram, windows, fits = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(of, kind="stable")
    flat = pa.array(windows[order].ravel(), type=pa.int64(), mask=~fits[order].ravel())
    bounds = pa.array(np.arange(len(of) + 1, dtype=np.int32) * WIDTH)
    marks = pa.StructArray.from_arrays(
        [
            pa.array(length[order], type=pa.int32()),
            pa.array(place[order], type=pa.int32()),
            pa.array(gram[order].astype(np.int64)),
            pa.ListArray.from_arrays(bounds, flat),
        ],
        fields=list(_HIT),
    )
    return n, np.bincount(of, minlength=len(n)), marks


def _marked(frame: DataFrame, id_column: str, lengths: list[int], hits) -> DataFrame:
    """(id, n_words, marks) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = hits.value if hits else None
        for batch in batches:
            for piece in bg.slices(batch.column(1)):
                n, count, marks = _marks(piece, lengths, wanted)
                bounds = np.zeros(len(n) + 1, dtype=np.int32)
                np.cumsum(count, out=bounds[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first),
                        pa.array(n, type=pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), marks),
                    ],
                    names=["id", "n_words", "marks"],
                )

    source = frame.select(F.col(id_column).alias("id"), F.col("text").cast("string"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(scan, f"id {kind}, n_words bigint, marks {_HIT_DDL}")


def hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents as (row, doc_id, n_words), and (row, item_id, at, length) of each window of an item in them."""
    spark = docs.sparkSession
    listed = kept(
        _marked(items, "item_id", [], None)
        .select(F.col("id").cast("string").alias("item_id"), F.explode("marks").alias("m"))
        .select("item_id", "m.length", "m.gram", F.col("m.windows").alias("item_windows"))
        .distinct()
    )
    lengths = [r.length for r in listed.filter(F.col("length") < WINDOW).select("length").distinct().collect()]
    wanted = spark.sparkContext.broadcast(bitmap(listed.select("gram"), "gram"))
    scanned = kept(
        _marked(docs, "doc_id", lengths, wanted).select(
            F.monotonically_increasing_id().alias("row"), F.col("id").alias("doc_id"), "n_words", "marks"
        )
    )
    pairs = (
        scanned.select("row", F.explode("marks").alias("m"))
        .select("row", "m.*")
        .join(listed, ["length", "gram"])
        .select("row", "item_id", "length", "at", F.posexplode(F.zip_with("windows", "item_windows", lambda x, y: x == y)))
        .filter("col")
        .select("row", "item_id", "length", (F.col("at") - F.col("pos")).alias("at"))
    )
    return scanned.drop("marks"), pairs


def covered(windows: F.Column) -> F.Column:
    """How many words lie in a list of (at, length) windows."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def step(state, w):
        end = w["at"] + w["length"]
        more = F.greatest(F.lit(0), end - F.greatest(w["at"], state["end"]))
        return F.struct(F.greatest(end, state["end"]).alias("end"), (state["n"] + more).alias("n"))

    return F.aggregate(F.array_sort(windows), start, step, lambda s: s["n"])


def decontaminate(docs: DataFrame, items: DataFrame, per_cent: int = 5) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated if words of windows make up ``per_cent`` of its words or more. Null
    and empty texts have no words and are clean; null and empty items have no windows; without
    items every document is clean. Rows that share a doc_id are judged one by one. Columns other
    than doc_id, item_id and text are ignored.
    """
    prepare(docs.sparkSession)
    scanned, pairs = hits(docs, items)
    found = pairs.groupBy("row").agg(
        covered(F.collect_set(F.struct("at", "length"))).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("bigint"))
    items_found = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return scanned.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items_found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        ((hit > 0) & (100 * hit >= per_cent * F.col("n_words"))).alias("contaminated"),
    )
