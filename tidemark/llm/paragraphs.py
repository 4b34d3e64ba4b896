"""Repeated passages: paragraphs by MinHash bands, and passages that stand in other surroundings.

A paragraph is a line. Paragraphs of ``SIZE`` words or more whose shingles collide in a band are joined and their
Jaccard similarity is verified exactly; of each component, copies included, the first paragraph (smallest doc_id, then
place) stays and the others go. The number of bands follows from the recall asked for. Equal paragraphs are one node: they
are counted, and bands, sets and links are made for nodes only.

A passage may also stand inside different paragraphs. So in what the first step leaves, a word goes if it lies in
``MIN_WORDS`` words that stood before, in any surroundings and however they are wrapped. Such windows are found by the
smallest hash of the ``GRAM``-word grams in them, which both places share.

No step needs all paragraphs side by side: hashes are counted, and a bitmap (16 MB at most) of
those that occur more than once tells the tasks that read the documents again which places to emit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import quoted
from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import bitmap, discard, kept, prepare, release, stored
from tidemark.llm.neardup import joined, shingle_sets, verified

SIZE, PER_CENT = 5, 80
ROWS, RECALL = 3, 0.999
MIN_WORDS = 25
GRAM = 13
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bands_for(recall: float = RECALL, rows: int = ROWS, per_cent: int = PER_CENT) -> int:
    """The fewest bands with which a pair of the threshold's similarity collides with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (per_cent / 100) ** rows))


def lines_of(piece: bg.Slice) -> tuple[bg.Slice, np.ndarray]:
    """The lines as texts of a slice, and the text that each belongs to. A line has its line end, but for the last."""
    breaks = np.flatnonzero(piece.data == 10)
    bounds = np.append(np.sort(np.concatenate([piece.bounds[:-1], breaks + 1]), kind="stable"), len(piece.data))
    in_text = np.diff(np.searchsorted(breaks, piece.bounds))
    return bg.Slice(piece.first, piece.last, piece.data, bounds), np.repeat(np.arange(len(in_text)), in_text + 1)


def numbered(of: np.ndarray) -> np.ndarray:
    """The number of each entry within its text, from 0."""
    begin = np.searchsorted(of, of, side="left")
    return np.arange(len(of)) - begin


def long_lines(piece: bg.Slice) -> tuple[bg.Slice, np.ndarray, np.ndarray, np.ndarray]:
    """Lines, the text of each, the hash of its words, and the numbers of lines with ``SIZE`` words or more."""
    lines, of = lines_of(piece)
    found = bg.words(lines)
    return lines, of, bg.sequence_hash(found), np.flatnonzero(found.count >= SIZE)


def chosen(lines: bg.Slice, at: np.ndarray) -> bg.Slice:
    """Some of the texts of a slice, as a slice."""
    sizes = np.diff(lines.bounds)[at]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(lines.bounds[:-1][at] - bounds[:-1], sizes) + np.arange(bounds[-1])
    return bg.Slice(0, len(at), lines.data[places], bounds)


def band_keys(values: np.ndarray, bounds: np.ndarray, bands: int) -> np.ndarray:
    """(set, band) hashes of ``ROWS`` minima each. Sets are not empty."""
    out = np.zeros((len(bounds) - 1, bands), dtype=np.uint64)
    seeds = np.arange(1, bands * ROWS + 1, dtype=np.uint64) * _STEP
    for band in range(bands if len(out) else 0):
        for row in range(ROWS):
            seed = seeds[band * ROWS + row]
            out[:, band] = bg.mix(out[:, band] ^ np.minimum.reduceat(bg.mix(values ^ seed), bounds[:-1]) ^ seed)
    return out


def _scan(
    docs: DataFrame, emit: Callable[[bg.Slice, pa.RecordBatch], list[pa.Array]], names: str, rows: Broadcast | None = None
) -> DataFrame:
    """``emit`` over slices of (doc_id, row, text); with a bitmap of rows, only over those that may be in it."""
    plain = [n.split()[0] for n in names.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows is not None:
                batch = batch.filter(pa.array(rows.value.has(batch.column(1).to_numpy())))
            for piece in bg.slices(batch.column(2)):
                keys = batch.select([0, 1]).slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(emit(piece, keys), names=plain)

    return docs.select("doc_id", "row", "text").mapInArrow(scan, names)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values).view(np.int64))


def _marked_lines(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, row, line, node, keys) of every paragraph; the keys of its bands stand at the node's first place in a slice."""
    bands = bands_for()

    def mark(piece, keys):
        lines, of, nodes, at = long_lines(piece)
        _, first = np.unique(nodes[at], return_index=True)
        first.sort()
        found = band_keys(*shingle_sets(chosen(lines, at[first]), SIZE), bands)
        count = np.zeros(len(at), dtype=np.int64)
        count[first] = bands
        values = bg.lists(found.ravel().view(np.int64), count, pa.int64())
        return [*keys.take(pa.array(of[at])).columns, pa.array(numbered(of)[at], type=pa.int32()), _signed(nodes[at]), values]

    return _scan(docs, mark, f"doc_id {kind}, row bigint, line int, node bigint, keys array<bigint>")


def _near_lines(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, row, line) of the paragraphs that go because a similar one or the same comes first."""
    spark = docs.sparkSession
    lines = stored(_marked_lines(docs, kind))
    place = F.struct("doc_id", "row", "line")
    nodes = stored(lines.groupBy("node").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max("keys").alias("keys")))
    counted = nodes.select("node", F.explode("keys").alias("key")).groupBy("key").agg(
        F.min("node").alias("least"), F.max("node").alias("most"))
    shared = kept(counted.filter("least < most").select("key", "least"))
    hits: Broadcast = spark.sparkContext.broadcast(bitmap(shared, "key"))

    def colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).flatten().to_numpy()
            good = hits.value.has(keys)
            of = np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(keys[good]), pa.array(of[good])], names=["key", "node"])

    members = nodes.select("node", "keys").mapInArrow(colliding, "key bigint, node bigint")
    buckets = kept(members.join(shared, "key"))
    hits.unpersist()

    def sets_for(some: DataFrame) -> DataFrame:
        """The sets of nodes, read from the documents that hold their first places."""
        some = kept(nodes.select("node", F.col("first.row").alias("row")).join(some, "node", "left_semi"))
        rows = spark.sparkContext.broadcast(bitmap(some, "row"))
        wanted = spark.sparkContext.broadcast(bitmap(some, "node"))

        def sets(piece, _):
            lines, _, nodes, at = long_lines(piece)
            names, first = np.unique(nodes[at], return_index=True)
            good = wanted.value.has(names)
            values, bounds = shingle_sets(chosen(lines, at[first[good]]), SIZE)
            return [_signed(names[good]), pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], type=pa.binary())]

        read = _scan(docs, sets, "node bigint, shingles binary", rows).join(some.select("node"), "node", "left_semi")
        return read.dropDuplicates(["node"]).select("node", F.lit(None).cast("binary").alias("signature"), "shingles")

    def links_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return kept(verified(pairs, kept(sets_for(ends)), PER_CENT))

    labels = joined(buckets, links_of, sets_for, PER_CENT)
    named = nodes.select("node", "n", "first").join(labels, "node", "left").filter("label IS NOT NULL OR n > 1")
    named = kept(named.select("node", "first", F.coalesce("label", "node").alias("label")))
    stays = named.groupBy("label").agg(F.min("first").alias("stays"))
    going = named.select("node", "label").join(stays, "label").select("node", "stays")
    found = lines.select("doc_id", "row", "line", "node").join(going, "node")
    gone = kept(found.filter(~place.eqNullSafe(F.col("stays"))).select("doc_id", "row", "line"))
    for table in (lines, nodes):
        discard(table)
    release(spark)
    return gone


def _segments(piece: bg.Slice, gone: list[list[int] | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The texts' segments between the lines that go, one more than there are of these; the words before; and those that go."""
    lines, of = lines_of(piece)
    first = np.searchsorted(of, np.arange(len(gone)))
    count = np.array([len(g or ()) for g in gone], dtype=np.int64)
    at = np.array([n for g in gone for n in sorted(g or ())], dtype=np.int64) + np.repeat(first, count)
    words = bg.words(lines).count
    out = np.zeros(len(of), dtype=bool)
    out[at] = True
    start = np.sort(np.concatenate([piece.bounds[:-1], lines.bounds[1:][at]]), kind="stable")
    stop = np.sort(np.concatenate([piece.bounds[1:], lines.bounds[:-1][at]]), kind="stable")
    data = piece.data[~np.repeat(out, np.diff(lines.bounds))]
    bounds = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    values = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).cast(pa.string())
    offsets = np.concatenate([[0], np.cumsum(count + 1)]).astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(offsets), values)
    per_text = lambda x: np.bincount(of, x, minlength=len(gone)).astype(np.int64)
    return found, per_text(words), per_text(words * out)


def _without_lines(docs: DataFrame, others: list[str], gone: DataFrame) -> DataFrame:
    """(doc, doc_id, row, segments, n_words, n_gone): the documents cut at the lines that go. A null text has null segments."""
    lists = gone.groupBy(F.col("doc_id").alias("id"), F.col("row").alias("of")).agg(F.collect_set("line").alias("gone"))
    joint = docs.join(lists, F.col("row").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    joint = joint.select("doc", "doc_id", "row", "text", "gone")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4).to_pylist()
            for piece in bg.slices(batch.column(3)):
                part = batch.slice(piece.first, piece.last - piece.first)
                found, n_words, n_gone = _segments(piece, lists[piece.first : piece.last])
                found = pa.array(found.to_pylist(), mask=part.column(3).is_null().to_numpy(zero_copy_only=False), type=pa.list_(pa.string())) if part.column(3).null_count else found
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], found, pa.array(n_words), pa.array(n_gone)],
                    names=["doc", "doc_id", "row", "segments", "n_words", "n_gone"])

    schema = T.StructType([
        *joint.schema.fields[:3],
        T.StructField("segments", T.ArrayType(T.StringType())),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_gone", T.LongType()),
    ])
    return joint.mapInArrow(split, schema)


def _whole_documents(segments: pa.Array) -> Iterator[tuple[int, int, bg.Slice, np.ndarray]]:
    """Slices of whole documents: the first and last of them, their segments as texts, and each segment's document."""
    sizes = np.asarray(segments.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
    values = segments.flatten().cast(pa.large_string())
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    _, raw_bounds, raw = values.buffers()
    bounds = np.frombuffer(raw_bounds, dtype=np.int64, count=len(values) + 1, offset=values.offset * 8)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    last_segment = np.concatenate([[0], np.cumsum(sizes)])
    ends = bounds[last_segment]
    first = 0
    while first < len(sizes):
        last = int(np.searchsorted(ends, ends[first] + bg.SLICE_BYTES, side="right")) - 1
        last = min(len(sizes), max(first + 1, last))
        a, b = last_segment[first], last_segment[last]
        piece = bg.Slice(0, int(b - a), data[ends[first] : ends[last]], bounds[a : b + 1] - bounds[a])
        yield first, last, piece, np.repeat(np.arange(last - first), sizes[first:last])
        first = last


#: A place is one number: the segment in the document, and the word in the segment.
_WORD_BITS = 32


def stretches_of(piece: bg.Slice) -> tuple[bg.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of every stretch its first window, its windows, its gram, and the hash of all its words.

    A stretch is the windows of MIN_WORDS words that follow each other and have their least gram in the same place.
    """
    found = bg.words(piece)
    starts, grams = bg.whole(found, MIN_WORDS), bg.grams(found, GRAM)
    at, best = starts, grams[starts]
    for j in range(1, MIN_WORDS - GRAM + 1):
        here = grams[starts + j]
        at, best = np.where(here <= best, starts + j, at), np.minimum(here, best)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (np.diff(at) != 0) | (np.diff(starts) > 1)
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(starts)))
    first = starts[begin]
    running = bg.sums(found.hash, bg._WORD_PRIME)
    return found, first, n, best[begin], bg.span_hash(running, first, first + n - 1 + MIN_WORDS, bg._WORD_PRIME)


def _per_document(docs: DataFrame, emit, names: str) -> DataFrame:
    """``emit`` over slices of whole documents (doc_id, row, segments)."""
    plain = [n.split()[0] for n in names.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, piece, doc in _whole_documents(batch.column(2)):
                keys = batch.select([0, 1]).slice(first, last - first)
                yield pa.RecordBatch.from_arrays(emit(piece, doc, keys), names=plain)

    return docs.select("doc_id", "row", "segments").mapInArrow(scan, names)


def _repeated_windows(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, row, at, n) of runs of n windows of segments that occurred before.

    A window that overlaps its own first occurrence is not among them, so that stays. Equal windows have their least gram in
    the same place, so they lie in stretches round the same gram. Equal stretches are one class, and all but
    its first go whole. Only where several classes share a gram are the windows of their firsts compared.
    """
    spark = docs.sparkSession

    def all_keys(piece, *_):
        names, times = np.unique(stretches_of(piece)[3], return_counts=True)
        return [_signed(names), pa.array(times, type=pa.int64())]

    counted = _per_document(docs, all_keys, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    hits: Broadcast = spark.sparkContext.broadcast(bitmap(kept(counted.filter("n > 1").select("gram")), "gram"))
    release(spark)

    def place_of(found: bg.Words, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        segment = found.text[first]
        return doc[segment], numbered(doc)[segment] << _WORD_BITS | first - found.of[segment]

    def stretches(piece, doc, keys):
        found, first, n, gram, whole = stretches_of(piece)
        good = hits.value.has(gram)
        of, at = place_of(found, doc, first[good])
        return [*keys.take(pa.array(of)).columns, pa.array(at), pa.array(n[good].astype(np.int32)), _signed(gram[good]), _signed(whole[good])]

    where = stored(_per_document(docs, stretches, f"doc_id {kind}, row bigint, at bigint, n int, gram bigint, whole bigint"))
    same_class = ["gram", "whole", "n"]
    classes = stored(where.groupBy(*same_class).agg(F.min(F.struct("doc_id", "row", "at")).alias("first"), F.count("*").alias("copies")))
    several = kept(classes.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram"))
    copies = where.join(classes.filter("copies > 1").drop("copies"), same_class)
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    # In another segment the difference is larger than any window.
    near = same & (F.col("at") < F.col("first.at") + MIN_WORDS)
    far = copies.filter(~near).select("doc_id", "row", "at", "n")
    close = copies.filter(near & (F.col("at") > F.col("first.at"))).select("gram", "doc_id", "row", "at")
    firsts = classes.select("gram", "first.*")
    wanted = kept(_with_place(firsts.unionByName(close).join(several, "gram", "left_semi"), kind))
    sent: Broadcast = spark.sparkContext.broadcast(bitmap(wanted, "place"))

    def windows(piece, doc, keys):
        found, first, n, _, _ = stretches_of(piece)
        of, at = place_of(found, doc, first)
        good = sent.value.has(_mixed(keys.column(1).to_numpy()[of], at))
        first, n, of, at = first[good], n[good], of[good], at[good]
        running = bg.sums(found.hash, bg._WORD_PRIME)
        begin = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hashes = bg.span_hash(running, begin, begin + MIN_WORDS, bg._WORD_PRIME)
        return [*keys.take(pa.array(of)).columns, pa.array(at), bg.lists(hashes.view(np.int64), n, pa.int64())]

    read = _per_document(docs, windows, f"doc_id {kind}, row bigint, at bigint, hashes array<bigint>")
    keys = ["row", "at"]
    exact = read.join(wanted.select(F.col("doc_id").alias("id"), *keys), keys).filter(F.col("doc_id").eqNullSafe(F.col("id")))
    each = stored(exact.select("doc_id", "row", "at", F.posexplode("hashes").alias("i", "key")).select(
        "doc_id", "row", (F.col("at") + F.col("i")).alias("at"), "key").distinct())
    first = each.groupBy("key").agg(F.min(F.struct("doc_id", "row", "at")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    later = each.join(first, "key").filter(~near).select("doc_id", "row", "at", F.lit(1).alias("n"))
    found = stored(far.unionByName(later).groupBy("doc_id", "row").agg(F.collect_set(F.struct("at", "n")).alias("windows")))
    for table in (where, classes, each):
        discard(table)
    release(spark)
    return found


def _with_place(places: DataFrame, kind: str) -> DataFrame:
    """(doc_id, row, at) with the hash by which tasks know them again."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _signed(_mixed(batch.column(1).to_numpy(), batch.column(2).to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=["doc_id", "row", "at", "place"])

    return places.select("doc_id", "row", "at").mapInArrow(hashed, f"doc_id {kind}, row bigint, at bigint, place bigint")


def _mixed(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of places."""
    return bg.mix(bg.mix(row.view(np.uint64)) ^ at.view(np.uint64))


def _cut(piece: bg.Slice, doc: np.ndarray, windows: list[list[dict] | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What stays of documents whose segments are the texts of a slice; the words removed, and the runs of removed words.

    ``doc`` has the document of each segment. Between two segments of a document lies a line that went.
    """
    n_docs = len(windows)
    found = bg.words(piece)
    lines, _ = lines_of(piece)
    line = np.searchsorted(lines.bounds[1:], found.start, side="right")
    count = np.array([len(x or ()) for x in windows], dtype=np.int64)
    flat = np.array([x["at"] for mine in windows for x in mine or ()], dtype=np.int64)
    n = np.array([x["n"] for mine in windows for x in mine or ()], dtype=np.int64)
    segment = np.searchsorted(doc, np.repeat(np.arange(n_docs), count)) + (flat >> _WORD_BITS)
    begin = found.of[segment] + (flat & ((1 << _WORD_BITS) - 1))
    cover = np.zeros(len(line) + 1, dtype=np.int64)
    np.add.at(cover, begin, 1)
    np.subtract.at(cover, begin + n - 1 + MIN_WORDS, 1)
    out = np.cumsum(cover[:-1]) > 0
    drop = np.zeros(len(piece.data) + 1, dtype=np.int64)
    before = np.concatenate([[-1], found.text[:-1]]) if len(out) else found.text
    opens = out & (~np.concatenate([[False], out[:-1]]) | (found.text != before))
    after = np.concatenate([found.text[1:], [-1]]) if len(out) else found.text
    closes = out & (~np.concatenate([out[1:], [False]]) | (found.text != after))
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    # A cut within a line goes on to the next word; else the line's end stays.
    follows = np.minimum(b + 1, max(0, len(line) - 1))
    inside = (b + 1 < len(line)) & (line[follows] == line[b]) if len(b) else np.zeros(0, dtype=bool)
    np.add.at(drop, found.start[a], 1)
    np.subtract.at(drop, np.where(inside, found.start[follows], found.stop[b]), 1)
    stays = np.cumsum(drop[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(stays)])[piece.bounds]
    last = np.searchsorted(doc, np.arange(n_docs + 1))
    bounds = ends[last].astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_string(), n_docs, [None, pa.py_buffer(bounds), pa.py_buffer(piece.data[stays])]).cast(pa.string())
    # The line that went before a segment counts as one removed word, to count runs across it.
    gap = np.flatnonzero(np.concatenate([[False], doc[1:] == doc[:-1]])) if len(doc) else np.zeros(0, dtype=np.int64)
    marks = np.insert(out, found.of[gap], True)
    owner = np.insert(doc[found.text] if len(doc) else found.text, found.of[gap], doc[gap])
    new = marks.copy()
    new[1:] &= ~(marks[:-1] & (owner[1:] == owner[:-1]))
    removed = np.bincount(doc[found.text[out]], minlength=n_docs) if len(doc) else np.zeros(n_docs, dtype=np.int64)
    return texts, removed, np.bincount(owner[new], minlength=n_docs)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with the text that stays, and ``n_words``, ``n_removed`` (words) and ``n_spans``.

    Columns of these names are replaced, all others kept. A null text stays null and an empty one empty. Rows equal
    in doc_id and text count as one document and are cut alike. A null doc_id comes before all others. An empty table
    gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed", "n_spans")
    columns = docs.columns
    others = [c for c in columns if c != "text"]
    text = F.col("text").cast("string")
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in others]).alias("doc"), "doc_id",
        F.xxhash64(F.col("doc_id").cast("string"), text).alias("row"), text.alias("text"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    gone = _near_lines(keyed.select("doc_id", "row", "text"), kind)
    left = stored(_without_lines(keyed, others, gone))
    release(docs.sparkSession)
    again = _repeated_windows(left, kind)
    again = again.select(F.col("doc_id").alias("id"), F.col("row").alias("of"), "windows")
    joint = left.join(again, F.col("row").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    joint = joint.select("doc", "segments", "n_words", "n_gone", "windows")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = batch.column(4).to_pylist()
            for first, last, piece, doc in _whole_documents(batch.column(1)):
                part = batch.slice(first, last - first)
                texts, removed, spans = _cut(piece, doc, windows[first:last])
                null = part.column(1).is_null()
                if part.column(1).null_count:
                    texts = pa.array(texts.to_pylist(), mask=null.to_numpy(zero_copy_only=False), type=pa.string())
                n_removed = part.column(3).to_numpy() + removed
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), texts, part.column(2), pa.array(n_removed), pa.array(spans.astype(np.int64))],
                    names=["doc", "text", "n_words", "n_removed", "n_spans"])

    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed", "n_spans")]
    schema = T.StructType([joint.schema["doc"], T.StructField("text", T.StringType()), *counts])
    result = joint.mapInArrow(apply, schema)
    kept_columns = [F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in columns]
    return result.select(*kept_columns, "n_words", "n_removed", "n_spans")
