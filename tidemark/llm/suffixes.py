"""Exact removal of repeated byte strings by difference-cover suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier. Three steps keep what is sorted small
and the result exact:

1. Every window of LENGTH bytes has one anchor: its 32-byte gram with the smallest hash, the rightmost of equals. The
   windows that share an anchor, and have it in the same half, follow each other; together they are a stretch of LENGTH bytes and a few
   more, and all hold the same core of 66 bytes. Equal windows have equal cores, so windows whose core
   occurs once anywhere are unique. The cores are counted.
2. Equal stretches are one class, and all but its first occurrence go entirely. So copies are never sorted.
3. What remains are different stretches round the same core, at the edges of repeated passages. They are dealt out
   by core, and each task sorts their suffixes by a difference cover modulo 3: it sorts the triples at the positions of the
   cover, names them, recurses on the names, sorts the other suffixes by their first byte and the rank that follows,
   and merges. Neighbours in that order with equal first LENGTH bytes are equal windows, and all but the earliest go.

A core with more than ``MOST`` different stretches is not sorted by one task: the windows in its stretches are grouped by
a 128-bit hash instead, which Spark combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import bitmap, discard, kept, prepare, release, stored

LENGTH, GRAM = 100, 32
WIDTH = LENGTH - GRAM + 1
HALF = (WIDTH + 1) // 2
CORE = LENGTH - HALF + 1
#: A place in a document is one number: 24 bits of the text's hash, the stretch's start, and its length beyond LENGTH.
TAG_BITS, START_BITS, MORE_BITS = 24, 31, 7
#: Most different stretches round a core that one task sorts together, and bytes that it sorts at once.
MOST, SORTED_BYTES = 2000, 1 << 19
SLICE = 1 << 19
_SECOND = 0xC2B2AE3D27D4EB4F


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (numbers from 1 on, fewer than 2**21 of them) in order, by a difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    t = np.concatenate([s, np.zeros(3, dtype=np.int64)]).astype(np.int64)
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    cover = np.concatenate([one, two])
    triples = t[cover] << 42 | t[cover + 1] << 21 | t[cover + 2]
    order = np.argsort(triples, kind="stable")
    new = np.concatenate([[1], np.diff(triples[order]) != 0]).cumsum()
    names = np.empty(len(cover), dtype=np.int64)
    names[order] = new
    if new[-1] < len(cover):
        ranks = np.empty(len(cover), dtype=np.int64)
        ranks[suffix_array(names)] = np.arange(1, len(cover) + 1)
    else:
        ranks = names
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[cover] = ranks
    first = cover[np.argsort(ranks)]
    others = np.arange(0, n, 3)
    others = others[np.argsort(t[others] << 22 | rank[others + 1], kind="stable")]
    by_one, by_two = first[first % 3 == 1], first[first % 3 == 2]
    before = np.searchsorted(t[by_one] << 22 | rank[by_one + 1], t[others] << 22 | rank[others + 1])
    before += np.searchsorted(t[by_two] << 42 | t[by_two + 1] << 21 | rank[by_two + 2], t[others] << 42 | t[others + 1] << 21 | rank[others + 2])
    out = np.full(len(others) + len(first), -1, dtype=np.int64)
    out[before + np.arange(len(others))] = others
    out[out < 0] = first
    return out[out < n]


def anchors(piece: bg.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last window start and hash of the core of each stretch."""
    data, bounds = piece.data, piece.bounds
    n = len(data) - LENGTH + 1
    empty = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return empty, empty, empty, empty.view(np.uint64)
    running = bg.sums(bg.BYTE_CODES[data], bg._PRIME)
    at = np.arange(len(data) - GRAM + 1)
    low = np.uint64(0xFFFFFFFF)
    least = (bg.span_hash(running, at, at + GRAM, bg._PRIME) & ~low) | (low - at.astype(np.uint64))
    span = 1
    while 2 * span <= WIDTH:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[WIDTH - span : WIDTH - span + n])
    place = (low - (least & low)).astype(np.int64)
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size)), size)[:n]
    start = np.flatnonzero(np.arange(n) + LENGTH <= bounds[1:][text])
    place, text = place[start], text[start]
    half = (place - start) // HALF
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (half[1:] != half[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start))[: len(at)] - 1
    core = place[at] - HALF * half[at]
    return text[at], start[at], start[last], bg.span_hash(running, core, core + CORE, bg._PRIME) ^ half[at].astype(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _spots(piece: bg.Slice, row: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    start = first - piece.bounds[:-1][text]
    tag = row[text] & ((1 << TAG_BITS) - 1)
    return tag << (START_BITS + MORE_BITS) | start << MORE_BITS | last - first


def _place_hash(spot: np.ndarray, core: np.ndarray) -> np.ndarray:
    return bg.mix(bg.mix(spot.view(np.uint64)) ^ core.view(np.uint64))


def _scan(docs: DataFrame, emit, names: str) -> DataFrame:
    plain = [n.split()[0] for n in names.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(1).to_numpy()
            for piece in bg.slices(batch.column(2), SLICE):
                ids = batch.column(0).slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(emit(piece, ids, row[piece.first : piece.last]), names=plain)

    return docs.select("doc_id", "row", "text").mapInArrow(scan, names)


def _stretches(docs: DataFrame, kind: str) -> DataFrame:
    """(core, whole, doc_id, spot) of the stretches whose core may occur more than once; ``whole`` is the hash of a stretch."""

    def cores(piece, *_):
        names, times = np.unique(anchors(piece)[3], return_counts=True)
        return [_signed(names), pa.array(times, type=pa.int64())]

    counted = _scan(docs, cores, "core bigint, n bigint").groupBy("core").agg(F.sum("n").alias("n"))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(kept(counted.filter("n > 1").select("core")), "core"))

    def places(piece, ids, row):
        text, first, last, core = anchors(piece)
        good = sent.value.has(core)
        text, first, last, core = text[good], first[good], last[good], core[good]
        whole = bg.span_hash(bg.sums(bg.BYTE_CODES[piece.data], _SECOND), first, last + LENGTH, _SECOND)
        return [_signed(core), _signed(whole), ids.take(pa.array(text)), pa.array(_spots(piece, row, text, first, last))]

    return _scan(docs, places, f"core bigint, whole bigint, doc_id {kind}, spot bigint")


def _with_place(wanted: DataFrame, kind: str) -> DataFrame:
    """The rows (core, doc_id, spot) with the hash by which tasks know them again."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = _signed(_place_hash(batch.column(2).to_numpy(), batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, hashed], names=[*batch.schema.names, "place"])

    return wanted.select("core", "doc_id", "spot").mapInArrow(place, f"core bigint, doc_id {kind}, spot bigint, place bigint")


def _strings(docs: DataFrame, wanted: DataFrame, kind: str) -> DataFrame:
    """(core, doc_id, spot, bytes) of the stretches in ``wanted`` (core, doc_id, spot, place)."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "place"))

    def read(piece, ids, row):
        text, first, last, core = anchors(piece)
        spot = _spots(piece, row, text, first, last)
        place = _place_hash(spot, core)
        good = np.flatnonzero(sent.value.has(place))
        data = [piece.data[first[i] : last[i] + LENGTH].tobytes() for i in good]
        return [
            _signed(core[good]), ids.take(pa.array(text[good])), pa.array(spot[good]), _signed(place[good]), pa.array(data, type=pa.binary())
        ]

    found = _scan(docs, read, f"core bigint, doc_id {kind}, spot bigint, place bigint, bytes binary")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("place", "core", "spot", "doc_id")]
    return found.alias("f").join(wanted.alias("w"), same, "left_semi").dropDuplicates(["core", "doc_id", "spot"])


def repeated_windows(strings: list[bytes], groups: np.ndarray) -> list[np.ndarray]:
    """Offsets of the windows of each string that an earlier string of its group holds too. The strings are in order."""
    sizes = np.array([len(x) + 1 for x in strings])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    numbers = data.astype(np.int64) + 2
    numbers[begin[1:] - 1] = 1
    order = suffix_array(numbers)
    of = np.repeat(np.arange(len(strings)), sizes)
    order = order[order + LENGTH < begin[1:][of[order]]]
    same = np.zeros(len(order), dtype=bool)
    alive = np.flatnonzero(groups[of[order[1:]]] == groups[of[order[:-1]]]) + 1 if len(order) else np.zeros(0, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), shape=(len(data),), strides=(1,))
    for step in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        alive = alive[eight[order[alive] + step] == eight[order[alive - 1] + step]]
    same[alive] = True
    run = np.cumsum(~same) - 1
    earliest = np.full(len(order), len(data))
    np.minimum.at(earliest, run, order)
    again = order[order > earliest[run]]
    split = np.searchsorted(np.sort(again), begin)
    again = np.sort(again)
    return [again[a:b] - at for a, b, at in zip(split, split[1:], begin)]


def _windows(kind: str) -> str:
    return f"doc_id {kind}, spot bigint, start bigint, stop bigint"


def _sorted_spans(strings: DataFrame, kind: str) -> DataFrame:
    """Spans (doc_id, spot, start, stop) that suffix sorting finds, core by core. Offsets count from the stretch's start."""
    columns = ["core", "doc_id", "spot", "bytes"]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= SORTED_BYTES:
                table = pa.Table.from_batches(waiting).combine_chunks()
                cores = table["core"].to_numpy()
                cut = int(np.searchsorted(cores, cores[-1]))  # the last core's stretches may go on
                yield from spans(table.slice(0, cut))
                waiting = table.slice(cut).to_batches()
                size = sum(b.nbytes for b in waiting)
        if waiting:
            yield from spans(pa.Table.from_batches(waiting))

    def spans(table: pa.Table) -> Iterator[pa.RecordBatch]:
        # A key that is a struct is sorted by its fields.
        flat = table.select(columns[:3]).flatten()
        order = pc.sort_indices(flat, sort_keys=[(c, "ascending") for c in flat.column_names], null_placement="at_start")
        table = table.take(order).combine_chunks()
        strings, (_, groups) = table["bytes"].to_pylist(), np.unique(table["core"].to_numpy(), return_inverse=True)
        bounds, done = np.concatenate([[0], np.cumsum([len(x) for x in strings])]), 0
        while done < len(strings):
            last = int(np.searchsorted(bounds, bounds[done] + SORTED_BYTES))
            last = len(strings) if last >= len(strings) else int(np.searchsorted(groups, groups[last], side="left"))
            last = last if last > done else int(np.searchsorted(groups, groups[done], side="right"))
            row, start, stop = [], [], []
            for i, windows in enumerate(repeated_windows(strings[done:last], groups[done:last]), done):
                if len(windows):
                    breaks = np.flatnonzero(np.diff(windows) > LENGTH)
                    row += [i] * (len(breaks) + 1)
                    start += windows[np.concatenate([[0], breaks + 1])].tolist()
                    stop += (windows[np.append(breaks, len(windows) - 1)] + LENGTH).tolist()
            keys = table.select(columns[1:3]).take(pa.array(row, type=pa.int64())).combine_chunks()
            for batch in keys.to_batches():
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(start, type=pa.int64()), pa.array(stop, type=pa.int64())], names=["doc_id", "spot", "start", "stop"])
            done = last

    dealt = strings.select(columns).repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(sort, _windows(kind))


def _grouped_spans(strings: DataFrame, kind: str) -> DataFrame:
    """The same spans for cores with very many stretches, from the windows' hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(2).to_pylist()
            sizes = np.array([len(x) for x in data], dtype=np.int64)
            bounds, n = np.concatenate([[0], np.cumsum(sizes)]), sizes - LENGTH + 1
            of = np.repeat(np.arange(len(n)), n)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            at, codes = bounds[of] + inner, bg.BYTE_CODES[np.frombuffer(b"".join(data), dtype=np.uint8)]
            hashes = [_signed(bg.span_hash(bg.sums(codes, base), at, at + LENGTH, base)) for base in (bg._PRIME, _SECOND)]
            yield pa.RecordBatch.from_arrays(
                [*batch.select([0, 1]).take(pa.array(of)).columns, pa.array(inner), *hashes], names=["doc_id", "spot", "start", "one", "two"])

    every = strings.select("doc_id", "spot", "bytes").mapInArrow(windows, f"doc_id {kind}, spot bigint, start bigint, one bigint, two bigint")
    # The stretches of a document follow each other by spot, and the windows of a stretch by start.
    later = _later(every, ["one", "two"], ["doc_id", "spot", "start"])
    return later.select("doc_id", "spot", "start", (F.col("start") + LENGTH).alias("stop"))


def _first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group, as struct ``first``, and the group's size. Nulls come first."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("n"))


def _later(rows: DataFrame, keys: list[str], order: list[str], first: DataFrame | None = None) -> DataFrame:
    """The rows of each group but the first."""
    first = (_first(rows, keys, order) if first is None else first).filter("n > 1").drop("n")
    return rows.join(first, keys).filter(~F.struct(*order).eqNullSafe(F.col("first"))).drop("first")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, spans) of the documents (doc_id, row, text) in which bytes go; spans are (start, stop) and may overlap."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys, order = ["core", "whole"], ["doc_id", "spot"]
    found = stored(_stretches(docs, kind))
    release(docs.sparkSession)
    classes = stored(_first(found, keys, order))
    more = F.col("spot").bitwiseAND((1 << MORE_BITS) - 1)
    copies = _later(found, keys, order, classes).select("doc_id", "spot", F.lit(0).cast("bigint").alias("start"), (more + LENGTH).alias("stop"))
    several = classes.groupBy("core").agg(F.count("*").alias("classes")).filter("classes > 1")
    wanted = stored(_with_place(classes.join(several, "core").select("core", "first.*"), kind))
    hot = several.filter(F.col("classes") > MOST).select("core", F.lit(True).alias("hot"))
    strings = stored(_strings(docs, wanted, kind).join(hot, "core", "left"))
    spans = copies.union(_sorted_spans(strings.filter("hot IS NULL"), kind)).union(_grouped_spans(strings.filter("hot"), kind))
    begin = F.shiftright("spot", MORE_BITS).bitwiseAND((1 << START_BITS) - 1)
    result = stored(spans.groupBy("doc_id", F.shiftright("spot", START_BITS + MORE_BITS).alias("tag")).agg(
        F.collect_set(F.struct((begin + F.col("start")).alias("start"), (begin + F.col("stop")).alias("stop"))).alias("spans")))
    for table in (found, classes, wanted, strings):
        discard(table)
    release(docs.sparkSession)
    return result


def removed(size: int, spans: list[dict] | None) -> np.ndarray:
    """Which bytes of a text lie in a span."""
    step = np.zeros(size + 1, dtype=np.int32)
    if spans:
        np.add.at(step, [s["start"] for s in spans], 1)
        np.add.at(step, [s["stop"] for s in spans], -1)
    return np.cumsum(step[:-1]) > 0


def _digest(docs: DataFrame, kind: str) -> DataFrame:
    """The result columns of (doc_id, text, spans)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = [], batch.column(2).to_pylist()
            for piece in bg.slices(batch.column(1)):
                for i in range(piece.last - piece.first):
                    data = piece.data[piece.bounds[i] : piece.bounds[i + 1]]
                    if spans[piece.first + i]:
                        gone = removed(len(data), spans[piece.first + i])
                        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) > 0).sum())
                        rows.append((len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
                    else:
                        rows.append((len(data), 0, 0, hashlib.sha256(data.tobytes()).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, type=k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return docs.select("doc_id", "text", "spans").mapInArrow(
        digest, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _tags_clash(keyed: DataFrame) -> bool:
    """Whether two different texts of one doc_id have the same tag.

    Texts are read only if some doc_id is shared, and then those of shared ones alone.
    """
    times = keyed.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    shared = kept(times.select(F.col("doc_id").alias("shared")))
    if shared.isEmpty():
        return False
    mine = keyed.join(shared, F.col("doc_id").eqNullSafe(F.col("shared")), "left_semi")
    tag = F.col("row").bitwiseAND((1 << TAG_BITS) - 1).alias("tag")
    by_tag = mine.groupBy("doc_id", tag).agg(F.min("row").alias("low"), F.max("row").alias("high"))
    return not by_tag.filter("low < high").isEmpty()


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    A null text counts as empty. Rows equal in doc_id and text are one document and have the same result; rows with one
    doc_id and different texts are documents of their own, in the order of 24 bits of the texts' hashes, or of 64 bits if
    24 do not tell all texts of each doc_id apart. A null doc_id comes
    first. Other columns are not read. ``repeats`` gives the spans themselves.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), text).alias("row"), text.alias("text"))
    if _tags_clash(keyed):
        # The whole hash becomes a part of the key, which is a struct from here on.
        found = _deduplicated(keyed.withColumn("doc_id", F.struct("doc_id", "row")))
        return found.withColumn("doc_id", F.col("doc_id.doc_id"))
    return _deduplicated(keyed)


def _deduplicated(keyed: DataFrame) -> DataFrame:
    """The result for documents (doc_id, row, text) whose doc_id and tag tell them apart."""
    kind = keyed.schema["doc_id"].dataType.simpleString()
    spans = repeats(keyed)
    # Only texts that may have spans are moved to them; the bitmap lets others through by chance, and they find none.
    key = F.xxhash64(F.col("doc_id").cast("string"), "tag")
    keyed = keyed.withColumn("tag", F.col("row").bitwiseAND((1 << TAG_BITS) - 1)).withColumn("key", key)
    sent = keyed.sparkSession.sparkContext.broadcast(bitmap(spans.select(key.alias("key")), "key"))

    def part(cut: bool) -> DataFrame:
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.select([0, 1, 2]).filter(pa.array(sent.value.has(batch.column(3).to_numpy()) == cut))

        return keyed.select("doc_id", "tag", "text", "key").mapInArrow(choose, f"doc_id {kind}, tag bigint, text string")

    same = F.col("d.tag").eqNullSafe(F.col("s.tag")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    joint = part(True).alias("d").join(spans.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans")
    whole = part(False).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return _digest(joint, kind).union(_digest(whole, kind))
