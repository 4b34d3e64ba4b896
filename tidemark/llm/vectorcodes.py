"""Product codes of vectors, trained and assigned exactly in integers.

A vector's components become integers and the vector is cut into equal parts. Every part position has a
codebook of a few entries, refined by rounds of nearest-entry assignment and integer means. A part
goes to its nearest entry by squared distance, ties to the lower index, in exact arithmetic.

Most of the distances are never computed. The parts of a position are sorted by their place on a Hilbert
curve over the position's range and stored in flat blocks with the box of least and greatest components and
the component sums. The curve keeps near points together, so boxes are small. In each round the distance of a
box to an entry, at least and at most, leaves a shortlist of entries for the block: an entry farther away at
least than another one is at most cannot be the nearest of any row. If one entry is left, the block's sums go
to it whole; otherwise a small integer kernel compares the block's rows with the shortlist.

Blocks hold ``BLOCK`` rows, whatever the table's size. The sort's key ends in the row number, so equal
vectors are spread over tasks like any others. The driver gets the codebooks' sums only: at most
``entries`` times the vector's length.

Defined results: rows whose vector is null, empty, or has a null or non-finite component are dropped. The
length is that of the kept row with the least key; rows of another length are dropped, and if ``parts``
does not divide it, all are. Rows without a key count as the largest key. Repeated rows are rows of
their own; the first entries are of different keys, and a key with several vectors gives the least of them. With
fewer keys than entries the codebooks are as much smaller. Integers stop at 2**62 and errors at 2**63 - 1.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import prepare, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Rows of a block.
BLOCK = 128
LARGEST = 1 << 62
#: Squared distances up to this size are computed in 64 bits, larger ones in Python's own integers.
MOST = (1 << 63) - 1
_KEY_BITS = 62
_CURVE_BITS = 10

Codebooks = list[list[list[int]]]


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of lattice points on the Hilbert curve, by transposing axes bit by bit (Skilling 2004)."""
    x = points.astype(np.int64).copy()
    n_dims = x.shape[1]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for i in range(n_dims):
            set_here = (x[:, i] & level) != 0
            swap = np.where(set_here, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_here, low, swap)
            x[:, i] ^= swap
        level >>= 1
    for i in range(1, n_dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    level = top
    while level > 1:
        flip ^= np.where((x[:, -1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip[:, None]
    index = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n_dims):
            index = index << 1 | (x[:, i] >> bit & 1)
    return index


def curve_keys(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hilbert keys of integer points between two corners; of very long parts the first 62 components count."""
    n_dims = min(points.shape[1], _KEY_BITS)
    bits = min(_CURVE_BITS, _KEY_BITS // n_dims)
    low, high = low[:n_dims].astype(float), high[:n_dims].astype(float)
    cells = (points[:, :n_dims].astype(float) - low) / np.maximum(high - low, 1.0) * (1 << bits)
    return hilbert_index(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)


def _rows_as_binary(values: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    offsets = np.arange(len(values) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _matrix(column: pa.Array, kind: type, n_columns: int) -> np.ndarray:
    """The matrix whose rows are binary values of one size."""
    if not len(column):
        return np.zeros((0, n_columns), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), n_columns)


def _cut(batches: Iterator[pa.RecordBatch], low: np.ndarray, high: np.ndarray, kind: type) -> Iterator[pa.RecordBatch]:
    """(pos, key, row, part) of every part of every vector."""
    n_parts, width = low.shape
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = batch.column("whole").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_parts, width)
        rows = batch.column("row").to_numpy()
        for pos in range(n_parts):
            part = vectors[:, pos, :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), pos, np.int32)),
                    pa.array(curve_keys(part, low[pos], high[pos])),
                    pa.array(rows),
                    _rows_as_binary(part.astype(kind)),
                ],
                ["pos", "key", "row", "part"],
            )


def _blocks(batches: Iterator[pa.RecordBatch], width: int, kind: type) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of one position as flat blocks with box and sums."""
    for batch in batches:
        pos = batch.column("pos").to_numpy()
        rows = batch.column("row").to_numpy()
        parts = _matrix(batch.column("part"), kind, width)
        edges = [0, *(np.flatnonzero(np.diff(pos)) + 1).tolist(), len(pos)]
        spans = [(a, min(a + BLOCK, end)) for start, end in zip(edges, edges[1:]) for a in range(start, end, BLOCK)]
        if not spans:
            continue
        bodies = [parts[a:b] for a, b in spans]
        exact = np.int64 if kind is np.int32 else object
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(pos[a]) for a, _ in spans], pa.int32()),
                pa.array([b - a for a, b in spans], pa.int32()),
                pa.array([rows[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([body.tobytes() for body in bodies], pa.binary()),
                _rows_as_binary(np.array([body.min(axis=0) for body in bodies], np.int64)),
                _rows_as_binary(np.array([body.max(axis=0) for body in bodies], np.int64)),
                pa.array([[Decimal(int(s)) for s in body.sum(axis=0, dtype=exact)] for body in bodies],
                         pa.list_(pa.decimal128(38, 0))),
            ],
            ["pos", "n", "rows", "body", "low", "high", "sums"],
        )


_BLOCK_SCHEMA = "pos int, n int, rows binary, body binary, low binary, high binary, sums array<decimal(38,0)>"


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be the nearest of a row, per box: those not farther at least than another is at most."""
    low, high, entries = low[:, None, :], high[:, None, :], entries[None, :, :]
    outside = np.maximum(np.maximum(low - entries, entries - high), 0)
    across = np.maximum(np.abs(low - entries), np.abs(high - entries))
    least, most = (outside * outside).sum(axis=2), (across * across).sum(axis=2)
    return least <= most.min(axis=1)[:, None]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row, the lower index of equals."""
    apart = rows[:, None, :] - entries[None, :, :]
    distances = (apart * apart).sum(axis=2)
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(rows)), best]


def _shortlisted(batch: pa.RecordBatch, books: list[np.ndarray], width: int):
    """(block, position, indexes of the entries that its rows may go to)."""
    exact = books[0].dtype
    pos = batch.column("pos").to_numpy()
    low, high = (_matrix(batch.column(side), np.int64, width).astype(exact) for side in ("low", "high"))
    for place in np.unique(pos):
        mine = np.flatnonzero(pos == place)
        for block, may in zip(mine, shortlists(low[mine], high[mine], books[place])):
            yield int(block), int(place), np.flatnonzero(may)


def _body(batch: pa.RecordBatch, block: int, width: int, kind: type, exact: np.dtype) -> np.ndarray:
    return np.frombuffer(batch.column("body")[block].as_buffer(), kind).reshape(-1, width).astype(exact)


def _sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], kind: type) -> Iterator[pa.RecordBatch]:
    """Sums and counts of what is assigned to each entry, once per task: (pos, entry, dim, total), dim -1 for the count."""
    n_entries, width = books[0].shape
    totals = np.zeros((len(books), n_entries, width + 1), object)
    for batch in batches:
        counts = batch.column("n").to_numpy()
        for block, place, may in _shortlisted(batch, books, width):
            if len(may) == 1:
                whole = batch.column("sums")[block].as_py()
                totals[place, may[0], :-1] += np.array([int(s) for s in whole], object)
                totals[place, may[0], -1] += int(counts[block])
                continue
            rows = _body(batch, block, width, kind, books[0].dtype)
            best, _ = nearest(rows, books[place][may])
            for at in np.unique(best):
                chosen = rows[best == at]
                totals[place, may[at], :-1] += chosen.sum(axis=0).astype(object)
                totals[place, may[at], -1] += len(chosen)
    used = [(p, e) for p in range(len(books)) for e in range(n_entries) if totals[p, e, -1]]
    cells = [(p, e, d if d < width else -1, Decimal(int(totals[p, e, d]))) for p, e in used for d in range(width + 1)]
    columns = list(zip(*cells)) or [(), (), (), ()]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["pos", "entry", "dim", "total"])


def _codes(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], kind: type) -> Iterator[pa.RecordBatch]:
    """(row, code, error) of every part; a part's entry stands in its own byte of ``code``."""
    width = books[0].shape[1]
    for batch in batches:
        rows, codes, errors = [], [], []
        for block, place, may in _shortlisted(batch, books, width):
            best, distance = nearest(_body(batch, block, width, kind, books[0].dtype), books[place][may])
            rows.append(np.frombuffer(batch.column("rows")[block].as_buffer(), np.int64))
            codes.append(may[best].astype(np.int64) << (8 * (len(books) - 1 - place)))
            errors.append(np.minimum(distance, MOST).astype(np.int64))
        if rows:
            columns = [pa.array(np.concatenate(c)) for c in (rows, codes, errors)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "code", "error"])


def _valid(vector: str) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def _whole_numbers(vector: str) -> Column:
    floored = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return F.transform(floored, lambda x: F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)))


def _arrays(books: Codebooks, exact: type) -> list[np.ndarray]:
    return [np.array(book, exact) for book in books]


def _next(blocks: DataFrame, books: Codebooks, kind: type, exact: type) -> Codebooks:
    """The codebooks after one round; entries without a part stay."""
    arrays = _arrays(books, exact)
    sums = (
        blocks.select("pos", "n", "body", "low", "high", "sums")
        .mapInArrow(lambda batches: _sums(batches, arrays, kind), "pos int, entry int, dim int, total decimal(38,0)")
        .groupBy("pos", "entry", "dim")
        .agg(F.sum("total").alias("total"))
        .collect()  # entries * (length + parts) rows at most
    )
    totals = {(r.pos, r.entry, r.dim): int(r.total) for r in sums}
    return [
        [
            [totals[p, e, d] // totals[p, e, -1] for d in range(len(entry))] if (p, e, -1) in totals else entry
            for e, entry in enumerate(book)
        ]
        for p, book in enumerate(books)
    ]


def compress(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a valid vector.

    ``parts`` is 1 to 8, ``entries`` 1 to 127. ``code`` has two hex digits a part; ``label_error`` is the error summed over
    the rows of equal label, null labels together.
    """
    spark = prepare(rows.sparkSession)
    base = stored(
        rows.filter(_valid(vector)).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("vec_id"),
            F.col(label).alias("label"),
            _whole_numbers(vector).alias("whole"),
        )
    )
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), F.size("whole"), "whole").limit(1).collect()
    length = len(first[0].whole) if first else 0
    if not length or length % parts:
        return spark.createDataFrame([], T.StructType([
            T.StructField("vec_id", rows.schema[key].dataType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()),
            T.StructField("codebooks_sha256", T.StringType()),
        ]))
    width = length // parts
    base = base.filter(F.size("whole") == length)

    ids = base.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    wanted = F.broadcast(ids.withColumnRenamed("vec_id", "wanted"))  # ``entries`` rows
    starts = base.join(wanted, F.col("vec_id").eqNullSafe(F.col("wanted"))).groupBy("vec_id").agg(F.min("whole").alias("whole"))
    starts = [r.whole for r in starts.orderBy(F.col("vec_id").asc_nulls_last()).collect()]
    books: Codebooks = [[list(v[p * width : (p + 1) * width]) for v in starts] for p in range(parts)]

    bounds = base.select([f(F.col("whole")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(length)]).first()
    low, high = (np.array(side, np.int64).reshape(parts, width) for side in (bounds[:length], bounds[length:]))
    narrow = 4 * width * max(abs(int(low.min())), abs(int(high.max()))) ** 2 <= MOST
    kind, exact = (np.int32, np.int64) if narrow else (np.int64, object)

    placed = base.select("row", "whole").mapInArrow(
        lambda batches: _cut(batches, low, high, kind), "pos int, key long, row long, part binary"
    )
    # The row number in the key deals equal vectors out over several tasks.
    order = ["pos", "key", "row"]
    blocks = stored(
        placed.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(lambda batches: _blocks(batches, width, kind), _BLOCK_SCHEMA)
    )
    for _ in range(rounds):
        books = _next(blocks, books, kind, exact)

    arrays = _arrays(books, exact)
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    found = blocks.mapInArrow(lambda batches: _codes(batches, arrays, kind), "row long, code long, error long")
    limit = F.lit(Decimal(MOST))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), limit).cast("long")
    per_row = found.groupBy("row").agg(F.sum("code").alias("code"), total.alias("error"))
    coded = stored(base.select("row", "vec_id", "label").join(per_row, "row"))
    # As many rows as labels; Spark sends them to all tasks only if it finds them small.
    by_label = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.lower(F.lpad(F.hex("code"), 2 * parts, "0")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(flat.encode()).hexdigest()).alias("codebooks_sha256"),
    )
