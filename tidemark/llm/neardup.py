"""Near duplicates by MinHash bands with sequential Bayesian verification.

Documents with the same set of shingles are one class, so copies never meet as pairs. Classes that
agree in a band of their signatures are candidates. A candidate pair's signatures are compared one batch after
the other; after each batch the pair is dropped if, given the matches so far, the posterior
probability that its similarity reaches the threshold is below ``MISS``. Survivors are verified
exactly on their whole sets. Classes are joined by components.

A band shared by many classes is not turned into all its pairs. Each class is first compared with the band's
smallest class only, and classes that these links join need no comparison any more. Where classes of a band are still apart,
bands of up to ``SMALL_BAND`` classes give their remaining pairs of different components. Larger bands are united
into clusters, whose members are compared block against block: signature batches with the same pruning,
then the sets. So each pair of a band is either compared or joined through others, and components are as if all had been compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import bitmap, components, kept, prepare, stored

#: Bands x rows hashes. A pair of similarity 0.8 shares no band with probability (1 - 0.8**4)**28 < 4e-7.
BANDS, ROWS = 28, 4
#: Signature values compared before each decision, and the accepted posterior probability of a miss.
BATCH, MISS = 16, 1e-7
#: Bands of up to so many classes give pairs; members of larger ones are compared in blocks of about BLOCK.
SMALL_BAND, BLOCK = 24, 1024
#: Elements of sets that two blocks are compared on at once.
ELEMENTS = 8192
_HASHES = BANDS * ROWS
_STEPS = bg.mix(np.arange(1, _HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(piece: bg.Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted within each, and the bounds of each text's.

    A text with fewer words than ``size``, but not none, has its whole sequence as its one shingle.
    """
    found = bg.words(piece)
    texts = len(piece.bounds) - 1
    at = bg.whole(found, size)
    few = np.flatnonzero((found.count > 0) & (found.count < size))
    values = np.concatenate([bg.grams(found, size)[at], bg.sequence_hash(found)[few]])
    of = np.concatenate([found.text[at], few])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.searchsorted(of[new], np.arange(texts + 1))


def digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """16 bytes that stand for a set; None for the empty one."""
    total = [np.concatenate([[np.uint64(0)], np.cumsum(bg.mix(values ^ np.uint64(s)))]) for s in (3, 5)]
    parts = np.stack([t[bounds[1:]] - t[bounds[:-1]] for t in total], axis=1)
    return [p.tobytes() if n else None for p, n in zip(parts, np.diff(bounds))]


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """_HASHES 32-bit minima per set that is not empty."""
    full = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(full), _HASHES), dtype=np.uint32)
    if len(full):
        for k in range(_HASHES):
            h = (values * _STEPS[k]) ^ (_STEPS[-1 - k] >> np.uint64(1))
            h = h ^ (h >> np.uint64(29))
            out[:, k] = np.minimum.reduceat((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32), full)
    return out


def described(docs: DataFrame, id_column: str, size: int) -> DataFrame:
    """(id, n_shingles, digest, signature) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bg.slices(batch.column(1)):
                values, bounds = shingle_sets(piece, size)
                n = np.diff(bounds)
                found = iter(signatures(values, bounds))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first),
                        pa.array(n, type=pa.int64()),
                        pa.array(digests(values, bounds), type=pa.binary()),
                        pa.array([next(found).tobytes() if x else None for x in n], type=pa.binary()),
                    ],
                    names=["id", "n_shingles", "digest", "signature"],
                )

    source = docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(scan, f"id {kind}, n_shingles bigint, digest binary, signature binary")


def sets_of(docs: DataFrame, id_column: str, size: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (node, id, digest), read again from the documents.

    Tasks skip rows by a bitmap of the wanted ids before they build sets; the join that follows is exact.
    """
    spark = docs.sparkSession
    hashed = F.xxhash64(F.col("id").cast("string"))
    sent = spark.sparkContext.broadcast(bitmap(wanted.select(hashed.alias("h")), "h"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(sent.value.has(batch.column(2).to_numpy())))
            for piece in bg.slices(batch.column(1)):
                values, bounds = shingle_sets(piece, size)
                data = [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests(values, bounds), type=pa.binary()), pa.array(data, type=pa.binary())],
                    names=["digest", "shingles"],
                )

    source = docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    source = source.select("id", "text", hashed.alias("h"))
    read = source.mapInArrow(scan, "digest binary, shingles binary").filter("digest IS NOT NULL")
    # One copy of each class, and then the join where it lies: the sets move once.
    return read.dropDuplicates(["digest"]).join(wanted.select("node", "digest"), "digest").select("node", "shingles")


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For each batch, the fewest matches with which a pair stays.

    With a uniform prior the similarity's posterior after m matches of n is Beta(m + 1, n - m + 1); its
    tail above the threshold is the probability of at most m successes in n + 1 draws.
    """
    out = []
    for n in range(BATCH, _HASHES + 1, BATCH):
        below, tail = 0, 0.0
        while below <= n:
            tail += math.comb(n + 1, below) * threshold**below * (1 - threshold) ** (n + 1 - below)
            if tail >= miss:
                break
            below += 1
        out.append(below)
    return out


def _surviving(pairs: DataFrame, signed: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) whose signatures pass every batch."""
    needed = least_matches(per_cent / 100)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, _HASHES) for c in (2, 3))
            alive, seen = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            for step, least in enumerate(needed):
                part = slice(step * BATCH, (step + 1) * BATCH)
                seen[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[seen[alive] >= least]
            yield batch.select([0, 1]).take(pa.array(alive))

    a = signed.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    b = signed.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb").mapInArrow(compare, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough: 100 x intersection >= per_cent x union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= per_cent * max(len(x), len(y)) else 0
                good.append(100 * both >= per_cent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, type=pa.bool_()))

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "xa", "xb").mapInArrow(compare, "a bigint, b bigint")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, size: int, per_cent: int) -> DataFrame:
    """Those of the pairs (a, b) that are similar."""
    left = kept(_surviving(pairs, classes, per_cent))
    if left.isEmpty():
        return left
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = kept(classes.select("node", "id", "digest").join(nodes, "node"))
    return kept(verified(left, kept(sets_of(docs, id_column, size, wanted)), per_cent))


def _apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, node, label, of_least, n) of bands in which some pair is neither compared nor joined.

    All members were compared with the band's least; a pair is left if one is in another component
    than the least and there is a third member.
    """
    labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    state = labelled.groupBy("key").agg(
        F.max(F.when(F.col("node") == F.col("least"), F.col("label"))).alias("of_least"),
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"),
    ).filter("n > 2 AND low < high")
    return labelled.join(state.select("key", "of_least", "n"), "key").select("key", "node", "label", "least", "of_least", "n")


def _across(apart: DataFrame) -> DataFrame:
    """Pairs of a member outside the least's component with any member of another component."""
    outside = apart.filter("label <> of_least").select("key", F.col("node").alias("x"), F.col("label").alias("lx"))
    both = outside.join(apart.select("key", "node", "label"), "key").filter("lx <> label")
    return both.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _membership(sets: list[np.ndarray], elements: np.ndarray) -> np.ndarray:
    """One row of 0 and 1 per set: which of the sorted elements it has."""
    out = np.zeros((len(sets), len(elements)), dtype=np.float32)
    for row, values in enumerate(sets):
        at = np.searchsorted(elements, values)
        at[at == len(elements)] = 0
        out[row, at[elements[at] == values]] = 1
    return out


def _similar_in_blocks(left: list, right: list, per_cent: int, needed: list[int], same: bool) -> list[tuple[int, int]]:
    """Similar pairs (a, b) of members (node, label, signature, set) of two blocks that are in different components."""
    if not left or not right:
        return []
    (n1, l1, s1, x1), (n2, l2, s2, x2) = (list(zip(*side)) for side in (left, right))
    alive = np.array(l1)[:, None] != np.array(l2)[None, :]
    if same:
        alive &= np.array(n1)[:, None] < np.array(n2)[None, :]
    if s1[0] is not None:
        s1, s2 = (np.frombuffer(b"".join(s), dtype=np.uint32).reshape(len(s), -1) for s in (s1, s2))
        seen = np.zeros(alive.shape, dtype=np.int16)
        for step, least in enumerate(needed):
            for k in range(step * BATCH, (step + 1) * BATCH):
                seen += s1[:, k, None] == s2[None, :, k]
            alive &= seen >= least
            if not alive.any():
                return []
    x1, x2 = ([np.frombuffer(x, dtype=np.uint64) for x in side] for side in (x1, x2))
    rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if not len(rows):
        return []
    # Sets as rows of 0 and 1 over the elements that both sides have: the product counts common elements.
    common = np.intersect1d(np.concatenate([x1[i] for i in rows]), np.concatenate([x2[j] for j in columns]))
    both = np.zeros((len(rows), len(columns)), dtype=np.float32)
    for begin in range(0, len(common), ELEMENTS):
        part = common[begin : begin + ELEMENTS]
        both += _membership([x1[i] for i in rows], part) @ _membership([x2[j] for j in columns], part).T
    sizes = np.array([len(x1[i]) for i in rows])[:, None] + np.array([len(x2[j]) for j in columns])[None, :]
    good = alive[np.ix_(rows, columns)] & (100 * both >= per_cent * (sizes - both))
    return [(n1[rows[i]], n2[columns[j]]) for i, j in zip(*np.nonzero(good))]


def _in_blocks(members: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Similar pairs (a, b) of different components within the clusters of ``members`` (node, label, cluster).

    ``sets`` has (node, signature, shingles). A cluster is dealt into blocks of about BLOCK members by their hash, and each
    pair of blocks is one row: a task compares a block's signatures, and then its sets, side by side. So rows grow with
    the number of pairs of blocks, and only similar pairs come out.
    """
    needed = least_matches(per_cent / 100)
    blocks = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    held = (
        members.join(blocks, "cluster").join(sets, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .groupBy("cluster", "blocks", "block")
        .agg(F.collect_list(F.struct("node", "label", "signature", "shingles")).alias("held"))
    )
    held = stored(held)
    last = F.col("blocks") - 1
    left = held.select("cluster", F.col("block").alias("i"), F.explode(F.sequence("block", last)).alias("j"), F.col("held").alias("left"))
    right = held.select("cluster", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("block"))).alias("i"), F.col("block").alias("j"), F.col("held").alias("right"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                i, j, one, two = (batch.column(c)[row].as_py() for c in range(4))
                one, two = ([tuple(m.values()) for m in side] for side in (one, two))
                found = _similar_in_blocks(one, two, per_cent, needed, i == j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], type=pa.int64()) for k in (0, 1)], names=["a", "b"])

    return left.join(right, ["cluster", "i", "j"]).select("i", "j", "left", "right").mapInArrow(compare, "a bigint, b bigint")


def joined(
    buckets: DataFrame, links_of: Callable[[DataFrame], DataFrame], sets_for: Callable[[DataFrame], DataFrame], per_cent: int
) -> DataFrame:
    """(node, label) of linked nodes, from the bands (key, node, least).

    ``links_of`` keeps the similar ones of pairs (a, b); ``sets_for`` gives (node, signature or null, shingles) of nodes.
    """
    compared = kept(buckets.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct())
    links = links_of(compared)
    labels = kept(components(links))
    apart = kept(_apart(buckets, labels))
    pairs = kept(_across(apart.filter(F.col("n") <= SMALL_BAND)).join(compared, ["a", "b"], "left_anti"))
    more = links.limit(0) if pairs.isEmpty() else links_of(pairs)
    large = apart.filter(F.col("n") > SMALL_BAND)
    if not large.isEmpty():
        clusters = components(large.select(F.col("least").alias("a"), F.col("node").alias("b")))
        members = kept(clusters.withColumnRenamed("label", "cluster").join(labels, "node", "left").select(
            "node", "cluster", F.coalesce("label", "node").alias("label")))
        more = more.union(kept(_in_blocks(members, sets_for(members.select("node")), per_cent)))
    if more.isEmpty():
        return labels
    return kept(components(links.union(more)))


def linked(docs: DataFrame, id_column: str, size: int, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, n_shingles, digest), and (digest, component): the smallest id reachable by links.

    A null id counts only if nothing else is in its component. Empty sets have a null digest and no component.
    """
    prepare(docs.sparkSession)
    rows = kept(described(docs, id_column, size))
    first = F.min_by(F.struct("id", "signature"), F.struct(F.col("id").isNull(), F.col("id")))
    classes = kept(
        rows.filter("digest IS NOT NULL").groupBy("digest").agg(first.alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "first.*")
    )
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    band = F.transform(numbers, lambda i: F.xxhash64(i, F.substring("signature", i * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    keyed = classes.select("node", F.explode(band).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1")
    buckets = kept(keyed.join(shared.select("key", "least"), "key"))

    def sets_for(nodes: DataFrame) -> DataFrame:
        known = kept(classes.join(nodes, "node", "left_semi"))
        return sets_of(docs, id_column, size, known.select("node", "id", "digest")).join(known.select("node", "signature"), "node")

    labels = joined(buckets, lambda pairs: _links(pairs, classes, docs, id_column, size, per_cent), sets_for, per_cent)
    named = classes.select("node", "id", "digest").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("id").alias("component"))
    return rows.drop("signature"), named.join(least, "label").select("digest", "component")


def near_duplicates(docs: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Words are those between ASCII white space, with A-Z lower-cased. A text without words has an empty
    set, is linked with nothing and is its own component. Rows that share a doc_id are documents of their own with
    the same id. Only doc_id and text are read.
    """
    rows, found = linked(docs, "doc_id", size, per_cent)
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.join(found, "digest", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
