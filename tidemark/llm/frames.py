"""Helpers on data frames shared by the operators: inputs, checkpoints, bitmaps and components."""

from __future__ import annotations

import gc
import itertools
import math
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
MAX_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch, so that a batch of ordinary documents is a few MB.
BATCH_ROWS = "1000"
#: Largest bitmap that is sent to tasks: 2**27 bits are 16 MB.
MAX_BITS = 27


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, a checkpoint folder, and this package on the executors.

    The folder is the session's ``spark.checkpoint.dir``; only a local session may go without
    one and gets a folder of its own.
    """
    if spark.conf.get(MAX_RECORDS, "10000") == "10000":
        spark.conf.set(MAX_RECORDS, BATCH_ROWS)
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        root = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
        if not root:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
            root = tempfile.mkdtemp(prefix="tidemark-llm-")
        context.setCheckpointDir(root)
    _ship(context)
    return spark


def _ship(context) -> None:
    """Give the executors this package, once per context: they may not have it on their path."""
    if getattr(context, "_tidemark_shipped", False):
        return
    context._tidemark_shipped = True
    package = Path(__file__).resolve().parent.parent
    if not package.is_dir():  # it already comes from an archive
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Links that a task of ``components`` may have.
LINKS_PER_TASK = 100_000
#: Pieces of 4 KB of a bitmap that a task gathers.
PARTS_PER_TASK = 16
#: Results that are kept between two calls of ``release``.
RELEASE_EVERY = 3
_kept = itertools.count(1)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and checkpoints that nothing refers to any more.

    Spark deletes them when the driver's objects are collected, which in a driver that is mostly idle happens too
    late: the files of all steps of a job would lie on disk together.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _count(spark: SparkSession) -> None:
    if next(_kept) % RELEASE_EVERY == 0:
        release(spark)


def kept(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder: computed once, and safe from lost executors."""
    spark = prepare(frame.sparkSession)
    written = frame.checkpoint(eager=True)
    _count(spark)
    return written


def stored(frame: DataFrame) -> DataFrame:
    """The rows, written as a table in the shared checkpoint folder: smaller than ``kept`` for many rows."""
    spark = prepare(frame.sparkSession)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    _count(spark)
    return spark.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Bitmap:
    """Which hashed values may be in a set. A value in the set always passes; the size has a fixed bound."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, values: np.ndarray) -> np.ndarray:
        at = values.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(values: DataFrame, column: str, max_bits: int = MAX_BITS) -> Bitmap:
    """The bitmap of a column of 64-bit hashes, aggregated on the executors.

    The driver gets the bitmap only, 2**max_bits / 8 bytes at most however many values there
    are. Beyond that size more values pass than are in the set, so an exact join must follow.
    """
    n = values.count()
    bits = min(max_bits, max(16, math.ceil(math.log2(16 * n + 1))))
    bit = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = (
        values.select(F.shiftright(bit, 15).alias("part"), (bit.bitwiseAND(F.lit(32767))).alias("bit"))
        .groupBy("part")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("map"))
        # The driver runs a job for each task here, and a small bitmap has few pieces.
        .coalesce(max(1, (1 << bits - 15) // PARTS_PER_TASK))
        .toLocalIterator()
    )
    data = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in rows:
        data[row.part * 4096 : row.part * 4096 + 4096] = np.frombuffer(row.map, dtype=np.uint8)[: len(data)]
    return Bitmap(bits, data)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, sorted, and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[one], root[two]
        if (x == y).all():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    """Components of so few links that a task holds them all."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[batch.column(c).to_numpy() for c in (0, 1)] for batch in batches]
        if held:
            found = least_reachable(*[np.concatenate(side) for side in zip(*held)])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "label"])

    return edges.coalesce(1).mapInArrow(label, "node bigint, label bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node with a link; the label is the smallest node reachable.

    Links have columns ``a`` and ``b`` and are read twice. Large and small stars alternate until nothing changes, however
    many rounds that takes (about the logarithm of the longest path); each round moves one row per link and no group is
    gathered. Up to ``LINKS_PER_TASK`` links, from the start or left by a round, need no rounds over all partitions: one
    task labels them.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if edges.count() <= LINKS_PER_TASK:
        return _in_one_task(edges)
    edges = kept(edges.distinct())
    before = _fingerprint(edges)
    while before[0] > LINKS_PER_TASK:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )).alias("e")).select("e.a", "e.b")
        # Few links are few tasks; a round at most doubles them.
        edges = kept(small.filter("a <> b").distinct().coalesce(-(-before[0] // LINKS_PER_TASK)))
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        return _in_one_task(edges)
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("label"))
    )


def in_third(doc_id: Column | str, of: int, is_not: int) -> Column:
    """Whether the crc32 of a key's text leaves another remainder than ``is_not``; a null key counts as text ''."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(of)) != is_not
