"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted sequence are cut into pieces of that length and a rest; nothing is
dropped. Pieces are spread over shards at random, and each shard is packed on its own: pieces go from the
longest on into the open bin that they fill best, and if none has room a new one is opened. At the end every bin
shrinks to the smallest permitted length that holds what is in it.

Which length to open is chosen jointly for all lengths, bin by bin: for each permitted length that has room, the pieces still to
come show how far it could be filled, and the length opens whose cost per token it would then hold is least. A shard is
also packed once for each permitted length as the least to open, and the packing whose shrunken bins cost least is kept. A bin of c tokens costs
c + c * c / KNEE: the part that grows with its tokens, and attention, which grows with their square.

A shard has about ``PIECES`` pieces whatever the table's size, so more documents mean more shards, not larger ones.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept, prepare

#: Permitted sequence lengths, in bytes (the tokens of byte-level models), the shortest first.
LENGTHS = (2048, 4096, 8192, 16384)
KNEE = 32768
PIECES = 1000


def cost(length: int) -> float:
    return length + length * length / KNEE


def shrunk(used: int, lengths: Sequence[int]) -> int:
    """The shortest permitted length that holds so much."""
    return lengths[bisect_left(lengths, used)]


def least_from(least: int) -> Callable:
    """Opens the shortest length that fits, but none shorter than ``least``."""
    return lambda sizes, at, lengths: shrunk(max(sizes[at], least), lengths)


def cheapest_per_token(sizes: Sequence[int], at: int, lengths: Sequence[int]) -> int:
    """The length whose cost per token would be least, filled with the largest pieces to come that go in, one after another."""
    best = None
    for length in lengths[bisect_left(lengths, sizes[at]):]:
        used, begin = sizes[at], at + 1
        while begin < len(sizes):
            # Sizes descend: the first one from here on that has room.
            begin = bisect_left(sizes, used - length, lo=begin, key=lambda size: -size)
            if begin == len(sizes):
                break
            used, begin = used + sizes[begin], begin + 1
        share = cost(shrunk(used, lengths)) / used
        if best is None or share < best[0]:
            best = (share, length)
    return best[1]


def pack_once(sizes: Sequence[int], lengths: Sequence[int], opens: Callable) -> tuple[list[int], list[int]]:
    """Bin of each piece and length of each bin, shrunk, if ``opens`` says which length a new bin gets. Sizes descend."""
    rooms: list[tuple[int, int]] = []  # (free, bin), sorted
    bins, used = [], []
    for i, size in enumerate(sizes):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            free, number = rooms.pop(at)
        else:
            free, number = opens(sizes, i, lengths), len(used)
            used.append(0)
        used[number] += size
        bins.append(number)
        if free > size:
            insort(rooms, (free - size, number))
    return bins, [shrunk(n, lengths) for n in used]


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int]]:
    """The cheapest of the packings that the ways to open a bin give; the first of equals. Sizes descend, lengths ascend."""
    ways = [cheapest_per_token, *map(least_from, lengths)]
    return min((pack_once(sizes, lengths, opens) for opens in ways), key=lambda p: sum(map(cost, p[1])))


def best_fit(docs: DataFrame, length: Column | None = None, lengths: Sequence[int] = LENGTHS, pieces: int = PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, bin_length and place (order in the bin).

    ``length`` is the size of a document in tokens, by default its bytes. A document of size 0 (a null or empty text)
    has one piece of length 0 and no bin. Repeated rows are packed each for itself. Columns other than
    doc_id and those of ``length`` are not read.
    """
    prepare(docs.sparkSession)
    lengths = sorted(set(lengths))
    top = lengths[-1]
    size = F.coalesce(F.octet_length(F.col("text").cast("string")) if length is None else length, F.lit(0)).cast("bigint")
    cuts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.expr(f"(size - 1) div {top}")))
    parts = kept(
        docs.select("doc_id", size.alias("size"))
        .select("doc_id", "size", F.explode(cuts).alias("piece"))
        .select(
            "doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * top).alias("start"),
            F.least(F.lit(top), F.col("size") - F.col("piece") * top).alias("length"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    shards = max(1, -(-parts.count() // pieces))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack_shard(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        bins, capacity = pack(frame["length"].tolist(), lengths)
        bins = np.array(bins)
        out = frame[["doc_id", "piece", "start", "length"]].copy()
        out["bin_id"] = key[0] * (1 << 32) + bins
        out["bin_length"] = np.array(capacity)[bins]
        out["place"] = out.groupby("bin_id").cumcount().astype("int32")
        return out

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, bin_id bigint, bin_length bigint, place int"
    packed = (
        parts.filter("length > 0")
        .withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        .groupBy("shard").applyInPandas(pack_shard, schema)
    )
    empty = parts.filter("length <= 0").select(
        "doc_id", "piece", "start", F.lit(0).cast("bigint").alias("length"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("bin_id", "bigint"), ("bin_length", "bigint"), ("place", "int"))],
    )
    return packed.unionByName(empty)
