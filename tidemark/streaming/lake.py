"""Replica tables that take a batch by appending it, and merge when they are read.

What is stored is change rows, not replica rows: per key the position of its first insert and, per column,
the last value written with the position of that write in the log. Change rows combine by least and greatest
position, so it does not matter in which batch, how often or in which order events arrive: an older offset
never overwrites a newer one, a re-sent one changes nothing, and an update that comes before its insert waits
for it. A replica row is what the combined change row of its key makes of nothing.

A batch is one *delta*: its change rows, appended in files sorted by bucket. It reads nothing of what is
stored. Readers combine the base with the deltas. A bucket whose deltas have grown to a share of its
base is *compacted*: its base and deltas become a new base, and no other bucket is touched. A bucket that has
outgrown ``bucket_bytes`` is split in two as it is compacted, and again if need be, so a table starts small and gets more
buckets as it grows. A bucket is a range of *places*: the key's hash with its bits reversed, so
that the parts of a bucket stay neighbours in a sorted delta file, whose row groups are skipped by their bounds.

``path/commits/<version>.json`` lists what a version consists of, and ``path/data/__version=<version>`` holds the
files that it added. A version is visible once its list is written. A list also names the last batch applied of
each source, with its counts, so a batch is known by its stream and its number in that stream. A batch that is
run again, after a lost driver or executor, writes the same folder and changes nothing once its list exists.
One writer at a time: a second one that makes the same version gets an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace as changed
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import Policy
from tidemark.functions.types import DELETED_AT, TableSchema, quoted, replica_schema
from tidemark.operators.fold import (
    EVENTS,
    FIRST_INSERT,
    FIRST_SLOT,
    INSERTS,
    LAST_SLOT,
    LOG_ORDER,
    UPDATES,
    keys_in_one_place,
)
from tidemark.operators.merge import empty_replica, rows_created
from tidemark.operators.typed import payload_columns
from tidemark.streaming import files

# Internal, so that a source column may be called anything.
BUCKET = "__bucket"
PLACE = "__place"
VERSION = "__version"
#: When a key's first change row was stored: what ``current_timestamp`` means as a default.
CREATED = "__created"
PLACE_BITS = 32
#: Stored bytes that a task of a compaction merges. As rows in memory they are many times as large.
TASK_BYTES = 16 << 20
_DELTA = "delta"
_POSITION_TYPES = {"ts_ms": T.LongType(), "partition": T.IntegerType(), "offset": T.LongType()}
#: Position of rows that were loaded from a snapshot: before any event.
_BEFORE = -1


class SplitKeyError(ValueError):
    """A key's events came from two log partitions, so their log order is undefined."""


@dataclass(frozen=True)
class Bucket:
    """The keys whose place begins with ``depth`` bits of value ``prefix``.

    ``version`` is the one that wrote its base (None if it has no rows); later deltas than ``since`` are not in it.
    """

    depth: int
    prefix: int
    version: int | None = None
    since: int = -1
    size: int = 0

    @property
    def name(self) -> str:
        return f"{self.depth}_{self.prefix}"

    @property
    def first(self) -> int:
        """Its least place."""
        return self.prefix << (PLACE_BITS - self.depth)


@dataclass(frozen=True)
class Counts:
    """Of a batch: events applied, inserts and updates among them, and keys from more than one log partition."""

    batch: int
    events: int = 0
    inserts: int = 0
    updates: int = 0
    split: int = 0


@dataclass(frozen=True)
class Manifest:
    """What a version consists of. ``deltas`` maps the version of a delta to its bytes."""

    version: int = -1
    buckets: tuple[Bucket, ...] = (Bucket(0, 0),)
    deltas: dict[int, int] = field(default_factory=dict)
    applied: dict[str, Counts] = field(default_factory=dict)

    @property
    def depth(self) -> int:
        return max(b.depth for b in self.buckets)

    @property
    def base_bytes(self) -> int:
        return sum(b.size for b in self.buckets)

    def to_json(self) -> dict[str, Any]:
        return {
            "version": self.version,
            "buckets": [[b.depth, b.prefix, b.version, b.since, b.size] for b in self.buckets],
            "deltas": list(self.deltas.items()),
            "applied": {source: list(c.__dict__.values()) for source, c in self.applied.items()},
        }

    @staticmethod
    def from_json(value: dict[str, Any]) -> Manifest:
        return Manifest(
            value["version"],
            tuple(Bucket(*b) for b in value["buckets"]),
            {version: size for version, size in value["deltas"]},
            {source: Counts(*c) for source, c in value["applied"].items()},
        )


def place_of(keys: list[str]) -> Column:
    """Place of a key: its hash, the one that ``repartition(n, *keys)`` uses, with the 32 bits reversed.

    A frame in 2**d partitions by key then has whole buckets of depth d or less in each.
    """
    bits = F.hash(*map(quoted, keys)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    for width, mask in ((1, 0x55555555), (2, 0x33333333), (4, 0x0F0F0F0F), (8, 0x00FF00FF), (16, 0x0000FFFF)):
        left = F.shiftleft(bits.bitwiseAND(F.lit(mask)), width)
        bits = left.bitwiseOR(F.shiftright(bits, width).bitwiseAND(F.lit(mask)))
    return bits


class ReplicaTable:
    """One replica.

    ``buckets`` is how many the table is laid out in when it is replaced whole; it gets more as it grows.
    ``compact_share`` is the share of the base that deltas may reach before the next batch compacts; None leaves
    compaction to the caller. Deltas up to ``broadcast_bytes`` are sent to the base's tasks by readers.
    """

    def __init__(
        self,
        path: str,
        table: TableSchema,
        policy: Policy = Policy(),
        buckets: int = 1,
        broadcast_bytes: int = 64 << 20,
        allow_split_keys: bool = False,
        order: tuple[str, ...] = LOG_ORDER,
        bucket_bytes: int = 256 << 20,
        compact_share: float | None = 0.25,
        most_deltas: int = 64,
    ) -> None:
        self.path = path.rstrip("/")
        self.table = table
        self.policy = policy
        self.buckets = buckets
        self.broadcast_bytes = broadcast_bytes
        self.allow_split_keys = allow_split_keys
        self.order = order
        self.bucket_bytes = bucket_bytes
        self.compact_share = compact_share
        self.most_deltas = most_deltas

    # --- versions ---------------------------------------------------------------------

    def version(self, spark: SparkSession) -> int | None:
        return files.last_version(spark, f"{self.path}/commits")

    def manifest(self, spark: SparkSession, version: int | None = None) -> Manifest:
        """What a version, or else the last one, consists of."""
        version = self.version(spark) if version is None else version
        if version is None or version < 0:
            return Manifest()
        return Manifest.from_json(files.read_json(spark, f"{self.path}/commits/{version}.json"))

    def applied(self, spark: SparkSession) -> dict[str, int]:
        """Number of the last batch applied of each source."""
        return {source: counts.batch for source, counts in self.manifest(spark).applied.items()}

    def _commit(self, spark: SparkSession, state: Manifest) -> None:
        files.commit_json(spark, f"{self.path}/commits/{state.version}.json", state.to_json())

    # --- writing ----------------------------------------------------------------------

    def apply(self, changes: DataFrame, batch_id: int, source: str = "") -> bool:
        """Append the change rows of a batch; False if this batch of this source was applied before.

        A source counts its batches upwards and repeats none but its last. Keys from several log partitions are an error.
        """
        before = self.manifest(changes.sparkSession).applied.get(source)
        if before and batch_id <= before.batch:
            return False
        self.append(changes, batch_id, source, strict=True)
        return True

    def append(self, changes: DataFrame, batch_id: int, source: str = "", strict: bool = False) -> Counts:
        """Append the change rows of a batch, and give its counts; again the same if it was applied before.

        One pass: the counts are observed while the rows are written. Keys whose events came from several log
        partitions are left out and counted, or an error if ``strict``.
        """
        spark = changes.sparkSession
        state = self.manifest(spark)
        known = state.applied.get(source)
        if known and batch_id <= known.batch:
            return known
        version = state.version + 1
        seen, kept = Observation(), Observation()
        split = F.count_if(F.col(FIRST_SLOT) != F.col(LAST_SLOT)).alias("split")
        rows = changes if self.allow_split_keys else keys_in_one_place(changes.observe(seen, split))
        tallied = rows.observe(
            kept, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (EVENTS, INSERTS, UPDATES)]
        )
        folder = self._folder(version)
        placed = self._storable(tallied)
        placed.sortWithinPartitions(PLACE).write.mode("overwrite").parquet(f"{folder}/{BUCKET}={_DELTA}")
        found, moved = kept.get, 0 if self.allow_split_keys else seen.get["split"]
        if moved and strict:
            raise SplitKeyError(f"{self.table.table}: keys moved between log partitions; fold in TIME_ORDER")
        counts = Counts(batch_id, found[EVENTS], found[INSERTS], found[UPDATES], moved)
        deltas = state.deltas
        if found["rows"]:
            deltas = {**deltas, version: files.size(spark, f"{folder}/{BUCKET}={_DELTA}")}
        state = changed(state, version=version, deltas=deltas, applied={**state.applied, source: counts})
        self._commit(spark, state)
        if self.compact_share is not None and self._due(state):
            self.compact(spark, self.compact_share)
        return counts

    def replace(self, changes: DataFrame) -> int:
        """Replace all rows by what these change rows make; gives the new version. Older ones stay until expired.

        What was applied of each source stays known, and positions are kept, so running streams go on, and what
        they bring of events that are in these rows already changes nothing.
        """
        return self._replace(self._storable(changes))

    def overwrite(self, rows: DataFrame) -> int:
        """Replace all rows by replica rows without positions, such as a snapshot: any event counts as later."""
        origin = F.struct(*[F.lit(_BEFORE).cast(_POSITION_TYPES[p]).alias(p) for p in self.order])

        def cell(name: str) -> Column:
            value = F.col(quoted(name)).alias("v")
            return F.struct(*[F.lit(_BEFORE).cast(_POSITION_TYPES[p]).alias(p) for p in self.order], value).alias(name)

        slots = [F.lit(None).cast("long").alias(slot) for slot in (FIRST_SLOT, LAST_SLOT)]
        keys = [F.col(quoted(k)) for k in self.table.keys]
        snapshot = rows.select(*keys, *slots, origin.alias(FIRST_INSERT), *[cell(c) for c in self._cells()])
        return self._replace(self._storable(snapshot))

    def _replace(self, rows: DataFrame) -> int:
        spark = rows.sparkSession
        state = self.manifest(spark)
        version, depth = state.version + 1, (self.buckets - 1).bit_length()
        buckets = [Bucket(depth, prefix) for prefix in range(1 << depth)]
        sizes = self._write_base(rows, buckets, version, dealt=True)
        filled = tuple(self._filled(b, sizes, version) for b in buckets)
        self._commit(spark, Manifest(version, filled, {}, state.applied))
        return version

    def _due(self, state: Manifest) -> bool:
        pending = sum(state.deltas.values())
        return len(state.deltas) > self.most_deltas or pending > max(self.compact_share * state.base_bytes, self.broadcast_bytes)

    def compact(self, spark: SparkSession, share: float = 0.0) -> list[str]:
        """Merge the deltas into the buckets where they exceed ``share`` of the base; gives the buckets written.

        If there are too many deltas, all buckets that have some are merged, so that the oldest can go.
        """
        state = self.manifest(spark)
        if not state.deltas:
            return []
        depth = state.depth
        # One row per smallest bucket; only the place column of the deltas is read.
        pending = self._pending(spark, state).groupBy(self._slot(depth).alias("slot")).count().collect()
        by_bucket: dict[Bucket, int] = {}
        slots = self._directory(state.buckets, depth)
        for row in pending:
            bucket = state.buckets[slots[row.slot]]
            by_bucket[bucket] = by_bucket.get(bucket, 0) + row["count"]
        per_row = sum(state.deltas.values()) / max(sum(by_bucket.values()), 1)
        sizes = {b: n * per_row for b, n in by_bucket.items()}
        share = 0.0 if len(state.deltas) > self.most_deltas else share
        chosen = {b: size for b, size in sizes.items() if size > share * b.size}
        version = state.version + 1
        parts = {b: self._parts(b, size + b.size) for b, size in chosen.items()}
        if chosen:
            largest = max((size + b.size) / len(parts[b]) for b, size in chosen.items())
            written = self._write_merged(spark, state, parts, version, largest)
            parts = {b: [self._filled(p, written, version, state.version) for p in mine] for b, mine in parts.items()}
        idle = {b: changed(b, since=state.version) for b in state.buckets if b not in sizes}
        buckets = tuple(p for b in state.buckets for p in parts.get(b, [idle.get(b, b)]))
        oldest = min(b.since for b in buckets)
        deltas = {v: size for v, size in state.deltas.items() if v > oldest}
        self._commit(spark, changed(state, version=version, buckets=buckets, deltas=deltas))
        return sorted(b.name for mine in parts.values() for b in mine)

    def _parts(self, bucket: Bucket, size: float) -> list[Bucket]:
        """The bucket, or its halves, quarters and so on, each small enough."""
        more = 0
        while size / (1 << more) > self.bucket_bytes and bucket.depth + more < PLACE_BITS - 1:
            more += 1
        return [Bucket(bucket.depth + more, (bucket.prefix << more) + i) for i in range(1 << more)]

    def _write_merged(
        self, spark: SparkSession, state: Manifest, parts: dict[Bucket, list[Bucket]], version: int, largest: float
    ) -> dict[str, int]:
        """Write the new base of some buckets, of which the largest has so many bytes; gives the bytes by name."""
        fresh = [p for mine in parts.values() for p in mine]
        spans = [(b.first, b.first + (1 << (PLACE_BITS - b.depth)) - 1) for b in _joined(list(parts))]
        mine = F.lit(False)
        for first, last in spans:
            mine = mine | F.col(PLACE).between(first, last)
        stored = self._base(spark, [b for b in parts if b.version is not None])
        # The test on places is pushed to the files, whose row groups are in this order.
        rows = stored.unionByName(self._pending(spark, state).filter(mine).drop(VERSION))
        depth = max(p.depth for p in fresh)
        if 1 << depth <= 4 * len(fresh):
            # One move: a partition by key lies in one bucket. A large bucket has several.
            depth = min(depth + int(largest / TASK_BYTES).bit_length(), PLACE_BITS - 2)
            merged = self._combined(rows.repartition(1 << depth, *map(quoted, self.table.keys)))
            return self._write_base(merged, fresh, version)
        return self._write_base(self._combined(rows), fresh, version, dealt=True)

    def _write_base(self, rows: DataFrame, buckets: list[Bucket], version: int, dealt: bool = False) -> dict[str, int]:
        """Write rows as the base of their buckets. Dealt, the rows of a bucket meet in one task, or in several if they are many."""
        folder = self._folder(version)
        named = rows.withColumn(BUCKET, self._bucket_name(buckets))
        named = named.hint("rebalance", BUCKET) if dealt else named
        named.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        spark = rows.sparkSession
        found = [name.removeprefix(f"{BUCKET}=") for name in files.names(spark, folder) if name.startswith(f"{BUCKET}=")]
        return {name: files.size(spark, f"{folder}/{BUCKET}={name}") for name in found}

    @staticmethod
    def _filled(bucket: Bucket, sizes: dict[str, int], version: int, since: int | None = None) -> Bucket:
        since = version if since is None else since
        if bucket.name not in sizes:
            return changed(bucket, since=since)
        return changed(bucket, version=version, since=since, size=sizes[bucket.name])

    # --- reading ----------------------------------------------------------------------

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of a version, or else the current ones."""
        state = self.manifest(spark, version)
        if not state.deltas and all(b.version is None for b in state.buckets):
            return empty_replica(spark, self.table, self.policy)
        return rows_created(self.changes(spark, state.version), self.table, self.policy, F.col(CREATED))

    def split_keys(self, spark: SparkSession) -> DataFrame:
        """Keys whose events came from several log partitions in different batches, so that their order is undefined."""
        return self.changes(spark).filter(F.col(FIRST_SLOT) != F.col(LAST_SLOT)).select(*map(quoted, self.table.keys))

    def changes(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """One change row per key: base and deltas combined."""
        state = self.manifest(spark, version)
        base = self._base(spark, [b for b in state.buckets if b.version is not None])
        if not state.deltas:
            return base
        deltas = self._pending(spark, state).drop(VERSION)
        if sum(state.deltas.values()) > self.broadcast_bytes or not state.base_bytes:
            return self._combined(base.unionByName(deltas))
        return self._combined_broadcast(base, self._combined(deltas))

    def _combined_broadcast(self, base: DataFrame, deltas: DataFrame) -> DataFrame:
        """The base's rows with the deltas' greater cells, and the deltas' new keys; the base does not move."""
        keys = [quoted(k) for k in self.table.keys]
        old, new = base.alias("old"), F.broadcast(deltas.alias("new"))
        same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]

        def of(name: str, pick) -> Column:
            return pick(F.col(f"old.{quoted(name)}"), F.col(f"new.{quoted(name)}")).alias(name)

        lower, upper = (FIRST_SLOT, FIRST_INSERT, CREATED), (LAST_SLOT, *self._cells())
        joined = old.join(new, same, "left").select(
            *[F.col(f"old.{k}") for k in keys],
            *[of(name, F.least) for name in lower],
            *[of(name, F.greatest) for name in upper],
            F.col(f"old.{PLACE}"),
        )
        # The second scan of the base reads its keys only.
        hits = base.select(*keys).join(F.broadcast(deltas.select(*keys)), self.table.keys, "left_semi")
        fresh = deltas.join(F.broadcast(hits), self.table.keys, "left_anti")
        return joined.select(*map(quoted, self._names())).unionByName(fresh.select(*map(quoted, self._names())))

    def _combined(self, rows: DataFrame) -> DataFrame:
        """One row per key: the least first insert, and of every column the cell with the greatest position."""
        return rows.groupBy(*map(quoted, self.table.keys)).agg(
            F.min(FIRST_SLOT).alias(FIRST_SLOT),
            F.max(LAST_SLOT).alias(LAST_SLOT),
            F.min(FIRST_INSERT).alias(FIRST_INSERT),
            F.min(CREATED).alias(CREATED),
            *[F.max(quoted(c)).alias(c) for c in self._cells()],
            F.min(PLACE).alias(PLACE),
        )

    def _base(self, spark: SparkSession, buckets: list[Bucket]) -> DataFrame:
        if not buckets:
            return spark.createDataFrame([], self._stored())
        folders = [f"{self._folder(b.version)}/{BUCKET}={b.name}" for b in buckets]
        rows = spark.read.schema(self._stored()).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*map(quoted, self._names()))

    def _pending(self, spark: SparkSession, state: Manifest) -> DataFrame:
        """Rows of deltas that are not in the base of their bucket yet."""
        folders = [f"{self._folder(v)}/{BUCKET}={_DELTA}" for v in state.deltas]
        schema = T.StructType([*self._stored().fields, T.StructField(VERSION, T.LongType())])
        rows = spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)
        rows = rows.select(*map(quoted, schema.fieldNames()))
        since = {b.since for b in state.buckets}
        if min(state.deltas) > max(since):
            return rows
        slots = self._directory(state.buckets, state.depth)
        marks = F.array(*[F.lit(state.buckets[slots[slot]].since) for slot in range(1 << state.depth)])
        return rows.filter(F.col(VERSION) > F.get(marks, self._slot(state.depth)))

    # --- housekeeping -----------------------------------------------------------------

    def expired(self, spark: SparkSession, keep: int) -> list[str]:
        """Folders and lists that none of the last ``keep`` versions needs."""
        versions = sorted(int(n.removesuffix(".json")) for n in files.names(spark, f"{self.path}/commits") if n.endswith(".json"))
        kept = versions[-keep:]
        needed = set()
        for version in kept:
            state = self.manifest(spark, version)
            needed |= {(b.version, b.name) for b in state.buckets if b.version is not None}
            needed |= {(v, _DELTA) for v in state.deltas}
        found = []
        for name in files.names(spark, f"{self.path}/data"):
            version = int(name.removeprefix(f"{VERSION}="))
            if versions and version > versions[-1]:  # being written
                continue
            parts = [p for p in files.names(spark, f"{self.path}/data/{name}") if p.startswith(f"{BUCKET}=")]
            unused = [p for p in parts if (version, p.removeprefix(f"{BUCKET}=")) not in needed]
            if len(unused) == len(parts):
                found.append(f"{self.path}/data/{name}")
            else:
                found += [f"{self.path}/data/{name}/{p}" for p in unused]
        return found + [f"{self.path}/commits/{version}.json" for version in versions if version < kept[0]]

    def expire(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete what :meth:`expired` lists; readers of the last ``keep`` versions go on."""
        if keep < 1:
            raise ValueError("the current version cannot expire")
        gone = self.expired(spark, keep)
        for path in gone:
            files.delete(spark, path)
        return len(gone)

    # --- layout -----------------------------------------------------------------------

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/{VERSION}={version}"

    def _cells(self) -> list[str]:
        keys = set(self.table.keys)
        return [*[c.name for c in payload_columns(self.table) if c.name not in keys], DELETED_AT]

    def _names(self) -> list[str]:
        return [*self.table.keys, FIRST_SLOT, LAST_SLOT, FIRST_INSERT, CREATED, *self._cells(), PLACE]

    def _stored(self) -> T.StructType:
        kinds = {f.name: f.dataType for f in replica_schema(self.table, self.policy.dialect)}
        position = [T.StructField(p, _POSITION_TYPES[p]) for p in self.order]
        fixed = {FIRST_SLOT: T.LongType(), LAST_SLOT: T.LongType(), FIRST_INSERT: T.StructType(position)}
        fixed |= {CREATED: T.TimestampType(), PLACE: T.LongType()}
        fixed |= {k: kinds[k] for k in self.table.keys}
        cells = {c: T.StructType([*position, T.StructField("v", kinds[c])]) for c in self._cells()}
        return T.StructType([T.StructField(n, (fixed | cells)[n]) for n in self._names()])

    def _storable(self, changes: DataFrame) -> DataFrame:
        """Change rows as they are stored."""
        extra = {CREATED: F.current_timestamp(), PLACE: place_of(self.table.keys)}
        schema = self._stored()
        return changes.select(*[
            (extra[f.name] if f.name in extra else F.col(quoted(f.name))).cast(f.dataType).alias(f.name) for f in schema
        ])

    def _slot(self, depth: int) -> Column:
        """The first ``depth`` bits of a row's place."""
        return F.shiftright(F.col(PLACE), PLACE_BITS - depth).cast("int")

    @staticmethod
    def _directory(buckets: tuple[Bucket, ...] | list[Bucket], depth: int) -> dict[int, int]:
        """Which bucket each value of the first ``depth`` bits lies in."""
        found = {}
        for i, bucket in enumerate(buckets):
            width = 1 << (depth - bucket.depth)
            found.update({bucket.prefix * width + j: i for j in range(width)})
        return found

    def _bucket_name(self, buckets: list[Bucket]) -> Column:
        depth = max(b.depth for b in buckets)
        slots = self._directory(buckets, depth)
        if len({b.depth for b in buckets}) == 1:
            return F.concat(F.lit(f"{depth}_"), self._slot(depth).cast("string"))
        names = F.array(*[F.lit(buckets[slots[i]].name if i in slots else None) for i in range(1 << depth)])
        return F.get(names, self._slot(depth))


def _joined(buckets: list[Bucket]) -> list[Bucket]:
    """The fewest buckets that cover the same places."""
    found = set((b.depth, b.prefix) for b in buckets)
    for depth in range(max(b.depth for b in buckets), 0, -1):
        for prefix in [p for d, p in found if d == depth and p % 2 == 0 and (d, p + 1) in found]:
            found -= {(depth, prefix), (depth, prefix + 1)}
            found.add((depth - 1, prefix // 2))
    return [Bucket(d, p) for d, p in sorted(found)]
