"""The replication job: one stream of log rows, fanned out to many replica tables.

Tables are written one by one, each with versions of its own, and become visible together: an *epoch* lists the
version of every table after a batch, and readers take the versions of one epoch. A job that stops between two
tables leaves the last epoch as it was; its batch comes again, tables that have it already skip it, and then
the epoch follows. ``root/epochs/<n>.json`` is an epoch.

The catalog may be read anew for every batch. Events of a table or with a column that it does not have yet are
parked instead of rejected, and go through again with the first batch that sees another catalog. Replicas
keep the position of every value, so it does not matter that they come late.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.convert import Policy
from tidemark.functions.envelope import DELETE, INSERT, UPDATE, exclude_topics, topic_table
from tidemark.functions.types import TableSchema
from tidemark.operators import rejects, replay
from tidemark.operators.fold import LOG_ORDER, fold, keys_in_one_place, keys_in_two_places, operation_counts
from tidemark.operators.typed import UNKNOWN_COLUMN, UNKNOWN_TABLE, table_events, typed_events
from tidemark.sources.changelog import LOG_SCHEMA
from tidemark.streaming import files
from tidemark.streaming.lake import Counts, ReplicaTable
from tidemark.streaming.retry import SinkFailure

Catalog = dict[str, TableSchema]
#: Takes the change rows of a table, batch and source; may give the number of deadlocks that took.
Sink = Callable[[TableSchema, DataFrame, int, str], Any]
Counted = tuple[str, str, int]
BATCH_STATISTICS = pa.schema(
    [
        ("batch_id", pa.int64()),
        ("source_table", pa.string()),
        ("operation", pa.string()),
        ("events", pa.int64()),
        ("seconds", pa.float64()),
    ]
)
#: A failed attempt that was repeated.
DEADLOCK = "deadlock"
#: Reasons that a later catalog may lift.
WAITING = (UNKNOWN_TABLE, UNKNOWN_COLUMN)
#: Rows of a staged file, so that readers share the files of few large tasks.
STAGED_ROWS = 100_000


@dataclass
class Applied:
    """What a batch did to a table: events by operation, whether keys came from several log partitions, and deadlocks on the way.

    ``batch`` is the one that the counts are of, if it is known.
    """

    counts: list[Counted]
    split: bool
    deadlocks: int = 0
    batch: int | None = None


@dataclass(frozen=True)
class Present:
    """Of a table that a batch names: its name in lower case, its first and last topic, and the number of its events.

    With one topic, a row's topic can be compared with the bounds of a file's row groups. No topic: none names the table.
    """

    name: str
    first: str | None
    last: str | None
    events: int


@dataclass(frozen=True)
class Batch:
    """The log rows of a batch, staged as files, and how they are parsed.

    A topic that names its table is routed before the parse: each table parses its own rows, and what is kept is the
    text alone, not its parsed copy of several times the size. Rows of other topics may be of any table, so their events,
    if there are any, are parsed once and cached, on disk.
    """

    rows: DataFrame
    excluded: tuple[str, ...]
    #: Rows by topic: few rows, counted once.
    topics: DataFrame
    strays: DataFrame | None

    @staticmethod
    def of(log: DataFrame, excluded: tuple[str, ...], folder: str) -> Batch:
        # Read by every table. Not sorted: topics and files bring long runs of one table, so a table skips most files
        # of the others by their bounds.
        rows = _staged(exclude_topics(log.select(*LOG_SCHEMA.fieldNames()), excluded), folder)
        # The greatest and least of texts are found by sorting, so rows are counted by topic first.
        # They are few: cached, the partitions of the shuffle would not be joined.
        topics = rows.groupBy("topic").count().coalesce(1).withColumn("source_table", topic_table(F.col("topic"))).persist()
        lost = F.col("source_table").isNull()
        strays = None
        if not topics.filter(lost).isEmpty():
            strays = replay.parsed(rows.filter(topic_table(F.col("topic")).isNull()), excluded).persist(StorageLevel.DISK_ONLY)
        return Batch(rows, excluded, topics, strays)

    def unpersist(self) -> None:
        for frame in (self.strays, self.topics):
            if frame is not None:
                frame.unpersist()

    def named(self) -> DataFrame:
        """Rows whose topic names a table, with its name."""
        return self.rows.withColumn("source_table", topic_table(F.col("topic"))).filter("source_table IS NOT NULL")

    def _parsed(self, rows: DataFrame, strays: Column) -> DataFrame:
        found = replay.parsed(rows.select(*self.rows.columns), self.excluded)
        return found if self.strays is None else found.unionByName(self.strays.filter(strays))

    def table(self, of: Present) -> DataFrame:
        """The events of a table."""
        same = F.lower("source_table") == of.name
        mine = self.named().filter(same)
        mine = mine.filter(F.col("topic") == of.first) if of.first is not None and of.first == of.last else mine
        return self._parsed(mine, same)

    def without(self, tables: list[Present]) -> DataFrame:
        """The events of other tables, or of none."""
        names = [of.name for of in tables]
        rest, strays = self.named(), F.lit(True)
        for of in tables:
            if of.first is not None and of.first == of.last:
                rest = rest.filter((F.col("topic") < of.first) | (F.col("topic") > of.first))
        if names:
            rest = rest.filter(~F.lower("source_table").isin(names))
            strays = F.col("source_table").isNull() | ~F.lower("source_table").isin(names)
        return self._parsed(rest, strays)


@dataclass
class Epoch:
    """What is visible: versions by table, the last batch of each source, folders of parked events, and the catalog used."""

    number: int = -1
    tables: dict[str, int] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    parked: list[str] = field(default_factory=list)
    catalog: str = ""


@dataclass
class Replication:
    """Settings of a job, and what it does with one micro-batch.

    Replicas, dead letters and statistics are written below ``root``, all of them keyed
    by batch, so that a repeated micro-batch leaves no second trace. ``sink`` replaces the
    parquet replicas by another target, which has no epochs. A batch is known by the id of its checkpoint and its
    number there, so streams with new checkpoints, old ones and rebuilds can follow each other.
    ``catalog`` is the tables, or a function that reads them, which is called for every batch. ``buckets`` is the number that a
    rebuilt replica starts with, for all tables or by name; replicas get more as they grow.
    ``keep_versions`` is how many versions of a replica stay after a batch that changed it; None keeps all.
    """

    root: str
    catalog: Catalog | Callable[[SparkSession], Catalog]
    policy: Policy = field(default_factory=Policy)
    excluded: tuple[str, ...] = ()
    order: tuple[str, ...] = LOG_ORDER
    buckets: int | dict[str, int] = 1
    tables_at_once: int = 4
    sink: Sink | None = None
    keep_versions: int | None = None

    def _tables(self, spark: SparkSession) -> Catalog:
        return self.catalog(spark) if callable(self.catalog) else self.catalog

    def replica(self, name: str, table: TableSchema | None = None) -> ReplicaTable:
        """A table's replica; ``table`` is its schema, which a catalog that is read anew must be given."""
        if table is None:
            table = self._tables(SparkSession.active())[name]
        return ReplicaTable(
            f"{self.root.rstrip('/')}/replicas/{name}",
            table,
            self.policy,
            self.buckets.get(name, 1) if isinstance(self.buckets, dict) else self.buckets,
            allow_split_keys=self.order != LOG_ORDER,
            order=self.order,
        )

    @property
    def dead_letter_path(self) -> str:
        return f"{self.root.rstrip('/')}/dead_letters"

    @property
    def statistics_path(self) -> str:
        return f"{self.root.rstrip('/')}/statistics"

    @property
    def failures_path(self) -> str:
        return f"{self.root.rstrip('/')}/failures"

    @property
    def _epoch_path(self) -> str:
        return f"{self.root.rstrip('/')}/epochs"

    def epoch(self, spark: SparkSession, number: int | None = None) -> Epoch:
        """What was visible at an epoch, or else what is now."""
        number = files.last_version(spark, self._epoch_path) if number is None else number
        return Epoch() if number is None else Epoch(**files.read_json(spark, f"{self._epoch_path}/{number}.json"))

    def _publish(self, spark: SparkSession, epoch: Epoch) -> None:
        files.commit_json(spark, f"{self._epoch_path}/{epoch.number}.json", epoch.__dict__)

    def apply_batch(self, log: DataFrame, batch_id: int, source: str = "") -> None:
        """Apply one micro-batch to every table it has events of. A batch that comes again leaves what it left before."""
        started = time.time()
        spark = log.sparkSession
        tables, epoch = self._tables(spark), self.epoch(spark)
        if self.sink is None and batch_id <= epoch.applied.get(source, -1):
            return
        catalog = _fingerprint(tables)
        parked = epoch.parked
        if parked and catalog != epoch.catalog:
            log, parked = log.unionByName(spark.read.schema(LOG_SCHEMA).parquet(*parked)), []
        staged = f"{self.root.rstrip('/')}/staged/batch={_folder(batch_id, source)}"
        events = Batch.of(log, self.excluded, f"{staged}/log")
        try:
            present = self._tables_in(events, tables)
            with ThreadPoolExecutor(max(1, self.tables_at_once)) as pool:
                mine = {n: events.table(of) for n, of in present.items()}
                outcomes = dict(zip(mine, pool.map(lambda n: self._apply_table(mine[n], tables[n], n, batch_id, source), mine)))
            _raise_if_all_broke(outcomes)
            refused = _staged(self._refused(events, present, outcomes, tables, batch_id), f"{staged}/refused")
            waits = F.col("reason").isin(*WAITING) if callable(self.catalog) else F.lit(False)
            if callable(self.catalog):
                folder = f"{self.root.rstrip('/')}/parked/batch={_folder(batch_id, source)}"
                held = refused.filter(waits)
                if not held.isEmpty():
                    _as_log(held).write.mode("overwrite").parquet(folder)
                    parked = [*parked, folder]
            rejects.append_dead_letters(refused.filter(~waits), self.dead_letter_path, _folder(batch_id, source))
            counts = [row for outcome in outcomes.values() if isinstance(outcome, Applied) for row in outcome.counts]
            self._record(spark, counts, batch_id, source, time.time() - started)
            self._record_failures(spark, outcomes, batch_id, source)
            if self.sink is None:
                done = [n for n, outcome in outcomes.items() if isinstance(outcome, Applied) and tables[n].keys]
                versions = {n: self.replica(n, tables[n]).version(spark) for n in done}
                self._publish(spark, Epoch(
                    epoch.number + 1, {**epoch.tables, **versions}, {**epoch.applied, source: batch_id}, parked, catalog
                ))
                if self.keep_versions:
                    for name in done:
                        self.replica(name, tables[name]).expire(spark, self.keep_versions)
                    for number in range(epoch.number + 1 - self.keep_versions, -1, -1):
                        if not files.exists(spark, f"{self._epoch_path}/{number}.json"):
                            break
                        files.delete(spark, f"{self._epoch_path}/{number}.json")
        finally:
            events.unpersist()
            files.delete(spark, staged)

    def _refused(
        self, events: Batch, present: dict[str, Present], outcomes: dict[str, Any], tables: Catalog, batch_id: int
    ) -> DataFrame:
        """All events that were not applied: those that cannot be, in one pass, split keys, and failed tables' whole batches.

        A table whose events were all counted as applied has none, so its events are not validated again.
        """
        whole = [
            present[n] for n, outcome in outcomes.items()
            if isinstance(outcome, Applied) and outcome.batch == batch_id and sum(c for _, _, c in outcome.counts) == present[n].events
        ]
        refused = rejects.rejected(events.without(whole), tables, self.policy)
        broken = {n: outcome for n, outcome in outcomes.items() if isinstance(outcome, SinkFailure)}
        if broken:
            lower = [tables[n].table.lower() for n in broken]
            refused = refused.filter(F.col("source_table").isNull() | ~F.lower("source_table").isin(lower))
        for name, outcome in outcomes.items():
            table = tables[name]
            if name in broken:
                refused = refused.unionByName(rejects.sink_failure(table_events(events.table(present[name]), table), outcome.reason))
            elif outcome.split:
                typed = typed_events(events.table(present[name]), table, self.policy)
                refused = refused.unionByName(rejects.split_keys(typed, fold(typed, table, self.order), table))
        return refused

    def _tables_in(self, events: Batch, tables: Catalog) -> dict[str, Present]:
        """The catalog tables that events name; the driver sees at most one row per table."""
        every = events.topics.filter("source_table IS NOT NULL")
        if events.strays is not None:
            strays = events.strays.groupBy("source_table").count()
            every = every.unionByName(strays.withColumn("topic", F.lit(None).cast("string")))
        name = F.lower("source_table")
        by_name = {known.lower(): known for known in tables}
        found = (
            every.filter(name.isin(list(by_name)))
            .groupBy(name.alias("name"))
            .agg(F.min("topic").alias("first"), F.max("topic").alias("last"), F.sum("count").alias("events"))
            .collect()
        )
        return {by_name[row["name"]]: Present(**row.asDict()) for row in sorted(found, key=lambda row: row["name"])}

    def _apply_table(self, events: DataFrame, table: TableSchema, name: str, batch_id: int, source: str) -> SinkFailure | Applied:
        """Apply one table's events; gives the number applied by operation, at most three rows.

        A replica is written in one pass, which also counts. A table that fails for whatever reason does not stop the others.
        A sink that skips has applied this very batch before, in an attempt that may have ended before
        its counts were recorded, so they are given again: the same numbers, in the same place.
        """
        if not table.keys:
            return Applied([], False)
        changes = fold(typed_events(events, table, self.policy), table, self.order)
        try:
            if self.sink is None:
                return _applied(name, self.replica(name, table).append(changes, batch_id, source))
            return self._send(changes, table, name, batch_id, source)
        except SinkFailure as failure:
            return failure
        except Exception as error:
            return SinkFailure(rejects.SINK_ERROR, error, 0, named=False)

    def _send(self, changes: DataFrame, table: TableSchema, name: str, batch_id: int, source: str) -> Applied:
        """Give a table's change rows to the sink."""
        changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
        # Keys whose order the log does not give are rejected; the others go on.
        sound = keys_in_one_place(changes) if self.order == LOG_ORDER else changes
        try:
            deadlocks = self.sink(table, sound, batch_id, source)
            split = self.order == LOG_ORDER and not keys_in_two_places(changes).isEmpty()
            return Applied([(name, row.operation, row.events) for row in operation_counts(sound).collect()], split, int(deadlocks or 0), batch_id)
        finally:
            changes.unpersist()

    def _record(self, spark: SparkSession, counts: list[Counted], batch_id: int, source: str, seconds: float) -> None:
        """Number of applied events by table and operation, with the seconds of the batch."""
        names = BATCH_STATISTICS.names
        columns = list(zip(*[(batch_id, *counted, seconds) for counted in counts])) or [()] * len(names)
        frame = pa.table([pa.array(c, f.type) for c, f in zip(columns, BATCH_STATISTICS)], schema=BATCH_STATISTICS)
        rows = spark.createDataFrame(frame).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.statistics_path}/batch={_folder(batch_id, source)}")

    def _record_failures(self, spark: SparkSession, outcomes: dict[str, SinkFailure | Applied], batch_id: int, source: str) -> None:
        """Failed attempts by table and kind: every deadlock counts, also of a batch that went through in the end."""
        rows = []
        for name, outcome in outcomes.items():
            if outcome.deadlocks:
                rows.append((batch_id, name, DEADLOCK, outcome.deadlocks))
            if isinstance(outcome, SinkFailure):
                rows.append((batch_id, name, outcome.reason, 1))
        if rows:
            frame = spark.createDataFrame(rows, "batch_id long, source_table string, error_type string, attempts long").coalesce(1)
            frame.write.mode("overwrite").parquet(f"{self.failures_path}/batch={_folder(batch_id, source)}")

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Run on a stream. Without an interval it takes all that is there and stops."""
        source: list[str] = []

        def apply(rows: DataFrame, batch: int) -> None:
            source[:] = source or [source_of(rows.sparkSession, checkpoint)]
            self.apply_batch(rows, batch, source[0])

        writer = stream.writeStream.foreachBatch(apply)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def rebuild(self, log: DataFrame) -> dict[str, int]:
        """Replace every replica by what the retained log gives; returns the new versions, which become visible together.

        Streams go on from where they are. What they still bring of the log's events changes nothing.
        """
        spark = log.sparkSession
        versions, tables = {}, self._tables(spark)
        for name, table in tables.items():
            if table.keys:
                changes = replay.changes(log, table, self.policy, self.excluded, self.order)
                versions[name] = self.replica(name, table).replace(changes)
        epoch = self.epoch(spark)
        self._publish(spark, Epoch(epoch.number + 1, {**epoch.tables, **versions}, epoch.applied, epoch.parked, epoch.catalog))
        return versions

    def read(self, spark: SparkSession, name: str, epoch: Epoch | None = None) -> DataFrame:
        """Rows of a replica at an epoch, or else now. Tables read at one epoch have the same batches in them."""
        epoch = epoch or self.epoch(spark)
        return self.replica(name, self._tables(spark)[name]).read(spark, epoch.tables.get(name, -1))

    def parked(self, spark: SparkSession) -> DataFrame:
        """Log rows that wait for their table or column to appear in the catalog."""
        folders = self.epoch(spark).parked
        return spark.read.schema(LOG_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], LOG_SCHEMA)


def _fingerprint(tables: Catalog) -> str:
    """Changes when a table or column does."""
    return hashlib.sha256(repr(sorted(tables.items())).encode()).hexdigest()


def _staged(rows: DataFrame, folder: str) -> DataFrame:
    """Rows written once, to be read as often as needed by tasks that hold few of them at a time.

    A cached partition is one block, written and sent as a whole: of a log file it is a gigabyte and more of text, and
    a task keeps hundreds of megabytes of it beside the memory that Spark counts.
    """
    rows.write.mode("overwrite").option("maxRecordsPerFile", STAGED_ROWS).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _as_log(events: DataFrame) -> DataFrame:
    """Rejected events as the log rows they came from."""
    values = {"value": F.col("raw")}
    return events.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])


def _applied(name: str, counts: Counts) -> Applied:
    by_operation = {INSERT: counts.inserts, UPDATE: counts.updates, DELETE: counts.events - counts.inserts - counts.updates}
    return Applied([(name, operation, n) for operation, n in by_operation.items() if n], counts.split > 0, batch=counts.batch)


def _raise_if_all_broke(outcomes: dict[str, SinkFailure | Applied]) -> None:
    """If no table of several took the batch, for reasons no sink named, it is the cluster: the batch should come again."""
    broken = [o for o in outcomes.values() if isinstance(o, SinkFailure) and o.reason == rejects.SINK_ERROR and not o.named]
    if broken and len(broken) == len(outcomes):
        raise broken[0]


def _folder(batch_id: int, source: str) -> str:
    return f"{source}-{batch_id}" if source else str(batch_id)


def source_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; it lasts as long as the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
