"""What becomes visible when, tables that break, and catalogs that come late."""

from helpers import PAIRS, event, log_frame
from pyspark.sql import functions as F

from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.operators import rejects, replay
from tidemark.streaming import replicate
from tidemark.streaming.lake import ReplicaTable
from tidemark.streaming.replicate import Replication

NOTES = TableSchema("notes", (ColumnSpec("id", "int", 1, pk_pos=1), ColumnSpec("text", "varchar", 2)))
BOTH = {"pairs": PAIRS, "notes": NOTES}


def rows_of(first, n):
    pairs = [("pairs", 0, first + i, event("c", 1, a=first + i, b=0)) for i in range(n)]
    return pairs + [("notes", 0, first + i, event("c", 1, id=first + i, text="t")) for i in range(n)]


def counts(spark, job, epoch=None):
    return tuple(job.read(spark, name, epoch).count() for name in BOTH)


def test_tables_become_visible_together(spark, tmp_path):
    job = Replication(str(tmp_path), BOTH)
    job.apply_batch(log_frame(spark, rows_of(0, 3)), 0)
    assert counts(spark, job) == (3, 3)
    late = log_frame(spark, rows_of(10, 2))
    # The driver ends after the first of two tables.
    job.replica("notes").append(replay.changes(late, NOTES), 1)
    assert job.replica("notes").read(spark).count() == 5
    assert counts(spark, job) == (3, 3)
    job.apply_batch(late, 1)
    assert counts(spark, job) == (5, 5)
    assert counts(spark, job, job.epoch(spark, 0)) == (3, 3)
    job.apply_batch(late, 1)
    assert job.epoch(spark).number == 1


def test_a_rebuild_becomes_visible_at_once_and_loses_to_no_stream(spark, tmp_path):
    job = Replication(str(tmp_path), BOTH)
    job.apply_batch(log_frame(spark, rows_of(0, 3)), 0)
    ahead = [*rows_of(0, 6), ("pairs", 0, 50, event("u", 2, a=1, b=0, x=9))]
    job.rebuild(log_frame(spark, ahead))
    assert counts(spark, job) == (6, 6)
    # The stream is behind the rebuild and brings an older value.
    job.apply_batch(log_frame(spark, [("pairs", 0, 40, event("u", 2, a=1, b=0, x=1))]), 1)
    assert job.read(spark, "pairs").filter("a = 1").first().x == 9


def test_a_broken_table_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    job = Replication(str(tmp_path), BOTH)
    append = ReplicaTable.append

    def fails(self, *args, **kwargs):
        if self.table.table == "notes":
            raise RuntimeError("no space")
        return append(self, *args, **kwargs)

    monkeypatch.setattr(ReplicaTable, "append", fails)
    job.apply_batch(log_frame(spark, rows_of(0, 3)), 0)
    assert counts(spark, job) == (3, 0)
    letters = spark.read.json(job.dead_letter_path).groupBy("error", F.col("event.__source_table").alias("t")).count().collect()
    assert [tuple(r) for r in letters] == [("sink_error", "notes", 3)]


def test_if_every_table_breaks_the_batch_comes_again(spark, tmp_path, monkeypatch):
    job = Replication(str(tmp_path), BOTH)
    append = ReplicaTable.append
    monkeypatch.setattr(ReplicaTable, "append", lambda *a, **k: 1 / 0)
    try:
        job.apply_batch(log_frame(spark, rows_of(0, 3)), 0)
        raise AssertionError("it should have failed")
    except Exception as error:
        assert "division" in str(error)
    monkeypatch.setattr(ReplicaTable, "append", append)
    job.apply_batch(log_frame(spark, rows_of(0, 3)), 0)
    assert counts(spark, job) == (3, 3)


def test_events_wait_for_their_table_and_column(spark, tmp_path):
    now = {"pairs": PAIRS}
    job = Replication(str(tmp_path), lambda _: dict(now))
    wider = TableSchema("pairs", (*PAIRS.columns, ColumnSpec("z", "int", 9)))
    rows = [*rows_of(0, 2), ("pairs", 0, 7, event("u", 2, a=1, b=0, z=5)), ("pairs", 0, 8, "{bad")]
    job.apply_batch(log_frame(spark, rows), 0)
    assert job.read(spark, "pairs").count() == 2
    assert sorted((r.topic, r.offset) for r in job.parked(spark).collect()) == [
        ("src.shop.notes", 0), ("src.shop.notes", 1), ("src.shop.pairs", 7)]
    # A batch with the same catalog leaves them where they are.
    job.apply_batch(log_frame(spark, rows_of(20, 1)[:1]), 1)
    assert job.parked(spark).count() == 3
    now.update(BOTH)
    job.apply_batch(log_frame(spark, rows_of(30, 1)), 2)
    assert job.read(spark, "notes").count() == 3
    assert [r.offset for r in job.parked(spark).collect()] == [7]
    now["pairs"] = wider
    # A later event of the key has come meanwhile; the parked one still loses to none but later ones.
    job.apply_batch(log_frame(spark, [("pairs", 0, 40, event("u", 3, a=1, b=0, x=1))]), 3)
    assert job.parked(spark).count() == 0
    found = job.read(spark, "pairs").filter("a = 1").first()
    assert (found.x, found.z) == (1, 5)
    assert {r.error for r in spark.read.json(job.dead_letter_path).collect()} == {"parse_error"}


def test_a_table_that_took_all_its_events_is_not_validated_again(spark, tmp_path, monkeypatch):
    given, plans, rejected = [], [], rejects.rejected

    def seen(events, *others):
        given.append({(r.source_table, r.offset) for r in events.collect()})
        plans.append(events._jdf.queryExecution().executedPlan().toString())
        return rejected(events, *others)

    monkeypatch.setattr(rejects, "rejected", seen)
    job = Replication(str(tmp_path), BOTH)
    bad = [("pairs", 0, 50, event("c", 1, a="many", b=0)), ("nosuch", 0, 51, "{}"), ("src.notes", 0, 52, "{bad")]
    # Spelled in two ways, and the other table refuses one of its events.
    notes = [("NOTES", 0, 60, event("c", 1, id=60))]
    job.apply_batch(log_frame(spark, rows_of(0, 3) + bad + notes), 0)
    assert counts(spark, job) == (3, 4)
    assert given == [{("pairs", 0), ("pairs", 1), ("pairs", 2), ("pairs", 50), ("nosuch", 51), (None, 52)}]
    assert "InMemoryRelation" in plans[0] and "Sort [" not in plans[0]
    letters = {(r.offset, r.error) for r in spark.read.json(job.dead_letter_path).collect()}
    assert letters == {(50, "cast_error"), (51, "unknown_table"), (52, "parse_error")}
    job.apply_batch(log_frame(spark, rows_of(10, 2)), 1)
    assert given[1] == set() and counts(spark, job) == (5, 6)


def test_what_a_batch_caches_is_not_the_parsed_copy(spark, tmp_path, monkeypatch):
    cached, kind = [], type(spark.range(1))
    persist = kind.persist

    def seen(frame, *level):
        if "names" in frame.columns:
            cached.append(sorted(r.offset for r in frame.collect()))
        return persist(frame, *level)

    monkeypatch.setattr(kind, "persist", seen)
    job = Replication(str(tmp_path), BOTH)
    # A topic of two parts names no table, so its events are routed by what they say.
    told = [("src.all", 0, 90 + i, event("c", 1, __source_table=table, **row)) for i, (table, row) in enumerate(
        [("pairs", {"a": 90, "b": 0}), ("NOTES", {"id": 91}), ("nosuch", {"id": 92})])]
    job.apply_batch(log_frame(spark, rows_of(0, 3) + told), 0)
    assert counts(spark, job) == (4, 4)
    assert cached == [[90, 91, 92]]
    letters = {(r.offset, r.error) for r in spark.read.json(job.dead_letter_path).collect()}
    assert letters == {(92, "unknown_table")}


def _watch_persist(spark, monkeypatch):
    """Columns of every frame that is cached."""
    cached, kind = [], type(spark.range(1))
    persist = kind.persist

    def seen(frame, *level):
        cached.append(set(frame.columns))
        return persist(frame, *level)

    monkeypatch.setattr(kind, "persist", seen)
    return cached


def test_a_batch_is_read_from_files_cut_by_rows(spark, tmp_path, monkeypatch):
    cached, files, rejected = _watch_persist(spark, monkeypatch), [], rejects.rejected

    def seen(events, *others):
        files.extend(spark.read.parquet(str(p)).count() for p in tmp_path.glob("staged/*/log/*.parquet"))
        return rejected(events, *others)

    monkeypatch.setattr(rejects, "rejected", seen)
    monkeypatch.setattr(replicate, "STAGED_ROWS", 2, raising=False)
    job = Replication(str(tmp_path), BOTH)
    job.apply_batch(log_frame(spark, [*rows_of(0, 20), ("pairs", 0, 50, "{bad")]), 0)
    assert counts(spark, job) == (20, 20)
    assert sum(files) == 41 and max(files) == 2
    assert not any("value" in columns for columns in cached)
    assert not list(tmp_path.glob("staged/*"))


def test_refused_events_are_not_cached(spark, tmp_path, monkeypatch):
    cached, now = _watch_persist(spark, monkeypatch), {"pairs": PAIRS}
    job = Replication(str(tmp_path), lambda _: dict(now))
    job.apply_batch(log_frame(spark, [*rows_of(0, 9), ("pairs", 0, 50, "{bad")]), 0)
    assert job.parked(spark).count() == 9
    assert [r.offset for r in spark.read.json(job.dead_letter_path).collect()] == [50]
    assert not any("reason" in columns for columns in cached)
    now.update(BOTH)
    job.apply_batch(log_frame(spark, rows_of(20, 1)), 1)
    assert (job.parked(spark).count(), counts(spark, job)) == (0, (10, 10))
    assert not list(tmp_path.glob("staged/*"))
