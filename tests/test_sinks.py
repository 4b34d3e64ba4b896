"""Database sink statements, retries, and what a failed sink leaves behind."""

import duckdb
import pytest
from helpers import PAIRS, event, interpret, log_frame
from test_fold import as_dict, as_log, random_events

from tidemark.functions.convert import Policy
from tidemark.operators import replay
from tidemark.operators.rejects import DEADLOCK_EXHAUSTED, SINK_ERROR
from tidemark.sources import changelog
from tidemark.streaming import jdbc
from tidemark.streaming.replicate import Replication
from tidemark.streaming.retry import SinkFailure, with_retry


def test_only_deadlocks_are_retried():
    pauses, calls = [], []

    def fail(text, times):
        def call():
            calls.append(1)
            if len(calls) <= times:
                raise RuntimeError(text)

        calls.clear()
        pauses.clear()
        return call

    assert with_retry(fail("ERROR 40P01: deadlock detected", 2), "postgres", pause=pauses.append) == 2
    assert pauses == [1.0, 2.0]
    with pytest.raises(SinkFailure) as failed:
        with_retry(fail("Error 1213: Deadlock found", 9), "mysql", pause=pauses.append)
    assert (failed.value.reason, len(calls), pauses) == (DEADLOCK_EXHAUSTED, 4, [1.0, 2.0, 4.0])
    with pytest.raises(SinkFailure) as failed:
        with_retry(fail("deadlock detected", 9), "mysql", pause=pauses.append)
    assert (failed.value.reason, len(calls), pauses) == (SINK_ERROR, 1, [])


def test_mysql_statements():
    record, update, insert = jdbc.merge_statements(PAIRS, "pairs_changes", 3, "mysql")
    assert record == "INSERT INTO `applied_batches` (`table_name`, `source`, `batch_id`) VALUES ('pairs', '', 3)"
    assert update.startswith("UPDATE `pairs` t JOIN `pairs_changes` s ON t.`a` = s.`a` AND t.`b` = s.`b` SET t.`x` =")
    assert "NOT EXISTS" in insert and insert.startswith("INSERT INTO `pairs` (`a`, `b`, `x`, `y`, `deleted_at`)")


def test_statements_apply_batches_once(spark):
    """The postgres statements, run over staged rows, against the plain interpreter."""
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    db.execute("CREATE TABLE pairs (a INT, b INT, x INT, y VARCHAR, deleted_at TIMESTAMPTZ, PRIMARY KEY (a, b))")
    db.execute(jdbc.batches_table("postgres"))
    sink = jdbc.DatabaseSink(db.cursor, "", Policy())
    events = random_events(21, 90)
    for batch, start in enumerate((0, 30, 60)):
        assert not sink.already_applied(PAIRS, batch)
        part = replay.changes(as_log(spark, events[start : start + 30], start), PAIRS)
        stage = jdbc.staged(part, PAIRS, Policy()).toArrow()
        db.execute("CREATE OR REPLACE TABLE pairs_changes AS SELECT * FROM stage")
        statements = jdbc.merge_statements(PAIRS, "pairs_changes", batch, "postgres")
        transact(db, statements)
        with pytest.raises(duckdb.ConstraintException):
            transact(db, statements)
        assert sink.already_applied(PAIRS, batch)
        assert not sink.already_applied(PAIRS, 0, "a new checkpoint")
    rows = db.execute("SELECT a, b, x, y, epoch_ms(deleted_at) FROM pairs").fetchall()
    assert {(a, b): {"x": x, "y": y, "deleted": d} for a, b, x, y, d in rows} == interpret(events)


def transact(db, statements):
    db.execute("BEGIN")
    try:
        for statement in statements:
            db.execute(statement)
        db.execute("COMMIT")
    except Exception:
        db.execute("ROLLBACK")
        raise


def test_transaction_is_rolled_back_on_failure():
    seen = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, sql):
            seen.append(sql)
            if sql == "second":
                raise RuntimeError("no")

        def commit(self):
            seen.append("commit")

        def rollback(self):
            seen.append("rollback")

        def close(self):
            seen.append("close")

    sink = jdbc.DatabaseSink(Connection, "", Policy())
    with pytest.raises(RuntimeError):
        sink.transact(["first", "second", "third"])
    assert seen == ["first", "second", "rollback", "close"]


def test_a_failed_sink_dead_letters_its_whole_batch(spark, tmp_path):
    def refuse(table, changes, batch_id, source):
        raise SinkFailure(DEADLOCK_EXHAUSTED, RuntimeError("deadlock"), 4)

    job = Replication(str(tmp_path), {"pairs": PAIRS}, sink=refuse)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=1)) for i in range(5)] + [("pairs", 0, 5, "{bad"), ("other", 0, 0, "{}")]
    job.apply_batch(log_frame(spark, rows), 0)
    entries = spark.read.json(job.dead_letter_path).groupBy("error", "stage").count().collect()
    assert {(r.error, r.stage): r["count"] for r in entries} == {
        ("deadlock_exhausted", "sink"): 6,
        ("unknown_table", "parse"): 1,
    }
    assert spark.read.parquet(job.statistics_path).count() == 0


def test_keys_from_two_log_partitions_are_rejected_and_the_others_applied(spark, tmp_path):
    job = Replication(str(tmp_path), {"pairs": PAIRS}, buckets=2)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=1)) for i in range(5)] + [("pairs", 1, 0, event("u", 2, a=3, b=1, x=1))]
    job.apply_batch(log_frame(spark, rows), 0)
    assert {r.a for r in job.read(spark, "pairs").collect()} == {0, 1, 2, 4}
    entries = spark.read.json(job.dead_letter_path).select("error", "partition", "offset").collect()
    assert {tuple(r) for r in entries} == {("split_key", 0, 3), ("split_key", 1, 0)}
    assert {(r.operation, r.events) for r in spark.read.parquet(job.statistics_path).collect()} == {("INSERT", 4)}


def test_old_versions_expire_after_a_batch(spark, tmp_path):
    job = Replication(str(tmp_path), {"pairs": PAIRS}, buckets=2, keep_versions=1)
    for i in range(3):
        job.apply_batch(log_frame(spark, [("pairs", 0, i, event("c", 1, a=i, b=1))]), i)
    assert job.replica("pairs").expired(spark, keep=1) == []
    assert job.read(spark, "pairs").count() == 3


def test_a_batch_records_its_statistics(spark, tmp_path):
    job = Replication(str(tmp_path), {"pairs": PAIRS}, buckets=2)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=1)) for i in range(5)] + [("pairs", 0, 9, event("d", 2, a=1, b=1))]
    for _ in range(2):
        job.apply_batch(log_frame(spark, rows), 0)
    found = {(r.operation, r.events) for r in spark.read.parquet(job.statistics_path).collect()}
    assert found == {("INSERT", 5), ("DELETE", 1)}
    assert job.read(spark, "pairs").count() == 5


def test_stream_replay_and_a_new_stream_agree(spark, tmp_path):
    events = random_events(31, 90)
    path = str(tmp_path / "log")
    job = Replication(str(tmp_path / "target"), {"pairs": PAIRS}, buckets=4)

    def drain(job, checkpoint):
        job.start(changelog.stream_files(spark, path), str(tmp_path / checkpoint)).awaitTermination()
        return as_dict(job.read(spark, "pairs"))

    for start in (0, 30):
        as_log(spark, events[start : start + 30], start).coalesce(1).write.mode("append").parquet(path)
        assert drain(job, "first") == interpret(events[: start + 30])
    job.rebuild(changelog.read_files(spark, path))
    assert as_dict(job.read(spark, "pairs")) == interpret(events[:60])
    # The same checkpoint goes on, and a new one takes up where it ends.
    as_log(spark, events[60:75], 60).coalesce(1).write.mode("append").parquet(path)
    assert drain(job, "first") == interpret(events[:75])
    path = str(tmp_path / "rest")
    as_log(spark, events[75:], 75).write.parquet(path)
    assert drain(job, "second") == interpret(events)
    assert len(job.replica("pairs").applied(spark)) == 2
    sources = {row.batch.rsplit("-", 1)[0] for row in spark.read.parquet(job.statistics_path).select("batch").collect()}
    assert sources == set(job.replica("pairs").applied(spark))


def test_every_attempt_is_recorded(spark, tmp_path):
    """A database that deadlocks twice, one that never ends to, and one that cannot be reached."""
    class Database(jdbc.DatabaseSink):
        def __init__(self, errors):
            super().__init__(None, "", Policy())
            self.errors, self.done = errors, []

        def already_applied(self, *_):
            return False

        def stage(self, rows, name):
            if self.errors and self.errors[0] == "unreachable":
                raise ConnectionError(self.errors[0])

        def transact(self, statements):
            if self.errors:
                raise RuntimeError(self.errors.pop(0))
            self.done.append(statements)

    seen = {}
    for name, errors in (("twice", ["40P01"] * 2), ("always", ["deadlock detected"] * 9), ("down", ["unreachable"])):
        sink = Database(errors)
        job = Replication(str(tmp_path / name), {"pairs": PAIRS}, sink=sink)
        job.apply_batch(log_frame(spark, [("pairs", 0, 0, event("c", 1, a=1, b=1))]), 0)
        seen[name] = {(r.error_type, r.attempts) for r in spark.read.parquet(job.failures_path).collect()}
        assert len(sink.done) == (name == "twice")
        assert spark.read.json(f"{job.dead_letter_path}/batch=0").count() == 1 if name != "twice" else True
    assert seen == {"twice": {("deadlock", 2)}, "always": {("deadlock", 4), ("deadlock_exhausted", 1)}, "down": {("sink_error", 1)}}


def test_staging_columns_are_free_and_values_are_cast(spark):
    from tidemark.functions.types import ColumnSpec, TableSchema

    table = TableSchema("t", (ColumnSpec("id", "int", 1, pk_pos=1), ColumnSpec("status", "json", 2), ColumnSpec("status_new", "time", 3)))
    row = [("t", 0, 0, event("c", 1, id=1, status={"a": 1}, status_new=1000))]
    staged = jdbc.staged(replay.changes(log_frame(spark, row), table), table, Policy())
    assert len(set(staged.columns)) == len(staged.columns)
    assert staged.first()["status_new"] == "00:00:01"
    _, update, insert = jdbc.merge_statements(table, "t_changes", 0, "postgres")
    assert 'CAST(s."status" AS JSONB)' in update and 'CAST(s."__new_status_new" AS TIME)' in insert
    assert "AS JSON)" in jdbc.merge_statements(table, "t_changes", 0, "mysql")[2]
