"""Replicas as base and deltas: any arrival, compaction, growth, lost work."""

import random

import pytest
from helpers import PAIRS, event, interpret, log_frame
from test_fold import as_dict, as_log, random_events

from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.operators import replay
from tidemark.streaming import files
from tidemark.streaming.lake import BUCKET, PLACE, VERSION, Bucket, ReplicaTable, SplitKeyError, _joined, place_of


def changes(spark, events, first=0):
    return replay.changes(as_log(spark, events, first), PAIRS)


def replica(path, **settings):
    return ReplicaTable(str(path / "r"), PAIRS, **settings)


def opened(frame):
    """Data files a plan reads."""
    return {f.split("/data/")[1] for f in frame.inputFiles()}


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
@pytest.mark.parametrize("compacted", [(), (1,), (0, 2)])
def test_batches_accumulate(spark, tmp_path, broadcast_bytes, compacted):
    table = replica(tmp_path, buckets=4, broadcast_bytes=broadcast_bytes, compact_share=None)
    assert table.read(spark).count() == 0
    events = random_events(11, 90)
    for batch, start in enumerate((0, 30, 60)):
        assert table.apply(changes(spark, events[start : start + 30], start), batch)
        assert as_dict(table.read(spark)) == interpret(events[: start + 30])
        if batch in compacted:
            table.compact(spark)
            assert as_dict(table.read(spark)) == interpret(events[: start + 30])


@pytest.mark.parametrize("seed", range(3))
def test_any_split_in_any_order_with_repeats(spark, tmp_path, seed):
    """Slices of the log arrive shuffled, some events twice; compaction comes at any moment."""
    pick = random.Random(seed)
    events = random_events(100 + seed, 80)
    numbered = list(enumerate(events))
    slices = [[] for _ in range(5)]
    for item in numbered:
        slices[pick.randrange(5)].append(item)
    for part in slices:
        part += pick.sample(numbered, 8)
    table = replica(tmp_path, buckets=pick.choice([1, 4]), compact_share=None, bucket_bytes=pick.choice([3000, 1 << 30]))
    for batch, part in enumerate(slices):
        rows = [("pairs", key[0] % 3, i, event(op, ts, a=key[0], b=key[1], **payload))
                for i, (key, op, payload, ts) in part]
        table.apply(replay.changes(log_frame(spark, rows), PAIRS), batch)
        if pick.random() < 0.4:
            table.compact(spark)
    assert as_dict(table.read(spark)) == interpret(events)


def test_an_older_offset_never_overwrites(spark, tmp_path):
    table = replica(tmp_path)
    rows = [("pairs", 0, 10, event("c", 2, a=1, b=1, x=1, y="new")), ("pairs", 0, 5, event("c", 1, a=1, b=1, x=0, y="old"))]
    for batch, row in enumerate(rows):
        table.apply(replay.changes(log_frame(spark, [row]), PAIRS), batch)
    assert as_dict(table.read(spark)) == {(1, 1): {"x": 1, "y": "new", "deleted": None}}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = replica(tmp_path)
    events = random_events(12, 40)
    assert table.apply(changes(spark, events), 0)
    before = table.manifest(spark)
    assert not table.apply(changes(spark, events), 0)
    assert table.append(changes(spark, events), 0) == before.applied[""]
    assert table.manifest(spark) == before


def test_a_batch_opens_no_base_file(spark, tmp_path):
    table = replica(tmp_path, buckets=8, compact_share=None)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=0, x=i)) for i in range(400)]
    table.replace(replay.changes(log_frame(spark, rows), PAIRS))
    before = table.manifest(spark)
    reads = []
    read = table._base
    table._base = lambda *given: reads.append(given) or read(*given)
    table.apply(replay.changes(log_frame(spark, [("pairs", 0, 900, event("u", 2, a=7, b=0, x=-1))]), PAIRS), 0)
    assert reads == []
    after = table.manifest(spark)
    assert after.buckets == before.buckets and list(after.deltas) == [after.version]
    got = as_dict(table.read(spark))
    assert got[(7, 0)]["x"] == -1 and len(got) == 400


def test_only_buckets_with_many_changes_are_compacted(spark, tmp_path):
    table = replica(tmp_path, buckets=8, compact_share=None)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=0, x=i)) for i in range(400)]
    table.replace(replay.changes(log_frame(spark, rows), PAIRS))
    before = table.manifest(spark)
    place = {r.a: r.p >> 29 for r in table.read(spark).select("a", place_of(["a", "b"]).alias("p")).collect()}
    mine = [a for a in range(400) if place[a] == 3]
    other = next(a for a in range(400) if place[a] == 5)
    update = [("pairs", 0, 1000 + a, event("u", 2, a=a, b=0, x=-a)) for a in [*mine, other]]
    table.apply(replay.changes(log_frame(spark, update), PAIRS), 0)
    assert table.compact(spark, share=0.1) == ["3_3"]
    after = table.manifest(spark)
    assert [b for b in after.buckets if b.version != before.version] == [b for b in after.buckets if b.prefix == 3]
    assert after.deltas  # bucket 5 still needs it
    got = as_dict(table.read(spark))
    assert all(got[(a, 0)]["x"] == (-a if a in [*mine, other] else a) for a in range(400))
    assert table.compact(spark) == ["3_5"]
    assert table.manifest(spark).deltas == {}
    assert as_dict(table.read(spark)) == got


def test_a_bucket_that_grows_is_split_alone(spark, tmp_path):
    table = replica(tmp_path, buckets=2, compact_share=None, bucket_bytes=1 << 40)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=0, x=i, y="y" * 50)) for i in range(600)]
    table.replace(replay.changes(log_frame(spark, rows), PAIRS))
    before, whole = table.manifest(spark), as_dict(table.read(spark))
    place = {r.a: r.p >> 31 for r in table.read(spark).select("a", place_of(["a", "b"]).alias("p")).collect()}
    update = [("pairs", 0, 1000 + a, event("u", 2, a=a, b=0, x=a)) for a in range(600) if place[a] == 1]
    table.apply(replay.changes(log_frame(spark, update), PAIRS), 0)
    table.bucket_bytes = before.buckets[1].size // 2
    written = table.compact(spark)
    assert len(written) >= 2 and all(name.split("_")[0] != "1" for name in written)
    after = table.manifest(spark)
    assert after.buckets[0].version == before.version and after.buckets[0].depth == 1
    assert as_dict(table.read(spark)) == whole
    # A change of the whole bucket, and of one with new keys, goes where it belongs.
    more = [("pairs", 0, 5000 + a, event("c", 3, a=a, b=0, x=0)) for a in range(500, 700)]
    table.apply(replay.changes(log_frame(spark, more), PAIRS), 1)
    table.compact(spark)
    got = as_dict(table.read(spark))
    assert len(got) == 700 and all(got[(a, 0)]["x"] == 0 for a in range(500, 700))
    stored = table._base(spark, [b for b in table.manifest(spark).buckets if b.version is not None])
    assert stored.count() == 700


def test_compaction_by_itself(spark, tmp_path):
    table = replica(tmp_path, broadcast_bytes=0, compact_share=0.5)
    events = random_events(22, 60)
    for batch, start in enumerate((0, 30)):
        table.apply(changes(spark, events[start : start + 30], start), batch)
    assert table.manifest(spark).deltas == {}
    assert as_dict(table.read(spark)) == interpret(events)
    many = ReplicaTable(str(tmp_path / "many"), PAIRS, most_deltas=2)
    for batch, start in enumerate((0, 15, 30, 45)):
        many.apply(changes(spark, events[start : start + 15], start), batch)
    assert len(many.manifest(spark).deltas) <= 2
    assert as_dict(many.read(spark)) == interpret(events)


def test_a_partition_by_key_lies_in_one_bucket(spark):
    rows = spark.range(5000).selectExpr("id AS a", "id % 7 AS b")
    where = rows.repartition(16, "a", "b").selectExpr("spark_partition_id() AS p", "*").select("p", place_of(["a", "b"]).alias(PLACE))
    found = where.selectExpr("p", f"shiftright({PLACE}, 28) AS bucket").distinct().groupBy("p").count().collect()
    assert all(r["count"] == 1 for r in found)


def test_buckets_join_to_the_fewest():
    assert _joined([Bucket(2, i) for i in range(4)]) == [Bucket(0, 0)]
    assert _joined([Bucket(2, 1), Bucket(2, 2), Bucket(3, 0), Bucket(3, 1)]) == [Bucket(1, 0), Bucket(2, 2)]


def test_an_unfinished_batch_is_invisible_and_can_be_repeated(spark, tmp_path):
    table = replica(tmp_path)
    events = random_events(13, 60)
    table.apply(changes(spark, events[:30]), 0)
    # Rows of the next batch were written, then the job died before its list.
    half = table._storable(changes(spark, events[30:], 30))
    half.write.parquet(f"{tmp_path}/r/data/{VERSION}=1/{BUCKET}=delta")
    assert as_dict(table.read(spark)) == interpret(events[:30])
    assert table.apply(changes(spark, events[30:], 30), 1)
    assert as_dict(table.read(spark)) == interpret(events)


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    table = replica(tmp_path)
    events = random_events(13, 60)
    table.apply(changes(spark, events[:30]), 0)
    state = table.manifest(spark)
    with pytest.raises(files.CommitConflict):
        table._commit(spark, state)
    assert table.manifest(spark) == state


def test_updates_wait_for_their_insert(spark, tmp_path):
    table = replica(tmp_path)
    rows = [("pairs", 0, 3, event("u", 1, a=1, b=1, x=1)), ("pairs", 0, 2, event("c", 1, a=1, b=1, x=0, y="y")),
            ("pairs", 0, 1, event("u", 1, a=1, b=1, y="before"))]
    table.apply(replay.changes(log_frame(spark, rows[:1]), PAIRS), 0)
    assert table.read(spark).count() == 0
    for batch, row in enumerate(rows[1:], 1):
        table.apply(replay.changes(log_frame(spark, [row]), PAIRS), batch)
    assert as_dict(table.read(spark)) == {(1, 1): {"x": 1, "y": "y", "deleted": None}}


def test_replay_replaces_all_rows(spark, tmp_path):
    table = replica(tmp_path, buckets=4)
    events = random_events(14, 60)
    table.apply(changes(spark, events[:20]), 0)
    assert table.replace(changes(spark, events[:40])) == 1
    assert as_dict(table.read(spark)) == interpret(events[:40])
    assert not table.apply(changes(spark, events[:20]), 0)
    # What comes again, and what is new.
    assert table.apply(changes(spark, events[30:], 30), 1)
    assert as_dict(table.read(spark)) == interpret(events)
    assert as_dict(table.read(spark, 1)) == interpret(events[:40])


def test_a_snapshot_is_older_than_any_event(spark, tmp_path):
    table = replica(tmp_path, buckets=4)
    events = random_events(15, 60)
    table.overwrite(replay.rebuild(as_log(spark, events[:40]), PAIRS))
    assert as_dict(table.read(spark)) == interpret(events[:40])
    table.apply(changes(spark, events[40:], 40), 0)
    assert as_dict(table.read(spark)) == interpret(events)
    table.compact(spark)
    assert as_dict(table.read(spark)) == interpret(events)


def test_batches_of_two_sources_do_not_hide_each_other(spark, tmp_path):
    table = replica(tmp_path)
    events = random_events(17, 60)
    assert table.apply(changes(spark, events[:30]), 7, "one")
    assert table.apply(changes(spark, events[30:], 30), 0, "two")
    assert not table.apply(changes(spark, events[:30]), 7, "one")
    assert not table.apply(changes(spark, events[30:], 30), 0, "two")
    assert as_dict(table.read(spark)) == interpret(events)
    assert table.applied(spark) == {"one": 7, "two": 0}


def test_a_key_in_two_log_partitions(spark, tmp_path):
    table = replica(tmp_path)
    rows = [("pairs", 0, 0, event("c", 1, a=1, b=1)), ("pairs", 1, 0, event("u", 2, a=1, b=1, x=1))]
    with pytest.raises(SplitKeyError):
        table.apply(replay.changes(log_frame(spark, rows), PAIRS), 0)
    assert table.version(spark) is None
    # In batches of their own, neither is wrong; the key is found by what is stored, the topic included.
    other = [("pairs", 0, 0, event("c", 1, a=1, b=1)), ("src.other.pairs", 0, 1, event("u", 2, a=1, b=1, x=1))]
    for batch, row in enumerate(other):
        table.apply(replay.changes(log_frame(spark, [row]), PAIRS), batch)
    assert [tuple(r) for r in table.split_keys(spark).collect()] == [(1, 1)]


def test_counts_are_taken_while_writing(spark, tmp_path):
    table = replica(tmp_path)
    rows = [("pairs", 0, i, event("c", 1, a=i, b=1)) for i in range(5)] + [("pairs", 0, 9, event("u", 2, a=1, b=1, x=1))]
    rows += [("pairs", 0, 10, event("d", 2, a=2, b=1)), ("pairs", 1, 11, event("u", 2, a=4, b=1, x=1))]
    counts = table.append(replay.changes(log_frame(spark, rows), PAIRS), 3)
    assert (counts.batch, counts.events, counts.inserts, counts.updates, counts.split) == (3, 6, 4, 1, 1)
    assert {r.a for r in table.read(spark).collect()} == {0, 1, 2, 3}


def test_a_default_time_stays(spark, tmp_path):
    schema = TableSchema("pairs", (ColumnSpec("a", "int", 1, pk_pos=1), ColumnSpec("at", "datetime", 2, default="CURRENT_TIMESTAMP")))
    table = ReplicaTable(str(tmp_path / "r"), schema)
    for batch in range(2):
        row = [("pairs", 0, batch, event("c", 1, a=batch))]
        table.apply(replay.changes(log_frame(spark, row), schema), batch)
    first = {r.a: r.at for r in table.read(spark).collect()}
    table.compact(spark)
    assert {r.a: r.at for r in table.read(spark).collect()} == first and first[0] < first[1]


def test_old_versions_expire_and_the_current_one_stays(spark, tmp_path):
    table = replica(tmp_path, buckets=4, compact_share=None)
    events = random_events(15, 80)
    for batch, start in enumerate((0, 20, 40, 60)):
        table.apply(changes(spark, events[start : start + 20], start), batch)
        if batch % 2:
            table.compact(spark)
    assert table.expire(spark, keep=1) > 0
    assert table.expired(spark, keep=1) == []
    assert as_dict(table.read(spark)) == interpret(events)
    assert len(files.names(spark, f"{table.path}/data")) == 1
    with pytest.raises(ValueError):
        table.expire(spark, keep=0)


def test_small_deltas_are_sent_and_the_base_does_not_move(spark, tmp_path):
    table = replica(tmp_path, buckets=4, compact_share=None)
    events = random_events(16, 60)
    table.replace(changes(spark, events[:30]))
    table.apply(changes(spark, events[30:], 30), 0)

    def plan():
        return table.read(spark)._jdf.queryExecution().executedPlan().toString()

    assert "SortMergeJoin" not in plan() and "BroadcastHashJoin" in plan()
    table.broadcast_bytes = 0
    assert "Join" not in plan()
    table.compact(spark)
    assert "Exchange" not in plan() and "Join" not in plan()


@pytest.fixture
def small_tasks(spark):
    """Shuffles of some hundred bytes a task."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "300", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_few_buckets_are_replaced_by_many_tasks(spark, tmp_path, small_tasks):
    table = replica(tmp_path, buckets=2, compact_share=None)
    events = random_events(18, 120)
    table.replace(changes(spark, events))
    assert len(table.manifest(spark).buckets) == 2
    assert len(opened(table.changes(spark))) > 2
    assert as_dict(table.read(spark)) == interpret(events)


def test_a_large_bucket_is_compacted_by_many_tasks(spark, tmp_path, monkeypatch):
    table = replica(tmp_path, compact_share=None)
    events = random_events(19, 120)
    for batch, start in enumerate((0, 60)):
        table.apply(changes(spark, events[start : start + 60], start), batch)
    monkeypatch.setattr("tidemark.streaming.lake.TASK_BYTES", 1000)
    assert table.compact(spark) == ["0_0"]
    assert len(opened(table.changes(spark))) > 1
    assert as_dict(table.read(spark)) == interpret(events)
