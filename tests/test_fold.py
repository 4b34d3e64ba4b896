"""Fold and merge against a plain interpreter, in one batch and in several."""

import random

from helpers import PAIRS, event, interpret, log_frame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy
from tidemark.operators import fold, merge, replay


def random_events(seed, n, keys=12):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        key = (rng.randrange(keys), rng.randrange(2))
        op = rng.choice("cruudd" if rng.random() < 0.5 else "uuuddc")
        payload = {}
        if rng.random() < 0.7:
            payload["x"] = rng.choice([None, rng.randrange(100)])
        if rng.random() < 0.5:
            payload["y"] = rng.choice([None, f"t{i}"])
        if op == "u" and not payload:
            payload["x"] = i
        events.append((key, op, payload, 1000 + i))
    return events


def as_log(spark, events, first=0):
    rows = [
        ("pairs", key[0] % 3, first + i, event(op, ts, a=key[0], b=key[1], **payload))
        for i, (key, op, payload, ts) in enumerate(events)
    ]
    return log_frame(spark, rows)


def as_dict(replica):
    rows = replica.select("a", "b", "x", "y", F.unix_millis("deleted_at").alias("deleted")).collect()
    return {(r.a, r.b): {"x": r.x, "y": r.y, "deleted": r.deleted} for r in rows}


def test_fold_equals_one_by_one(spark):
    for seed in range(4):
        events = random_events(seed, 150)
        assert as_dict(replay.rebuild(as_log(spark, events), PAIRS)) == interpret(events)


def test_any_split_gives_the_same_replica(spark):
    events = random_events(99, 120)
    want = interpret(events)
    for cuts in ([60], [1, 40, 41, 100]):
        replica = merge.empty_replica(spark, PAIRS)
        by_broadcast = replica
        bounds = [0, *cuts, len(events)]
        for start, end in zip(bounds, bounds[1:]):
            changes = replay.changes(as_log(spark, events[start:end], start), PAIRS)
            replica = spark.createDataFrame(merge.merge(replica, changes, PAIRS).collect(), replica.schema)
            by_broadcast = spark.createDataFrame(
                merge.merge_broadcast(by_broadcast, changes, PAIRS).collect(), replica.schema
            )
        assert as_dict(replica) == want
        assert as_dict(by_broadcast) == want


def test_change_rows_combine(spark):
    events = random_events(5, 120)
    parts = [replay.changes(as_log(spark, events[s : s + 40], s), PAIRS) for s in (0, 40, 80)]
    together = fold.combine(parts[0].unionByName(parts[1]).unionByName(parts[2]), PAIRS)
    assert as_dict(merge.rows_created(together, PAIRS)) == interpret(events)
    counts = {r.operation: r.events for r in fold.operation_counts(together).collect()}
    ops = [op for _, op, _, _ in events]
    assert counts == {
        "INSERT": ops.count("c") + ops.count("r"),
        "UPDATE": ops.count("u"),
        "DELETE": ops.count("d"),
    }


def test_redelivered_rows_change_nothing(spark):
    events = random_events(3, 60)
    log = as_log(spark, events)
    assert as_dict(replay.rebuild(log.unionByName(log), PAIRS)) == interpret(events)


def test_rejected_events_have_no_effect(spark):
    rows = [
        ("pairs", 0, 0, event("c", 1, a=1, b=1, x=1)),
        ("pairs", 0, 1, event("u", 2, a=1, b=1, x="many", y="lost")),
        ("pairs", 0, 2, event("u", 3, a=1, b=1, z=1, y="lost")),
        ("pairs", 0, 3, event("c", 4, a=2, b="no", x=1)),
        ("pairs", 0, 4, "{bad"),
        ("pairs", 0, 5, None),
    ]
    assert as_dict(replay.rebuild(log_frame(spark, rows), PAIRS)) == {(1, 1): {"x": 1, "y": None, "deleted": None}}


def test_mixed_case_keys_update_and_delete(spark):
    rows = [
        ("Pairs", 0, 0, event("c", 1, A=1, B=1, X=1)),
        ("Pairs", 0, 1, event("u", 2, A=1, B=1, X=2)),
        ("Pairs", 0, 2, event("d", 3, A=1, B=1)),
    ]
    assert as_dict(replay.rebuild(log_frame(spark, rows), PAIRS)) == {(1, 1): {"x": 2, "y": None, "deleted": 3}}


def test_delete_without_event_time_still_deletes(spark):
    rows = [("pairs", 0, 0, event("c", 1, a=1, b=1)), ("pairs", 0, 1, '{"a":1,"b":1,"__op":"d"}')]
    assert as_dict(replay.rebuild(log_frame(spark, rows), PAIRS))[(1, 1)]["deleted"] is not None
    policy = Policy(delete_time="processing_time")
    rows[1] = ("pairs", 0, 1, event("d", 5, a=1, b=1))
    assert as_dict(replay.rebuild(log_frame(spark, rows), PAIRS, policy))[(1, 1)]["deleted"] > 10**12


def test_keys_that_moved_between_partitions(spark):
    rows = [("pairs", 3, 0, event("c", 1, a=1, b=1, x=1)), ("pairs", 0, 9, event("u", 2, a=1, b=1, x=2))]
    log = log_frame(spark, rows)
    assert fold.keys_in_two_places(replay.changes(log, PAIRS)).count() == 1
    in_time = replay.rebuild(log, PAIRS, order=fold.TIME_ORDER)
    assert as_dict(in_time) == {(1, 1): {"x": 2, "y": None, "deleted": None}}


def test_one_parse_and_one_exchange(spark):
    log = as_log(spark, random_events(1, 20))
    plan = replay.rebuild(log, PAIRS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan
    assert "Python" not in plan
