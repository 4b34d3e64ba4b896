"""Source columns may be named like anything the engine uses itself."""

import json

import pytest
from helpers import log_frame

from tidemark.functions.convert import Policy
from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.operators import rejects, replay
from tidemark.streaming import jdbc
from tidemark.streaming.lake import ReplicaTable

NAMES = [
    "topic", "partition", "offset", "timestamp", "raw", "op", "operation", "ts_ms", "source_db", "source_table", "deleted",
    "reason", "delete_time", "bucket", "parse_error", "row_created", "data.part", "names", "source",
]


def message(operation, at, payload):
    return json.dumps({**payload, "__op": operation, "__ts_ms": at})


@pytest.mark.parametrize("key", ["reason", "data.part"])
def test_a_table_with_all_these_columns(spark, tmp_path, key):
    values = [n for n in NAMES if n != key]
    table = TableSchema("t", (ColumnSpec(key, "int", 1, pk_pos=1), *[ColumnSpec(n, "varchar", i) for i, n in enumerate(values, 2)]))

    def row(number, text):
        return {key: number, **{n: f"{text} {n}" for n in values}}

    rows = [
        ("t", 0, 0, message("c", 1, row(1, "one"))),
        ("t", 0, 1, message("c", 2, row(2, "two"))),
        ("t", 0, 2, message("u", 3, row(1, "new"))),
        ("t", 0, 3, message("d", 4, {key: 2})),
        ("t", 0, 4, message("c", 5, row("x", "bad"))),
    ]
    want = {(1, *[f"new {n}" for n in values], False), (2, *[f"two {n}" for n in values], True)}
    log = log_frame(spark, rows)

    def plain(replica):
        return {(*r[:-1], r[-1] is not None) for r in replica.collect()}

    assert plain(replay.rebuild(log, table)) == want
    reasons = rejects.rejected(replay.parsed(log), {"t": table}).collect()
    assert [(r.offset, r.reason) for r in reasons] == [(4, "cast_error")]
    assert jdbc.staged(replay.changes(log, table), table, Policy()).count() == 2
    replica = ReplicaTable(str(tmp_path / "r"), table, buckets=2)
    for batch, part in enumerate((log.filter("offset < 2"), log.filter("offset >= 2"))):
        assert replica.apply(replay.changes(part, table), batch)
    assert plain(replica.read(spark)) == want
