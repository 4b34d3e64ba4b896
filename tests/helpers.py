"""Small log rows for tests, and a plain interpreter of the apply rules."""

from __future__ import annotations

import json

from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.sources.changelog import LOG_SCHEMA

TOPIC = "src.shop."

PAIRS = TableSchema(
    "pairs",
    (
        ColumnSpec("a", "int", 1, pk_pos=1),
        ColumnSpec("b", "int", 2, pk_pos=2),
        ColumnSpec("x", "int", 3, default="7"),
        ColumnSpec("y", "varchar", 4),
    ),
)


def log_frame(spark, rows):
    """rows: (table or topic, partition, offset, value text)."""
    full = [
        (name if "." in name else TOPIC + name, part, offset, None, None, value) for name, part, offset, value in rows
    ]
    return spark.createDataFrame(full, LOG_SCHEMA)


def event(op, ts_ms, **payload):
    return json.dumps({**payload, "__op": op, "__ts_ms": ts_ms})


def interpret(events, replica=None):
    """Apply (key, op, payload, ts_ms) one after another to {key: row}."""
    rows = {key: dict(row) for key, row in (replica or {}).items()}
    for key, op, payload, ts_ms in events:
        row = rows.get(key)
        if op in ("c", "r"):
            if row is None:
                row = rows[key] = {"x": 7, "y": None}
            row.update(payload)
            row["deleted"] = None
        elif row is not None and op == "u":
            row.update(payload)
        elif row is not None and op == "d":
            row["deleted"] = ts_ms
    return rows
