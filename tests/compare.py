"""Compare a Spark result with the SQL result over the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(frame: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    want = _rows(names, cursor.fetchall())
    have = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    found = [] if len(want) == len(have) else [f"{len(have)} rows against {len(want)}"]
    found += [f"{h} against {w}" for h, w in zip(have, want) if h != w][:3]
    if any(type(h) is not type(w) for hr, wr in zip(have[:50], want[:50]) for h, w in zip(hr, wr)):
        found.append("value types differ")
    return found
