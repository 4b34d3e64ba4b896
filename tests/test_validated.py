"""Validation with the catalog as data, against the conversion of each table by itself."""

import json
import random
import re

from helpers import TOPIC, log_frame

from tidemark.functions.convert import Policy
from tidemark.functions.envelope import parse
from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.operators.typed import typed_events, validated

WIDE = TableSchema(
    "wide",
    tuple(
        ColumnSpec(f"c{i}", kind, i + 1, precision=5 if kind == "decimal" else None, scale=2 if kind == "decimal" else None,
                   unsigned=kind == "smallint", pk_pos={0: 2, 1: 1}.get(i))
        for i, kind in enumerate(("int", "varchar", "decimal", "datetime", "date", "time", "bit", "blob", "json", "double",
                                  "smallint", "tinyint", "bigint", "timestamp"))
    ),
)
NARROW = TableSchema("Narrow", (ColumnSpec("c0", "bigint", 1, pk_pos=1), ColumnSpec("c2", "decimal", 2, precision=3, scale=0)))
KEYLESS = TableSchema("keyless", (ColumnSpec("c0", "int", 1),))
CATALOG = {"wide": WIDE, "Narrow": NARROW, "keyless": KEYLESS}
VALUES = [None, 1, -1, 0, 70000, 1e300, 12.345, "x", "", "1", "true", "2024-01-02", "2024-01-02T03:04:05Z", "12:00:00", "YQ==",
          "!!", True, "99999999999999999999999", 9223372036854775807, {"a": 1}, [1]]


def random_log(spark, seed, n=300):
    pick, rows = random.Random(seed), []
    for i in range(n):
        names = pick.sample([f"c{j}" for j in range(15)], pick.randrange(6)) + pick.choice([["c0", "c1"], ["C0"], []])
        pairs = [(name, pick.choice(VALUES)) for name in names]
        pairs += [("__op", pick.choice("ccuudrx")), ("__ts_ms", i)]
        if pick.random() < 0.2:
            pairs.append(("deleted_at", 1))
        body = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"
        table = pick.choice(["wide", "WIDE", "narrow", "keyless", "nosuch"])
        rows.append((table, 0, i, pick.choice([body] * 9 + ["{bad", None])))
    return log_frame(spark, rows)


def test_equals_each_table_by_itself(spark):
    for seed, policy in enumerate((Policy(), Policy(dialect="mysql", unknown_columns="ignore", source_zone="America/Toronto"))):
        events = parse(random_log(spark, seed)).persist()
        have = {r.offset: (r.table_name, r.reason) for r in validated(events, CATALOG, policy).collect()}
        want = {r.offset: (None, None) for r in events.select("offset").collect()}
        for name, table in CATALOG.items():
            want |= {r.offset: (name, r.reason) for r in typed_events(events, table, policy).select("offset", "reason").collect()}
        events.unpersist()
        assert have == want
        reasons = {r for _, r in have.values()}
        assert len(reasons) >= 7 and "cast_error" in reasons and None in reasons


def test_the_plan_does_not_grow_with_the_catalog(spark):
    events = parse(random_log(spark, 5, 20))

    def plan(n):
        many = {f"t{i}": TableSchema(f"t{i}", WIDE.columns) for i in range(n)}
        text = validated(events, {**CATALOG, **many})._jdf.queryExecution().optimizedPlan().toString()
        return re.sub(r"#\d+L?|_\d+", "", text)

    assert "rlike" in plan(4).lower() and plan(64) == plan(4)


def test_empty_catalog(spark):
    rows = validated(parse(random_log(spark, 6, 10)), {}).collect()
    assert len(rows) == 10 and all(r.table_name is None and r.reason is None for r in rows)
    assert TOPIC  # the log's rows have topics of this prefix
