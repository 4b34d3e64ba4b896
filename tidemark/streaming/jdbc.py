"""Database sink: folded changes go to a staging table, then one transaction moves them.

The staging table is written by Spark in parallel; the transaction holds a fixed number
of set-based statements, however many rows there are. A batch table filled in the same
transaction makes a repeated batch fail on its key, so it is never applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy, default_value
from tidemark.functions.types import DELETED_AT, TableSchema, quoted, replica_schema
from tidemark.operators.fold import FIRST_INSERT
from tidemark.operators.typed import payload_columns
from tidemark.streaming.retry import with_retry

BATCHES = "applied_batches"
CREATES = "__row_created"


# Types that a staging table holds as text, and what the target casts them to.
CASTS = {"postgres": {"json": "JSONB", "jsonb": "JSONB", "time": "TIME"}, "mysql": {"json": "JSON", "time": "TIME"}}


def _set(name: str) -> str:
    return f"__set_{name}"


def _new(name: str) -> str:
    return f"__new_{name}"


def staged(changes: DataFrame, table: TableSchema, policy: Policy) -> DataFrame:
    """Change rows flattened for a staging table.

    Per column: its last value, ``__set_<c>`` whether an existing row takes it, and
    ``__new_<c>`` the value a created row gets. ``__row_created`` is set where an insert may
    create the row. Source columns do not begin with ``__``, so these names are free.
    """
    order = changes.schema[FIRST_INSERT].dataType.fieldNames()
    kinds = {f.name: f.dataType for f in replica_schema(table, policy.dialect)}
    defaults = {c.name: default_value(c, policy) for c in payload_columns(table)}
    columns = []
    for name in [c.name for c in payload_columns(table) if c.pk_pos is None] + [DELETED_AT]:
        position = F.struct(*[F.col(f"`{name}`.`{part}`").alias(part) for part in order])
        after = F.col(f"`{name}`").isNotNull() & (position >= F.col(FIRST_INSERT))
        value = F.col(f"`{name}`.v").cast(kinds[name])
        columns += [
            value.alias(name),
            F.col(f"`{name}`").isNotNull().cast("int").alias(_set(name)),
            F.when(after, value).otherwise(defaults.get(name, F.lit(None))).cast(kinds[name]).alias(_new(name)),
        ]
    created = F.col(FIRST_INSERT).isNotNull().cast("int").alias(CREATES)
    return changes.select(*map(quoted, table.keys), created, *columns)


def _quote(name: str, dialect: str) -> str:
    if dialect == "mysql":
        return "`" + name.replace("`", "``") + "`"
    return '"' + name.replace('"', '""') + '"'


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def batches_table(dialect: str) -> str:
    """The statement that creates the table of applied batches. A batch is one of a table, a source and a number."""
    name, source, batch = (_quote(n, dialect) for n in ("table_name", "source", "batch_id"))
    columns = f"{name} VARCHAR(255) NOT NULL, {source} VARCHAR(64) NOT NULL, {batch} BIGINT NOT NULL"
    return f"CREATE TABLE IF NOT EXISTS {_quote(BATCHES, dialect)} ({columns}, PRIMARY KEY ({name}, {source}, {batch}))"


def merge_statements(table: TableSchema, staging: str, batch_id: int, dialect: str, batch_source: str = "") -> list[str]:
    """The statements of one batch: record it, change existing rows, create new ones."""

    def q(name: str) -> str:
        return _quote(name, dialect)

    values = [c.name for c in payload_columns(table) if c.pk_pos is None] + [DELETED_AT]
    target, source = q(table.table), q(staging)
    same = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in table.keys)
    kinds = {c.name: CASTS[dialect].get(c.data_type) for c in payload_columns(table)}

    def cast(column: str, name: str) -> str:
        return f"CAST(s.{q(column)} AS {kinds[name]})" if kinds.get(name) else f"s.{q(column)}"

    taken = {c: f"CASE WHEN s.{q(_set(c))} = 1 THEN {cast(c, c)} ELSE t.{q(c)} END" for c in values}
    if dialect == "mysql":
        sets = ", ".join(f"t.{q(c)} = {taken[c]}" for c in values)
        update = f"UPDATE {target} t JOIN {source} s ON {same} SET {sets}"
    else:
        sets = ", ".join(f"{q(c)} = {taken[c]}" for c in values)
        update = f"UPDATE {target} AS t SET {sets} FROM {source} AS s WHERE {same}"
    columns = ", ".join(q(c) for c in [*table.keys, *values])
    fresh = ", ".join([f"s.{q(k)}" for k in table.keys] + [cast(_new(c), c) for c in values])
    insert = (
        f"INSERT INTO {target} ({columns}) SELECT {fresh} FROM {source} s WHERE s.{q(CREATES)} = 1"
        f" AND NOT EXISTS (SELECT 1 FROM {target} t WHERE {same})"
    )
    batch = f"{_text(table.table)}, {_text(batch_source)}, {int(batch_id)}"
    record = f"INSERT INTO {q(BATCHES)} ({q('table_name')}, {q('source')}, {q('batch_id')}) VALUES ({batch})"
    return [record, update, insert]


def applied_query(table: TableSchema, dialect: str, batch_source: str = "") -> str:
    """Last batch of a source recorded for a table."""
    column, batches, of, source = (_quote(n, dialect) for n in ("batch_id", BATCHES, "table_name", "source"))
    return f"SELECT max({column}) FROM {batches} WHERE {of} = {_text(table.table)} AND {source} = {_text(batch_source)}"


class DatabaseSink:
    """Sink callable for the replication job.

    ``connect`` gives an open connection with ``cursor``, ``commit``, ``rollback`` and
    ``close``, as every Python database driver has it. ``url`` and ``options`` are for
    Spark's own writer.
    """

    def __init__(
        self, connect: Callable[[], object], url: str, policy: Policy, options: dict[str, str] | None = None
    ) -> None:
        self.connect = connect
        self.url = url
        self.policy = policy
        self.options = options or {}

    def __call__(self, table: TableSchema, changes: DataFrame, batch_id: int, source: str = "") -> int:
        """Apply a batch unless it was applied before; gives the deadlocks it took.

        Whatever fails, connecting and staging included, is a :class:`SinkFailure`, which dead-letters the batch.
        """
        staging = f"{table.table}_changes"
        statements = merge_statements(table, staging, batch_id, self.policy.dialect, source)

        def stage() -> None:
            if not self.already_applied(table, batch_id, source):
                self.stage(staged(changes, table, self.policy), staging)
                waiting.append(statements)

        waiting: list[list[str]] = []
        deadlocks = with_retry(stage, self.policy.dialect)
        for one in waiting:
            deadlocks += with_retry(lambda: self.transact(one), self.policy.dialect)
        return deadlocks

    def stage(self, rows: DataFrame, name: str) -> None:
        """Write the staging table, in parallel."""
        rows.write.format("jdbc").mode("overwrite").options(url=self.url, dbtable=name, **self.options).save()

    def already_applied(self, table: TableSchema, batch_id: int, source: str = "") -> bool:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(applied_query(table, self.policy.dialect, source))
            last = cursor.fetchone()[0]
            return last is not None and batch_id <= last
        finally:
            connection.close()

    def transact(self, statements: list[str]) -> None:
        """All statements or none."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()
