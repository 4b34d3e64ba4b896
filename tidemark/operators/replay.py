"""Batch application of a whole log: bootstrap from a snapshot, replay from the start."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.functions import envelope
from tidemark.functions.convert import Policy
from tidemark.functions.types import TableSchema
from tidemark.operators.fold import LOG_ORDER, fold
from tidemark.operators.merge import merge, rows_created
from tidemark.operators.typed import typed_events


def parsed(log: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Parsed events of a log without the excluded tables."""
    names = list(excluded)
    return envelope.exclude_tables(envelope.parse(envelope.exclude_topics(log, names)), names)


def changes(
    log: DataFrame,
    table: TableSchema,
    policy: Policy = Policy(),
    excluded: Iterable[str] = (),
    order: tuple[str, ...] = LOG_ORDER,
) -> DataFrame:
    """Change rows of one table from a log."""
    return fold(typed_events(parsed(log, excluded), table, policy), table, order)


def rebuild(
    log: DataFrame,
    table: TableSchema,
    policy: Policy = Policy(),
    excluded: Iterable[str] = (),
    order: tuple[str, ...] = LOG_ORDER,
) -> DataFrame:
    """The replica a log gives from nothing: one pass, one exchange of partial rows."""
    return rows_created(changes(log, table, policy, excluded, order), table, policy)


def advance(
    replica: DataFrame,
    log: DataFrame,
    table: TableSchema,
    policy: Policy = Policy(),
    excluded: Iterable[str] = (),
    order: tuple[str, ...] = LOG_ORDER,
) -> DataFrame:
    """A replica after the events of a log, for example a bootstrapped one after its stream."""
    return merge(replica, changes(log, table, policy, excluded, order), table, policy)
