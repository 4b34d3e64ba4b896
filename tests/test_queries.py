"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from tidemark.plans.queries import BATCH_QUERIES, STREAM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(BATCH_QUERIES) | set(STREAM_QUERIES) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert differences(registered.queries()[name](spark, SF_DIR), db, registered.oracle_sql()[name]) == []


def test_entry(spark):
    assert registered.entry(spark).count() > 0
