"""Every query with SQL against that SQL, whole results at the smallest scale."""

import pytest

import __spark_entry__ as entry
from corpusmill.workload import oracle, registry
from tests.compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert differences(entry.queries()[name](spark, FOLDER), connection, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
