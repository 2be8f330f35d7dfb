"""Every registered query against its DuckDB statement over the test tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from oracle.statements import statements
from tillroll.plans.registry import all_queries

SF = os.environ.get("TILLROLL_TEST_SF", "/root/testdata/sf0.001")
QUERIES, STATEMENTS = all_queries(), statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, STATEMENTS[name]) == []


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(STATEMENTS) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
