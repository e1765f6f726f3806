"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from ledgerlint.plans.oracle import ORACLE_SQL
from ledgerlint.plans.queries import QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
NO_SQL = {"file_manifest", "isolation_forest", "clean_orders_with_forest"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_only_the_known_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == NO_SQL
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    query, sql = QUERIES[name], ORACLE_SQL[name]
    assert difference(spark, con, SF, query, sql) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 8
