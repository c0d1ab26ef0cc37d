"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.check import database, differences
from workloads.oracles import ORACLES
from workloads.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
