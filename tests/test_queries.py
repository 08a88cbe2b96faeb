"""Every registered query against DuckDB on the same tables."""

import pytest
from compare import connect, differences
from conftest import DATA

from __spark_entry__ import entry, oracle_sql, queries
from wattline.plans.catalog import QUERIES
from wattline.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, DATA), duck, ORACLES[name]) == []
