"""Every registered query equals its SQL twin."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle import connect, difference

import __spark_entry__ as entry_point
import lakequeries

QUERIES = lakequeries.all_queries()
ORACLES = lakequeries.all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
