"""Every registered query next to its SQL twin; those without one must give rows."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_twin_has_a_query():
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name):
    found = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(found, connection, ORACLE[name]) == []
    else:
        assert found.count() > 0
