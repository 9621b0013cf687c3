"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from millrace.plans.batch import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    connection = connect(folder)
    yield connection
    connection.close()


# Its path recursion takes minutes in SQL on the whole table; test_segments.py holds it against plain programming.
WITHOUT_SQL = {"keyword_segments"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL <= set(contract.oracle_sql()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query(spark, folder, con, name):
    assert difference(contract.queries()[name](spark, folder), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
