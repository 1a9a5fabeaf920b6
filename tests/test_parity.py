"""Every query of the library's own catalogue against its DuckDB twin."""

from __future__ import annotations

import pytest
from conftest import SMALL
from parity import connect, difference

import __spark_entry__ as contract
from oracle.queries import ORACLE
from saldo.catalogue import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, duck, name):
    result = contract.queries()[name](spark, SMALL)
    assert difference(result, duck, contract.oracle_sql()[name]) == ""
