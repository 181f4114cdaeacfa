"""Every query of the library's own operators against DuckDB on the smallest data."""

import pytest

from tests.compare import mismatch, oracle_connection
from vaultloom.registry.oracle import all_oracles
from vaultloom.registry.queries import all_queries

DATA = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"dq_hash_collisions"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(DATA)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    problem = mismatch(all_queries()[name](spark, DATA), con, all_oracles()[name])
    assert problem is None or (name in MAY_BE_EMPTY and problem == "no rows on either side"), problem
