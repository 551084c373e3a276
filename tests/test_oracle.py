"""Every registered query equals its SQL oracle."""

import pytest

from conftest import SMALL
from verification.compare import connect, differences
from verification.oracle import oracles
from verification.queries import registered

QUERIES, SQL = registered(), oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) is None
