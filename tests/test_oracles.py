"""Every registered query with a SQL twin, on the smallest tables."""

import pytest
from oracle import compare, duck

from tidemill.plans import oracles, registered

SF = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(registered()[name](spark, SF), con, SQL[name]) == ""


def test_every_twin_has_a_query():
    assert set(SQL) <= set(registered())
