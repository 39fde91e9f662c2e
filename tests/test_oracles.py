"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import database, difference

from tickloom.plans.oracles import ORACLES
from tickloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
