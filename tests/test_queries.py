import pytest

from hangarlight.plans.oracle import oracles
from hangarlight.plans.queries import QUERIES

from .compare import assert_same, connect

FOLDER = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    assert_same(QUERIES[name](spark, FOLDER), con, SQL[name])
