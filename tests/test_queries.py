"""Every registered query against its SQL on the smallest tables."""

import pytest

from sparktab.queries import ORACLES, QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, small, name):
    assert difference(QUERIES[name](spark, small), db, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
