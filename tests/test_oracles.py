"""Every query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from creaseline.catalog import QUERIES
from creaseline.oracles import ORACLES
from tests.compare import connect, difference
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_twin(spark, con, name):
    assert difference(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None
