"""The text queries that SQL can express, against their twins on the smallest tables."""

import pytest

from creaseline.llm.oracles import ORACLES
from creaseline.llm.queries import QUERIES
from tests.compare import connect, difference
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_twin(spark, con, name):
    assert difference(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
