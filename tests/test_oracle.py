"""Every registered query with an SQL twin agrees with it on the small data."""

import pytest
from compare import connect, difference

from conftest import SF
from urbanweave.plans.oracles import ORACLES
from urbanweave.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_twins_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).fetchdf()) is None
