"""Every registered query against its SQL twin on the smallest sample."""

import pytest

from verification.compare import connect, difference
from verification.registry import ORACLES, QUERIES

from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    mine = QUERIES[name](spark, SMALL).toPandas()
    assert difference(mine, duck.execute(ORACLES[name]).df()) is None
    assert len(mine) > 0
