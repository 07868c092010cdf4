"""Every registered query against its SQL twin on the smoke tables, and its plan."""

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, connection, sf, name):
    result = QUERIES[name](spark, sf)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "MapInArrow"):
        assert bad not in plan
    assert difference(result, connection, name) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
