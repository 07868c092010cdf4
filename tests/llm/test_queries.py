"""Registered queries against their SQL on the smallest tables."""

import pytest

from checks.compare import canonical, connect
from hazardflow.llm.oracles import ORACLES
from hazardflow.llm.queries import QUERIES


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, name):
    ours = QUERIES[name](spark, sf)
    cursor = connect(sf).execute(ORACLES[name])
    assert canonical(ours.columns, ours.collect()) == canonical([c[0] for c in cursor.description], cursor.fetchall())
