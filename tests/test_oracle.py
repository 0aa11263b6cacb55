"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

from shelfstar.catalog import all_oracles, all_queries
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, capsys, name):
    df = QUERIES[name](spark, FOLDER)
    df.explain()
    plan = capsys.readouterr().out
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert slow not in plan
    table = df.toArrow()
    assert table.num_rows > 0
    assert difference(table, duck.execute(ORACLES[name]).to_arrow_table()) is None
