"""Hot keys and lookups too large to broadcast give the same results."""

from __future__ import annotations

import shutil

import pytest

from shelfstar.catalog import all_oracles, all_queries
from shelfstar.operators import lookup
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()
NAMES = (
    "trend_month",
    "preference_report",
    "preference_view",
    "supplier_geo_view",
    "fact_purchase",
    "fact_borrowing",
    "fact_sales",
    "asof_join_scd2",
    "allocate_payments",
    "sales_amounts",
    "rule_total_guard",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Test tables in which one order, one book and one member hold a third of all rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(FOLDER)
    for name in ("region", "nation", "customer", "supplier", "part", "events"):
        shutil.copy(f"{FOLDER}/{name}.parquet", folder)
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END::BIGINT
        AS o_custkey) FROM orders) TO '{folder}/orders.parquet' (FORMAT parquet)"""
    )
    con.execute(
        f"""COPY (SELECT * EXCLUDE n REPLACE (
          CASE WHEN n % 3 = 0 THEN 5 ELSE l_orderkey END::BIGINT AS l_orderkey,
          CASE WHEN n % 3 = 1 THEN 11 ELSE l_partkey END::BIGINT AS l_partkey,
          n::INTEGER AS l_linenumber)
        FROM (SELECT *, row_number() OVER () AS n FROM lineitem))
        TO '{folder}/lineitem.parquet' (FORMAT parquet)"""
    )
    return folder


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookup, "within_rows", lambda df, bound=0: False)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


@pytest.mark.parametrize("name", NAMES)
def test_shuffled_lookups_on_hot_keys(spark, skewed, no_broadcast, name):
    table = QUERIES[name](spark, skewed).toArrow()
    want = connect(skewed).execute(ORACLES[name]).to_arrow_table()
    assert difference(table, want) is None
