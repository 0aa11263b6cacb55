"""The calendar of the commerce tables follows their dates."""

from __future__ import annotations

import datetime as dt

import pytest

from shelfstar.plans import facts
from shelfstar.sources.commerce import SCHEMAS, Commerce


@pytest.fixture
def tables(spark, tmp_path):
    def make(days):
        stamps = [dt.datetime.combine(d, dt.time()) if d else None for d in days]
        orders = [(k, 1, "F", 1.0, s, "1-URGENT") for k, s in enumerate(stamps)]
        lines = [(k, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "F", s) for k, s in enumerate(stamps)]
        for name, rows in (("orders", orders), ("lineitem", lines)):
            spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
        return Commerce(spark, str(tmp_path))

    return make


def test_early_and_late_facts_stay(tables):
    src = tables([dt.date(1980, 2, 29), dt.date(2040, 12, 31), dt.date(1999, 5, 1)])
    assert src.first_and_last == (dt.date(1980, 1, 1), dt.date(2040, 12, 31))
    days = src.lending_fact().join(src.calendar(), "date_key").select("cal_date").collect()
    assert sorted(r[0] for r in days) == [dt.date(1980, 2, 29), dt.date(1999, 5, 1), dt.date(2040, 12, 31)]
    assert src.calendar().where("festive_event = 'Christmas'").count() == 41


def test_rows_without_day(tables):
    src = tables([dt.date(2001, 3, 1), None])
    orders = src.book_orders().select("order_id", "sales_date")
    assert [r.order_id for r in facts.rows_without_day(orders, src.calendar(), "sales_date").collect()] == [1]


def test_no_dates(tables):
    src = tables([])
    assert src.calendar().count() == 0 and src.lending_fact().count() == 0
