"""Repeated keys, NULL keys, open windows and undated changes."""

from __future__ import annotations

from datetime import date as d

from pyspark.sql import functions as F

from shelfstar.operators.scd2 import scd2_apply
from shelfstar.operators.upsert import insert_absent
from shelfstar.plans.facts import discount_on_day
from tests.conftest import rows


def test_insert_absent_takes_one_row_per_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(2, "z"), (2, "b"), (None, "n"), (1, "x")], "k int, v string")
    once = insert_absent(target, batch, ["k"])
    assert rows(once) == [(None, "n"), (1, "a"), (2, "b")]
    assert rows(insert_absent(once, batch, ["k"])) == rows(once)


def test_discount_without_an_end_stays_open(spark):
    columns = "discount_id string, discount_rate int, discount_start date, discount_end date"
    discounts = spark.createDataFrame([("D2", 5, d(2020, 1, 2), None), ("D1", 9, d(2020, 1, 5), d(9999, 12, 31))], columns)
    discounts = discounts.withColumn("discount_rate", F.col("discount_rate").cast("decimal(8,2)"))
    orders = spark.createDataFrame(
        [(1, d(2020, 1, 1)), (2, d(2020, 1, 3)), (3, d(2020, 1, 6))], "order_id int, sales_date date"
    ).selectExpr("*", "cast(null as string) AS discount_id", "cast(null as decimal(8,2)) AS discount_rate")
    got = discount_on_day(orders, discounts).select("order_id", "discount_id")
    assert rows(got) == [(1, "D000"), (2, "D2"), (3, "D1")]


def test_change_without_a_date_holds_from_the_given_day(spark):
    dim = spark.createDataFrame(
        [(1, "b", "old", d(2020, 1, 1), d(9999, 12, 31), "Y")],
        "book_key long, book_id string, price string, effective_date date, expiration_date date, curr_ind string",
    )
    changes = spark.createDataFrame([("b", "new", None)], "book_id string, price string, effective_date date")
    after = scd2_apply(dim, changes, id_col="book_id", key_col="book_key", tracked=["price"], as_of="2021-05-01")
    assert rows(after, "price", "effective_date", "curr_ind") == [("new", d(2021, 5, 1), "Y"), ("old", d(2020, 1, 1), "N")]
