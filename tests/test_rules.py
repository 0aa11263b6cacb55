from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shelfstar.plans import constraints, rules
from shelfstar.sources.schemas import OPERATIONAL
from tests.conftest import rows

D, T = dt.date, dt.datetime


def test_generic_checks(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 9, "y")], "k string, n int, v string")
    assert rows(rules.check_unique(df, ["k"], "u")) == [("u", "a", "2 rows")]
    assert rows(rules.check_not_null(df, "n", ["v"])) == [("v not null", "1", "v is required")]
    assert rows(rules.check(df, "k", "big", F.col("n") > 5, "too big")) == [("big", "b", "too big")]
    parent = spark.createDataFrame([("x",), ("x",)], "p string")
    got = rules.check_foreign_key(df, "n", "v", parent, "p", "fk")
    assert rows(got) == [("fk", "9", "no parent for v y")]


def test_declared_checks_find_every_kind(spark):
    copies = spark.createDataFrame([("C1", "B1", "available"), ("C1", "B9", "gone")], OPERATIONAL["book_copies"])
    titles = spark.createDataFrame(
        [("B1", "t", "a", "g", 2000, Decimal(1), Decimal(1), Decimal(1))], OPERATIONAL["book_titles"]
    )
    got = constraints.declared_violations({"book_copies": copies, "book_titles": titles})
    assert rows(got, "rule", "key") == [
        ("book_copies book_id reference", "C1"),
        ("book_copies book_status", "C1"),
        ("book_copies primary key", "C1"),
    ]


def test_members_and_titles(spark):
    members = spark.createDataFrame(
        [("a", "active", D(2020, 1, 1)), ("b", "active", D(2020, 1, 2)), ("c", "expire", D(2021, 1, 1))],
        "member_id string, member_status string, expire_date date",
    )
    assert rows(rules.expire_memberships(members, "2020-01-01"), "member_id", "member_status") == [
        ("a", "expire"), ("b", "active"), ("c", "expire"),
    ]
    assert rows(rules.status_mismatches(members, "2020-01-02"), "key") == [("a",), ("c",)]
    titles = spark.createDataFrame(
        [("t1", 2021, Decimal("-1"), Decimal("1"), Decimal("5.1")), ("t2", 2020, Decimal("0"), Decimal("0"), None)],
        "book_id string, publication_year int, purchase_price decimal(6,2), sales_price decimal(6,2), popularity decimal(2,1)",
    )
    assert rows(rules.title_violations(titles, "2020-06-01"), "key", "rule") == [
        ("t1", "title popularity"), ("t1", "title purchase price"), ("t1", "title year"),
    ]


def test_copies(spark):
    copies = spark.createDataFrame([("c1", "b1", "available"), ("c2", "b2", "reserved")], "copy_id string, book_id string, book_status string")
    loans = spark.createDataFrame([("c1", "On loan"), ("c1", "On loan"), ("c2", "Returned")], "copy_id string, return_status string")
    assert rows(rules.copy_status(copies, loans), "copy_id", "book_status") == [("c1", "borrowed"), ("c2", "reserved")]
    dim = spark.createDataFrame([("b1", "Unavailable", "N"), ("b2", "unavailable", "Y")], "book_id string, book_status string, curr_ind string")
    assert rows(rules.unavailable_copies(copies, dim), "copy_id", "book_status") == [("c1", "available"), ("c2", "unavailable")]


def test_staff(spark):
    shifts = spark.createDataFrame([("s", 9 * 3600)], "shift_id string, start_second int")
    day = [
        (1, T(2020, 1, 6, 9, 0), T(2020, 1, 6, 19, 59)), (2, T(2020, 1, 7, 9, 1), T(2020, 1, 7, 19, 0)),
        (3, T(2020, 1, 8, 8, 0), T(2020, 1, 8, 18, 30)), (4, T(2020, 1, 12, 8, 0), T(2020, 1, 12, 18, 0)),
        (5, None, None),
    ]
    att = spark.createDataFrame(
        [(i, "p", "s", (a or T(2020, 1, 6)).date(), a, b) for i, a, b in day],
        "attendance_id int, staff_id string, shift_id string, shift_date date, actual_start timestamp, actual_end timestamp",
    )
    assert rows(rules.attendance_status(att, shifts), "attendance_id", "attendance_status") == [
        (1, "Present"), (2, "Late"), (3, "Present"), (4, "Present"), (5, None),
    ]
    # 10 + 9 + 10 + 10 full hours.
    assert rows(rules.weekly_hours(att), "week_start", "hours") == [(D(2020, 1, 6), 39)]
    assert rules.weekly_limit_violations(att).count() == 0
    assert rows(rules.weekly_limit_violations(att, 38), "key", "message") == [("p|2020-01-06", "39 hours exceed 38")]


def test_membership_window(spark):
    members = spark.createDataFrame([("m", D(2020, 1, 1), D(2020, 12, 31))], "member_id string, registration_date date, expire_date date")
    loans = spark.createDataFrame(
        [("1", "m", D(2020, 1, 1)), ("2", "m", D(2020, 12, 31)), ("3", "m", D(2021, 1, 1)), ("4", "x", D(2020, 5, 5)), ("5", None, D(2020, 5, 5))],
        "borrow_id string, member_id string, borrow_date date",
    )
    assert rows(rules.membership_violations(loans, members), "key", "message") == [
        ("3", "loan date is outside the membership"), ("4", "member does not exist"), ("5", "member and loan date are required"),
    ]


def test_fines_and_payments(spark):
    fines = spark.createDataFrame(
        [("f1", "b1", "p1", "Lost Book", None, "Unpaid"), ("f2", "b2", "p1", "Damage", None, "Unpaid"),
         ("f3", "b2", None, "Late Return", None, "Unpaid"), ("f4", "b2", None, "Other", Decimal("-1"), "Open")],
        "fine_id string, borrow_id string, payment_id string, fine_type string, fine_amount decimal(18,2), fine_status string",
    )
    loans = spark.createDataFrame([("b1", "c"), ("b2", "c")], "borrow_id string, copy_id string")
    copies = spark.createDataFrame([("c", "k")], "copy_id string, book_id string")
    titles = spark.createDataFrame([("k", Decimal("15.00"))], "book_id string, sales_price decimal(6,2)")
    filled = rules.fine_amounts(fines, loans, copies, titles)
    assert rows(filled, "fine_id", F.col("fine_amount").cast("string")) == [
        ("f1", "35.00"), ("f2", "15.00"), ("f3", "30.00"), ("f4", "-1.00"),
    ]
    assert rows(rules.fine_violations(filled), "key", "rule") == [
        ("f4", "fine amount"), ("f4", "fine status"), ("f4", "fine type"),
    ]
    payments = spark.createDataFrame(
        [("p1", "Fines", "Tng", None), ("p2", "Fines", "Cash", None), ("p3", "Membership Registration", "Cheque", None)],
        "payment_id string, payment_type string, payment_method string, pay_amount decimal(18,2)",
    )
    paid = rules.payment_amounts(payments, filled)
    assert rows(paid, "payment_id", F.col("pay_amount").cast("string")) == [("p1", "50.00"), ("p2", "0.00"), ("p3", "50.00")]
    assert rows(rules.payment_violations(paid), "key", "rule") == [("p2", "payment amount"), ("p3", "payment method")]
    assert rows(rules.fines_paid_by(filled, paid), "fine_id", "fine_status")[:3] == [("f1", "Paid"), ("f2", "Paid"), ("f3", "Unpaid")]


def test_purchases(spark):
    details = spark.createDataFrame([("o1", "k", 2), ("o1", "k", None), ("o2", "k", 1)], "purchase_order_id string, book_id string, quantity bigint")
    titles = spark.createDataFrame([("k", Decimal("2.50"))], "book_id string, purchase_price decimal(6,2)")
    orders = spark.createDataFrame([("o1", Decimal("5.00")), ("o2", Decimal("5.00")), ("o3", None)], "purchase_order_id string, total_amount decimal(18,2)")
    assert rows(rules.total_violations(orders, details, titles), "key", "message") == [("o2", "total must equal 2.50")]
    fixed = rules.recompute_totals(orders, details, titles)
    assert rules.total_violations(fixed, details, titles).count() == 0
    only = rules.recompute_totals(orders, details, titles, orders.where("purchase_order_id = 'o1'"))
    assert rows(only, "purchase_order_id", F.col("total_amount").cast("string")) == [("o1", "5.00"), ("o2", "5.00"), ("o3", None)]


def test_sales(spark):
    discounts = spark.createDataFrame(
        [("d", Decimal("12.50"), D(2020, 1, 1), D(2020, 1, 31))],
        "discount_id string, discount_rate decimal(8,2), discount_start date, discount_end date",
    )
    orders = spark.createDataFrame(
        [("a", "d", D(2020, 1, 1)), ("b", "d", D(2020, 1, 31)), ("c", "d", D(2020, 2, 1)), ("e", "d", D(2019, 12, 31)), ("n", None, D(2020, 2, 1))],
        "order_id string, discount_id string, sales_date date",
    )
    assert rows(rules.discount_violations(orders, discounts), "key") == [("c",), ("e",)]
    details = spark.createDataFrame(
        [("s1", "a", "k", 3), ("s2", "c", "k", 1), ("s3", "n", "k", 2), ("s4", "a", "k", 0)],
        "sales_id string, order_id string, book_id string, quantity_sold bigint",
    )
    titles = spark.createDataFrame([("k", Decimal("9.99"))], "book_id string, sales_price decimal(6,2)")
    got = rules.sales_amounts(details, orders, titles, discounts)
    # 29.97 * 12.5 % = 3.74625
    assert rows(got, "sales_id", F.col("discount_amount").cast("string"), F.col("total_amount").cast("string")) == [
        ("s1", "3.75", "26.22"), ("s2", None, None), ("s3", "0.00", "19.98"), ("s4", None, None),
    ]
    assert rows(rules.quantity_violations(details), "key") == [("s4",)]
    blank = spark.createDataFrame([("a", None)], "order_id string, sales_date date")
    assert rows(rules.default_sales_dates(blank, "2020-01-01"), "sales_date") == [(D(2020, 1, 1),)]


def test_declared_constraints_of_every_kind(spark):
    members = spark.createDataFrame(
        [
            ("M1", "a", "t1", "e1", "female", 12, "x", "active", D(2020, 1, 1), D(2021, 1, 1)),
            ("M2", None, "t1", "e2", "other", 75, "x", "active", D(2020, 1, 1), None),
            ("M3", "c", None, "e1", "male", None, "x", "gone", D(2020, 1, 1), D(2021, 1, 1)),
            (None, "d", None, "e3", "male", 74, "x", "expire", D(2020, 1, 1), D(2021, 1, 1)),
        ],
        OPERATIONAL["members"],
    )
    got = rows(constraints.declared_violations({"members": members}))
    assert got == sorted(
        [
            ("members member_name required", "M2", "member_name is NULL"),
            ("members member_tel unique", "t1", "2 rows"),
            ("members member_email unique", "e1", "2 rows"),
            ("members member_gender", "M2", "member_gender is other, not one of female, male"),
            ("members member_age range", "M2", "member_age is 75, outside 12..74"),
            ("members expire_date required", "M2", "expire_date is NULL"),
            ("members member_tel required", "M3", "member_tel is NULL"),
            ("members member_tel required", None, "member_tel is NULL"),
            ("members member_age required", "M3", "member_age is NULL"),
            ("members member_status", "M3", "member_status is gone, not one of active, expire"),
            ("members member_id required", None, "member_id is NULL"),
        ],
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )
    schedules = spark.createDataFrame(
        [("a", "s", "p|q", D(2020, 1, 1)), ("b", "s", "p|q", D(2020, 1, 1)), ("c", "s", "p", D(2020, 1, 1)), ("d", "s", None, D(2020, 1, 1))],
        OPERATIONAL["shift_schedules"],
    )
    found = rows(constraints.declared_violations({"shift_schedules": schedules}), "rule", "key")
    assert ("shift_schedules staff_id, shift_date unique", "p|q|2020-01-01") in found and len(found) == 2
    discounts = spark.createDataFrame(
        [("D1", "n", Decimal(101), D(2020, 1, 2), D(2020, 1, 2)), ("D2", "n", None, D(2020, 1, 2), None)], OPERATIONAL["discounts"]
    )
    assert rows(constraints.declared_violations({"discounts": discounts}), "rule", "key") == [
        ("discounts discount_rate range", "D1"), ("discounts discount_start before discount_end", "D1"),
    ]
    assert constraints.declared_violations({"members": members.limit(0)}).count() == 0


def test_rules_of_a_table_take_one_scan_and_one_grouping(spark, tmp_path):
    path = str(tmp_path / "members")
    spark.createDataFrame([], OPERATIONAL["members"]).write.parquet(path)
    members = spark.read.schema(OPERATIONAL["members"]).parquet(path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(constraints.row_violations("members", members)).count("FileScan") == 1
    unique = plan(constraints.unique_violations("members", members))
    assert unique.count("FileScan") == 1 and unique.count("Exchange") == 1
