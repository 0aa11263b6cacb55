from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfstar.plans.fines import allocate_payments, derive_fines, payments_of
from tests.conftest import rows

D = dt.date


def one_by_one(fines, payments):
    """Every payment in date order takes up to two fines."""
    paid, out = set(), []
    for member, pay, day in sorted(payments, key=lambda p: (p[0], p[2], p[1])):
        mine = sorted(
            (f for f in fines if f[0] == member and f[1] not in paid and f[4] <= day),
            key=lambda f: (f[4], f[1]),
        )
        lost = [f for f in mine if f[2] == "Lost Book"]
        for f in (lost or mine)[:2]:
            paid.add(f[1])
            out.append((f[1], pay))
    return sorted(out)


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_allocation_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    day = lambda: D(2021, 1, 1) + dt.timedelta(days=rng.randrange(150))
    who = lambda i: "hot" if i % 3 else f"m{i % 5}"
    fines = [
        (who(i), f"F{i:04d}", rng.choice(["Lost Book", "Late Return", "Damage"]), Decimal(30), day())
        for i in range(180)
    ]
    payments = [(who(i), f"P{i:04d}", day()) for i in range(110)]
    got = allocate_payments(
        spark.createDataFrame(fines, "member_id string, fine_id string, fine_type string, fine_amount decimal(18,2), fine_date date"),
        spark.createDataFrame(payments, "member_id string, payment_id string, payment_date date"),
    )
    assert rows(got, "fine_id", "payment_id") == one_by_one(fines, payments)
    assert {r.fines_paid for r in payments_of(got).collect()} <= {1, 2}


def test_fine_kinds_and_edges(spark):
    due = D(2021, 1, 11)
    loans = [("b0", None, "Lost")]
    for late in (0, 1, 7, 8):
        loans.append((f"b{late + 1}", due + dt.timedelta(days=late), "Returned"))
    df = spark.createDataFrame(
        [(b, "m", "c", D(2021, 1, 1), due, r, s, False) for b, r, s in loans],
        "borrow_id string, member_id string, copy_id string, borrow_date date, due_date date, return_date date, return_status string, damaged boolean",
    )
    copies = spark.createDataFrame([("c", "k")], "copy_id string, book_id string")
    titles = spark.createDataFrame([("k", Decimal("12.50"))], "book_id string, purchase_price decimal(6,2)")
    got = derive_fines(df, copies, titles, "2021-01-01", "2021-12-31")
    assert rows(got, "borrow_id", "fine_type", F.col("fine_amount").cast("string"), "fine_date") == [
        ("b0", "Lost Book", "32.50", D(2021, 1, 12)),
        ("b2", "Late Return", "30.00", D(2021, 1, 12)),
        ("b8", "Late Return", "30.00", D(2021, 1, 18)),
    ]
    assert rows(got, "fine_id") == [("F000001",), ("F000002",), ("F000003",)]
    again = derive_fines(df, copies, titles, "2021-01-01", "2021-12-31", got)
    assert again.count() == 0
    damaged = derive_fines(df.withColumn("damaged", F.lit(True)), copies, titles, "2021-01-01", "2021-12-31")
    assert damaged.where("fine_type = 'Damage'").count() == 4


@pytest.mark.parametrize("slice_rows", [7, 40])
def test_allocation_over_slices_of_a_hot_day(spark, slice_rows):
    rng = random.Random(slice_rows)
    day = lambda i: D(2021, 5, 5) if i % 3 == 0 else D(2021, 1, 1) + dt.timedelta(days=rng.randrange(200))
    who = lambda i: "hot" if i % 3 < 2 else f"m{i % 5}"
    fines = [(who(i), f"F{i:04d}", rng.choice(["Lost Book", "Late Return", "Damage"]), Decimal(30), day(i)) for i in range(240)]
    payments = [(who(i), f"P{i:04d}", day(i)) for i in range(130)]
    got = allocate_payments(
        spark.createDataFrame(fines + [(None, "FX", "Damage", Decimal(1), D(2021, 1, 1)), ("hot", "FY", "Damage", Decimal(1), None)], FINES),
        spark.createDataFrame(payments + [(None, "PX", D(2021, 2, 2)), ("hot", "PY", None)], PAYMENTS),
        slice_rows,
    )
    assert rows(got, "fine_id", "payment_id") == one_by_one(fines, payments)


FINES = "member_id string, fine_id string, fine_type string, fine_amount decimal(18,2), fine_date date"
PAYMENTS = "member_id string, payment_id string, payment_date date"


def test_settlement_shuffles_events_once(spark):
    fines, payments = spark.createDataFrame([("m", "F1", "Damage", Decimal(1), D(2021, 1, 1))], FINES), spark.createDataFrame([("m", "P1", D(2021, 1, 2))], PAYMENTS)
    plan = allocate_payments(fines, payments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert allocate_payments(fines.limit(0), payments).count() == 0
    assert allocate_payments(fines, payments.limit(0)).count() == 0
