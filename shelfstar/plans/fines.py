"""Fines from loans, and their settlement by payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstar.functions.dates import as_date
from shelfstar.functions.text import business_id, joined_key
from shelfstar.operators.lookup import attach
from shelfstar.operators.split import SLICE_ROWS, queue, with_slices
from shelfstar.operators.surrogate import assign_keys
from shelfstar.operators.upsert import absent
from shelfstar.session import settle

# Fine types, statuses and amounts.
LATE, LOST, DAMAGE = "Late Return", "Lost Book", "Damage"
UNPAID, PAID = "Unpaid", "Paid"
LATE_AMOUNT = 30
LOST_SURCHARGE = 20
LATE_DAYS = (1, 7)
FINES_PER_PAYMENT = 2


def derive_fines(
    loans: DataFrame,
    copies: DataFrame,
    titles: DataFrame,
    first,
    last,
    present: DataFrame | None = None,
    price: str = "purchase_price",
) -> DataFrame:
    """Lost, late and damage fines of the loans of a period, all unpaid. Loans come with what was recorded at their return in
    `damaged` (boolean; NULL: not).

    One pass over the loans; a loan may give a late and a damage fine. Fines
    whose (borrow_id, fine_type) is in `present` are left out, and ids go on after
    the highest one there. The rows are settled before they are numbered, so the
    loans are read once.
    """
    prices = attach(copies.select("copy_id", "book_id"), titles.select("book_id", price), "book_id")
    status, returned = F.upper("return_status"), F.col("return_date")
    late_by = F.datediff(returned, F.col("due_date"))
    back = returned.isNotNull()
    lost = status == "LOST"
    late = back & status.isin("OVERDUE", "RETURNED") & late_by.between(*LATE_DAYS)
    damaged = back & (status == "RETURNED") & F.coalesce("damaged", F.lit(False))
    lost_day = F.least(F.coalesce(returned, F.date_add("due_date", 1)), as_date(last))

    def fine(kind, amount, day):
        return F.struct(
            F.lit(kind).alias("fine_type"),
            amount.cast("decimal(18,2)").alias("fine_amount"),
            day.alias("fine_date"),
        )

    candidates = F.array_compact(
        F.array(
            F.when(lost, fine(LOST, F.col(price) + LOST_SURCHARGE, lost_day)),
            F.when(late, fine(LATE, F.lit(LATE_AMOUNT), returned)),
            F.when(damaged, fine(DAMAGE, F.col(price), returned)),
        )
    )
    period = loans.where(F.col("borrow_date").between(as_date(first), as_date(last)))
    rows = (
        attach(period.where(lost | late | damaged), prices, "copy_id", sized_by=copies)
        .select("borrow_id", "member_id", F.explode(candidates).alias("f"))
        .select("borrow_id", "member_id", "f.*")
    )
    after = None
    if present is not None:
        rows = absent(rows, present, ["borrow_id", "fine_type"])
        number = F.substring("fine_id", 2, 20).cast("bigint")
        after = present.select((number + 100000).alias("fine_key"))
    keyed = rows.withColumn("_id", joined_key(F.col("borrow_id"), F.col("fine_type")))
    return assign_keys(settle(keyed), "_id", "fine_key", after=after).select(
        business_id("F", F.col("fine_key") - 100000, 6).alias("fine_id"),
        "borrow_id",
        "member_id",
        F.lit(None).cast("string").alias("payment_id"),
        "fine_type",
        "fine_amount",
        "fine_date",
        F.lit(UNPAID).alias("fine_status"),
    )


def allocate_payments(fines: DataFrame, payments: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Which payment settles which fine, one row per settled fine.

    Payments of a member are taken by date. Each settles the two oldest unpaid
    lost-book fines dated no later than itself; if there are none, the two
    oldest late or damage fines. `fines` has member_id, fine_id, fine_type,
    fine_amount, fine_date; `payments` has member_id, payment_id, payment_date.
    Ties within a day follow the ids as text. Rows without a member or a date take no part.

    Both queues are worked out over one shuffle of the events by member, or by slices of a member of more than `slice_rows` events:
    payments that find the first queue empty are the services of the second. Fine number j of a queue then meets the payment
    that serves it under (member, queue, j), grouped, not joined.
    """
    unpaid = fines
    if "fine_status" in fines.columns:
        unpaid = fines.where(F.col("fine_status") == UNPAID)
    dated = F.col("member_id").isNotNull() & F.col("day").isNotNull()
    amount = fines.schema["fine_amount"].dataType
    arrivals = unpaid.select(
        "member_id",
        F.col("fine_date").alias("day"),
        F.lit(0).alias("kind"),
        F.col("fine_id").cast("string").alias("id"),
        "fine_amount",
        (F.col("fine_type") == LOST).alias("lost"),
    )
    services = payments.select(
        "member_id",
        F.col("payment_date").alias("day"),
        F.lit(1).alias("kind"),
        F.col("payment_id").cast("string").alias("id"),
        F.lit(None).cast(amount).alias("fine_amount"),
        F.lit(None).cast("boolean").alias("lost"),
    )
    keys, order = ["member_id"], ["day", "kind", "id"]
    events = settle(arrivals.unionByName(services).where(dated))
    events, bucket = with_slices(events, keys, order, slice_rows)
    is_fine, is_payment = F.col("kind") == 0, F.col("kind") == 1
    idle = is_payment & (F.col("l_after") == F.col("l_before"))
    per = FINES_PER_PAYMENT
    events = queue(events, keys, bucket, order, is_fine & F.col("lost"), is_payment, per, "l_")
    events = queue(events, keys, bucket, order, is_fine & ~F.col("lost"), idle, per, "o_")

    def places(q: str, mine: Column) -> Column:
        served = F.when(F.col(f"{q}after") > F.col(f"{q}before"), F.sequence(F.col(f"{q}before") + 1, F.col(f"{q}after")))
        return F.when(is_fine & mine, F.array(F.col(f"{q}place"))).when(is_payment, served)

    first = places("l_", F.col("lost"))
    turns = events.select(
        "member_id",
        first.isNotNull().alias("first"),
        F.explode(F.coalesce(first, places("o_", ~F.col("lost")))).alias("place"),
        F.when(is_fine, F.struct("id", "fine_amount", "day")).alias("fine"),
        F.when(is_payment, F.struct("id", "day")).alias("payment"),
    )
    met = turns.groupBy("member_id", "first", "place").agg(F.max("fine").alias("fine"), F.max("payment").alias("payment"))
    return met.where(F.col("fine").isNotNull() & F.col("payment").isNotNull()).select(
        "member_id",
        F.col("fine.id").alias("fine_id"),
        "fine.fine_amount",
        F.col("fine.day").alias("fine_date"),
        F.col("payment.id").alias("payment_id"),
        F.col("payment.day").alias("payment_date"),
    )


def payments_of(allocations: DataFrame) -> DataFrame:
    """Payments with the sum of the fines they settle."""
    return allocations.groupBy("payment_id", "member_id", "payment_date").agg(
        F.sum("fine_amount").cast("decimal(18,2)").alias("pay_amount"),
        F.count(F.lit(1)).alias("fines_paid"),
    )
