"""The purchase, lending and sales facts.

Lines are reduced to the grain of the fact before they meet a dimension where
the semantics allow it, and every join is many-to-one. Versioned dimensions are
joined as of the day of the fact, so history does not multiply rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstar.functions.dates import as_date, loan_days, overdue_days
from shelfstar.functions.labels import received_flag, return_score
from shelfstar.functions.numbers import count_percent, nonneg, ratio
from shelfstar.operators.asof import asof_lookup
from shelfstar.operators.lookup import attach, merged_if_large
from shelfstar.operators.upsert import absent, insert_absent

NO_DISCOUNT = "No Discount"
DISCOUNT_COLUMNS = (
    "discount_id",
    "discount_name",
    "discount_rate",
    "discount_start",
    "discount_end",
)

PURCHASE_KEY = ["date_key", "book_key", "supplier_key", "purchase_order_id"]
BORROWING_KEY = ["date_key", "member_key", "book_key"]
SALES_KEY = ["sales_id"]
FACT_KEYS = {"fact_purchase": PURCHASE_KEY, "fact_borrowing": BORROWING_KEY, "fact_sales": SALES_KEY}


# The discount that stands for none.
DEFAULT_DISCOUNT = ("D000", NO_DISCOUNT, "0", "2004-07-01", "2024-06-30")


def with_default_discount(discounts: DataFrame) -> DataFrame:
    """The discounts with the row that stands for none, unless it is there already."""
    text = discounts.sparkSession.createDataFrame([DEFAULT_DISCOUNT], list(DISCOUNT_COLUMNS))
    row = text.select(
        *[F.col(c).cast(discounts.schema[c].dataType).alias(c) for c in DISCOUNT_COLUMNS]
    )
    return insert_absent(discounts.select(*DISCOUNT_COLUMNS), row, ["discount_id"])


def discount_on_day(orders: DataFrame, discounts: DataFrame, day: str = "sales_date") -> DataFrame:
    """Orders with the discount active on their day; the lowest id where several are.

    A window without a start or an end is open there. Windows are cut to the days
    of the orders, spread to days and reduced to one discount per day, a table
    bounded by the calendar, so the orders meet it in a broadcast equality join.
    """
    low, high = orders.agg(F.min(day)).scalar(), orders.agg(F.max(day)).scalar()
    start = F.greatest("discount_start", low).alias("start")
    end = F.least("discount_end", high).alias("end")
    span = F.sequence("start", "end")
    best = (
        discounts.where(F.coalesce(F.col("discount_start") <= F.col("discount_end"), F.lit(True)))
        .select("discount_id", "discount_rate", start, end)
        .where("start <= end")
        .select("discount_id", "discount_rate", F.explode(span).alias(day))
        .groupBy(day)
        .agg(F.min(F.struct("discount_id", "discount_rate")).alias("d"))
        .select(day, "d.*")
    )
    bare = orders.drop("discount_id", "discount_rate")
    return bare.join(F.broadcast(best), day, "left").select(
        *bare.columns,
        F.coalesce("discount_id", F.lit(DEFAULT_DISCOUNT[0])).alias("discount_id"),
        F.coalesce("discount_rate", F.lit(0)).cast("decimal(8,2)").alias("discount_rate"),
    )


def rows_without_day(rows: DataFrame, dim_date: DataFrame, day: str) -> DataFrame:
    """Rows whose day is NULL or not in the calendar: a load would leave them out, so look here first."""
    days = dim_date.select(F.col("cal_date").alias(day))
    return rows.join(F.broadcast(days), day, "left_anti").select(*rows.columns)


def _on_day(rows: DataFrame, dim_date: DataFrame, day: str) -> DataFrame:
    """Attach date_key; the calendar is bounded, so it is broadcast."""
    days = dim_date.select("date_key", F.col("cal_date").alias(day))
    return rows.join(F.broadcast(days), day)


def fact_purchase(
    orders: DataFrame,
    details: DataFrame,
    dim_date: DataFrame,
    dim_book: DataFrame,
    dim_suppliers: DataFrame,
) -> DataFrame:
    """Quantity per order and book; total_amount is the order total on every line."""
    lines = details.groupBy("purchase_order_id", "book_id").agg(
        F.sum(nonneg(F.col("quantity"))).alias("quantity")
    )
    headers = orders.where(F.col("purchase_date").isNotNull()).select(
        "purchase_order_id",
        "supplier_id",
        F.to_date("purchase_date").alias("day"),
        F.round(nonneg(F.col("total_amount")), 2).cast("decimal(18,2)").alias("total_amount"),
        received_flag(F.col("order_status")).alias("flag_ind"),
    )
    placed = _on_day(headers, dim_date, "day")
    placed = attach(placed, dim_suppliers.select("supplier_id", "supplier_key"), "supplier_id")
    rows = lines.join(placed, "purchase_order_id")
    return asof_lookup(rows, dim_book, "book_id", "book_key", "day").select(
        "date_key",
        "book_key",
        "supplier_key",
        F.col("quantity").cast("bigint").alias("quantity"),
        "total_amount",
        "flag_ind",
        "purchase_order_id",
    )


def _loan_rows(
    loans: DataFrame,
    copies: DataFrame,
    dim_date: DataFrame,
    dim_members: DataFrame,
    dim_book: DataFrame,
    as_of,
    extra: list,
    rates: DataFrame | None = None,
) -> DataFrame:
    today = as_date(as_of)
    dated_loans = loans.where(F.col("borrow_date").isNotNull())
    titled = attach(dated_loans, copies.select("copy_id", "book_id"), "copy_id")
    rows = titled.select(
        "member_id",
        "book_id",
        F.to_date("borrow_date").alias("day"),
        overdue_days(F.col("due_date"), F.col("return_date"), today).alias("overdue_days"),
        loan_days(F.col("borrow_date"), F.col("return_date"), today).alias("borrow_duration"),
        *extra,
    )
    dated = _on_day(rows, dim_date, "day")
    # Both lookups by book come one after the other, so they share a shuffle.
    if rates is not None:
        dated = attach(dated, rates, "book_id", sized_by=dim_book)
    known = asof_lookup(dated, dim_book, "book_id", "book_key", "day")
    return asof_lookup(known, dim_members, "member_id", "member_key", "day")


def return_rates(loans: DataFrame, copies: DataFrame) -> DataFrame:
    """Percent of its loans that were returned, per book."""
    per_copy = (
        loans.where(F.col("borrow_date").isNotNull())
        .groupBy("copy_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("return_status") == "Returned").alias("returned"),
        )
    )
    per_book = (
        attach(per_copy, copies.select("copy_id", "book_id"), "copy_id")
        .groupBy("book_id")
        .agg(F.sum("n").alias("n"), F.sum("returned").alias("returned"))
    )
    return per_book.select(
        "book_id", count_percent(F.col("returned"), F.col("n")).alias("return_rate")
    )


def fact_borrowing(
    loans: DataFrame,
    copies: DataFrame,
    dim_date: DataFrame,
    dim_members: DataFrame,
    dim_book: DataFrame,
    as_of,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Initial lending fact: return_rate is the book's percentage of returned loans.

    Loans of one member, book and day are one row with the longest figures.
    `rates` may hold the `return_rates` if they are known already.
    """
    if rates is None:
        rates = return_rates(loans, copies)
    rows = _loan_rows(loans, copies, dim_date, dim_members, dim_book, as_of, [], rates)
    return rows.groupBy(*BORROWING_KEY).agg(
        F.max("overdue_days").alias("overdue_days"),
        F.max("borrow_duration").alias("borrow_duration"),
        F.max("return_rate").alias("return_rate"),
    )


def fact_borrowing_incremental(
    loans: DataFrame,
    copies: DataFrame,
    dim_date: DataFrame,
    dim_members: DataFrame,
    dim_book: DataFrame,
    as_of,
    present: DataFrame | None = None,
) -> DataFrame:
    """Later lending rows: return_rate is the mean score of the loans (100, 50 or 0).

    Rows whose key is in `present` are left out.
    """
    score = return_score(F.col("return_status")).alias("score")
    rows = _loan_rows(loans, copies, dim_date, dim_members, dim_book, as_of, [score])
    n = "decimal(20,0)"
    fresh = rows.groupBy(*BORROWING_KEY).agg(
        F.max("overdue_days").alias("overdue_days"),
        F.max("borrow_duration").alias("borrow_duration"),
        ratio(F.sum("score").cast(n), F.count("score").cast(n)).alias("return_rate"),
    )
    return fresh if present is None else absent(fresh, present, BORROWING_KEY)


def fact_sales(
    details: DataFrame,
    orders: DataFrame,
    titles: DataFrame,
    discounts: DataFrame,
    dim_date: DataFrame,
    dim_members: DataFrame,
    dim_book: DataFrame,
    load: str = "initial",
) -> DataFrame:
    """One row per sold line. The incremental load prices lines without an amount."""
    sold = orders.where(F.col("sales_date").isNotNull()).select(
        "order_id", "member_id", "discount_id", F.to_date("sales_date").alias("day")
    )
    names = discounts.select("discount_id", "discount_name")
    sold = _on_day(attach(sold, names, "discount_id", "left"), dim_date, "day")
    sold = asof_lookup(sold, dim_members, "member_id", "member_key", "day")
    # Both lookups by book come one after the other, so they share a shuffle.
    rows = details.join(sold, "order_id")
    rows = attach(rows, titles.select("book_id", "sales_price"), "book_id")
    amount, qty = F.col("total_amount"), F.col("quantity_sold")
    if load == "incremental":
        amount = F.coalesce(amount, F.coalesce("sales_price", F.lit(0)) * F.coalesce(qty, F.lit(0)))
    return asof_lookup(rows, dim_book, "book_id", "book_key", "day").select(
        "member_key",
        "book_key",
        "date_key",
        "sales_id",
        F.coalesce("sales_price", F.lit(0)).cast("decimal(18,2)").alias("sales_price"),
        F.coalesce("discount_amount", F.lit(0)).cast("decimal(18,2)").alias("discount"),
        F.coalesce("discount_name", F.lit(NO_DISCOUNT)).alias("discount_desc"),
        F.round(nonneg(amount), 2).cast("decimal(18,2)").alias("line_total"),
        nonneg(qty).cast("bigint").alias("quantity"),
    )


def _reasons(
    rows: DataFrame, table: str, key: str, day: str, dim_date: DataFrame, lookups: dict[str, tuple[str, DataFrame]]
) -> DataFrame:
    """table_name, key and reason of the rows that a load leaves out: the first lookup, in order, that finds nothing. `lookups` maps a
    reason to a column and the ids it must be among."""
    days = dim_date.select(F.col("cal_date").alias("_day"), F.lit(True).alias("_on_day"))
    found = rows.join(F.broadcast(days), F.to_date(day) == F.col("_day"), "left")
    reason = F.when(F.col("_on_day").isNull(), "no day")
    for k, (why, (column, ids)) in enumerate(lookups.items()):
        known = merged_if_large(ids).select(F.col(ids.columns[0]).alias(f"_id_{k}"), F.lit(True).alias(f"_known_{k}")).distinct()
        found = found.join(known, found[column] == F.col(f"_id_{k}"), "left")
        reason = reason.when(F.col(f"_known_{k}").isNull(), why)
    return (
        found.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key"), reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def rejected_rows(
    loans: DataFrame,
    copies: DataFrame,
    book_orders: DataFrame,
    sales_details: DataFrame,
    titles: DataFrame,
    purchase_orders: DataFrame,
    purchase_details: DataFrame,
    dim_date: DataFrame,
    dim_members: DataFrame,
    dim_book: DataFrame,
    dim_suppliers: DataFrame,
) -> DataFrame:
    """table_name, key, reason: the rows of a batch that no fact row comes from, because their day is NULL or not in the calendar or
    a copy, member, book, title, order or supplier is not known. One row each, with the first reason in that order."""
    members, books = dim_members.select("member_id"), dim_book.select("book_id")
    lent = loans.join(merged_if_large(copies.select("copy_id", "book_id")), "copy_id", "left")
    sold = sales_details.join(
        book_orders.select(F.col("order_id").alias("_order"), "member_id", "sales_date"),
        F.col("order_id") == F.col("_order"),
        "left",
    )
    bought = purchase_details.select("purchase_order_id", "book_id").join(
        purchase_orders.select(F.col("purchase_order_id").alias("_order"), "supplier_id", "purchase_date"),
        F.col("purchase_order_id") == F.col("_order"),
        "left",
    )
    line = F.concat_ws("|", F.col("purchase_order_id").cast("string"), F.col("book_id").cast("string"))
    parts = [
        _reasons(
            lent, "fact_borrowing", "borrow_id", "borrow_date", dim_date,
            {"no copy": ("copy_id", copies.select("copy_id")), "no member": ("member_id", members), "no book": ("book_id", books)},
        ),
        _reasons(
            sold, "fact_sales", "sales_id", "sales_date", dim_date,
            {"no member": ("member_id", members), "no title": ("book_id", titles.select("book_id")), "no book": ("book_id", books)},
        ),
        _reasons(
            bought.withColumn("_line", line), "fact_purchase", "_line", "purchase_date", dim_date,
            {"no supplier": ("supplier_id", dim_suppliers.select("supplier_id")), "no book": ("book_id", books)},
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
