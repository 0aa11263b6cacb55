"""Building the warehouse and adding to it."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, functions as F

from shelfstar.operators.calendar import dim_date, extend_calendar
from shelfstar.operators.upsert import absent
from shelfstar.plans import dims, facts
from shelfstar.session import settle


@dataclass(frozen=True)
class Sources:
    """Operational tables of one load."""

    members: DataFrame
    titles: DataFrame
    copies: DataFrame
    suppliers: DataFrame
    loans: DataFrame
    book_orders: DataFrame
    sales_details: DataFrame
    discounts: DataFrame
    purchase_orders: DataFrame
    purchase_details: DataFrame


@dataclass(frozen=True)
class Star:
    """The star schema, or the rows to add to one."""

    dim_date: DataFrame
    dim_book: DataFrame
    dim_members: DataFrame
    dim_suppliers: DataFrame
    fact_purchase: DataFrame
    fact_borrowing: DataFrame
    fact_sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def plus(self, rows: Star) -> Star:
        added = rows.tables()
        return Star(**{n: df.unionByName(added[n]) for n, df in self.tables().items()})


def _keyed(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension as facts look their keys up in it, with a key that cannot be NULL. Every row they find was numbered by the load,
    but a table that is read back does not say so, and comparing keys that may be NULL costs `absent` a further shuffle."""
    return dimension.withColumn(key, F.coalesce(key, F.lit(0).cast(dimension.schema[key].dataType)))


def initial_load(
    src: Sources, days: DataFrame, holidays: DataFrame, as_of, since: str = dims.HISTORY_START
) -> Star:
    """All dimensions and facts.

    The dimensions are computed once, since every fact looks its keys up in
    them; the facts are lazy, to be written with `sources.tables`.
    """
    date = settle(dim_date(days, holidays))
    book = settle(dims.dim_book(src.titles, since))
    members = settle(dims.dim_members(src.members, as_of))
    suppliers = settle(dims.dim_suppliers(src.suppliers))
    days, books = _keyed(date, "date_key"), _keyed(book, "book_key")
    people, sellers = _keyed(members, "member_key"), _keyed(suppliers, "supplier_key")
    return Star(
        date,
        book,
        members,
        suppliers,
        facts.fact_purchase(src.purchase_orders, src.purchase_details, days, books, sellers),
        facts.fact_borrowing(src.loans, src.copies, days, people, books, as_of),
        facts.fact_sales(
            src.sales_details, src.book_orders, src.titles, src.discounts, days, people, books
        ),
    )


def batch_rows(
    star: Star, batch: Sources, first_day, last_day, as_of, since: str = dims.HISTORY_START
) -> Star:
    """Missing days and dimension rows, and all fact rows of a batch, those that are there already among them."""
    new_days = settle(extend_calendar(star.dim_date, first_day, last_day))
    new_books = settle(dims.new_books(star.dim_book, batch.titles, since))
    new_members = settle(dims.new_members(star.dim_members, batch.members, as_of))
    new_suppliers = settle(dims.new_suppliers(star.dim_suppliers, batch.suppliers))
    date = star.dim_date.unionByName(new_days)
    book = star.dim_book.unionByName(new_books)
    members = star.dim_members.unionByName(new_members)
    suppliers = star.dim_suppliers.unionByName(new_suppliers)
    return Star(
        new_days,
        new_books,
        new_members,
        new_suppliers,
        facts.fact_purchase(batch.purchase_orders, batch.purchase_details, date, book, suppliers),
        facts.fact_borrowing_incremental(batch.loans, batch.copies, date, members, book, as_of),
        facts.fact_sales(
            batch.sales_details,
            batch.book_orders,
            batch.titles,
            batch.discounts,
            date,
            members,
            book,
            "incremental",
        ),
    )


def incremental_load(
    star: Star, batch: Sources, first_day, last_day, as_of, since: str = dims.HISTORY_START
) -> Star:
    """The rows a batch adds: missing days, new dimension keys and absent fact keys.

    Applied again after its rows were added, the same batch gives no rows. `sources.store` does the same on
    partitioned tables, where it reads the months of the batch only.
    """
    rows = batch_rows(star, batch, first_day, last_day, as_of, since)
    present = star.tables()
    return replace(rows, **{n: absent(getattr(rows, n), present[n], k, unique=True) for n, k in facts.FACT_KEYS.items()})


def row_counts(rows: Star) -> DataFrame:
    """Rows per table, e.g. of an increment.

    Tables are counted one after another: as one plan, the driver would hold the plans and broadcasts of all of them at once, and
    the disk their shuffles.
    """
    counts = [(name, df.count()) for name, df in rows.tables().items()]
    spark = rows.dim_date.sparkSession
    return spark.createDataFrame(counts, "table_name string, inserted bigint")
