from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfstar.operators import calendar
from shelfstar.plans.load import Sources, incremental_load, initial_load, row_counts
from shelfstar.sources import tables
from shelfstar.sources.schemas import OPERATIONAL, STAR
from shelfstar.streaming.increments import append_new_rows
from tests.conftest import rows

D = dt.date
AS_OF = "2021-06-30"


@pytest.fixture(scope="module")
def sources(spark):
    def t(name, *data):
        return spark.createDataFrame(list(data), OPERATIONAL[name])

    address = "1 Road, Ipoh, Perak, Malaysia"
    return Sources(
        members=t("members", *[
            (m, f" name {m}", m, m, "female", 30, address, "active", D(2019, 1, 1), D(2025, 1, 1)) for m in ("M1", "M2")
        ]),
        titles=t("book_titles", ("B1", "one", "x", "Fiction", 2000, Decimal("5"), Decimal("10"), None),
                 ("B2", "two", "y", "History", 2001, Decimal("6"), Decimal("20"), Decimal("4.5"))),
        copies=t("book_copies", ("C1", "B1", "available"), ("C2", "B2", "available")),
        suppliers=t("suppliers", ("S1", "sup", "p", "t", "Block, Road, Ipoh, Perak, 30000, Malaysia")),
        loans=t("borrowed_books",
                ("L1", "M1", "C1", D(2021, 1, 4), D(2021, 1, 14), D(2021, 1, 20), "Returned", None),
                ("L2", "M1", "C1", D(2021, 1, 4), D(2021, 1, 14), None, "Lost", None),
                ("L3", "M2", "C2", D(2021, 2, 1), D(2021, 2, 11), D(2021, 2, 5), "Returned", None)),
        book_orders=t("book_orders", ("O1", "P1", "D1", "M1", D(2021, 3, 3)), ("O2", "P2", None, "M2", None)),
        sales_details=t("sales_details", ("X1", "O1", "B1", 2, Decimal("1"), Decimal("19")),
                        ("X2", "O1", "B2", -1, None, None), ("X3", "O2", "B2", 1, None, Decimal("20"))),
        discounts=t("discounts", ("D1", "Opening", Decimal("5"), D(2021, 1, 1), D(2021, 12, 31))),
        purchase_orders=t("purchase_orders", ("PO1", "S1", D(2021, 4, 4), Decimal("99.99"), "Received")),
        purchase_details=t("purchase_details", ("a", "PO1", "B1", 3), ("b", "PO1", "B1", None), ("c", "PO1", "B2", 4)),
    )


@pytest.fixture(scope="module")
def star(spark, sources):
    days = calendar.days_between(spark, "2021-01-01", "2021-12-31")
    return initial_load(sources, days, calendar.fixed_holidays(spark, 2000, 2025), AS_OF, "2000-01-01")


def test_initial_load(star):
    members = rows(star.dim_members, "member_id", "member_name", "state", "city", "member_gender", "member_duration")
    assert members[0] == ("M1", "NAME M1", "PERAK", "IPOH", "F", "2.5 years")
    assert rows(star.dim_suppliers, "state", "city") == [("PERAK", "IPOH")]
    popularity = rows(star.dim_book, "book_id", F.col("popularity").cast("string"))
    assert popularity == [("B1", "3.0"), ("B2", "4.5")]
    lent = star.fact_borrowing.join(star.dim_book, "book_key")
    # Two loans of one member, book and day become one row; half of the book's loans came back.
    assert rows(lent, "book_id", "overdue_days", "borrow_duration", F.col("return_rate").cast("string")) == [
        ("B1", 167, 177, "50.00"), ("B2", 0, 4, "100.00"),
    ]
    bought = star.fact_purchase.join(star.dim_book, "book_key")
    assert rows(bought, "book_id", "quantity", F.col("total_amount").cast("string"), "flag_ind") == [
        ("B1", 3, "99.99", "Y"), ("B2", 4, "99.99", "Y"),
    ]
    assert rows(star.fact_sales, "sales_id", F.col("line_total").cast("string"), "discount_desc", "quantity") == [
        ("X1", "19.00", "Opening", 2), ("X2", "0.00", "Opening", 0),
    ]


def test_star_columns_match_the_declared_schema(spark, star):
    for name, df in star.tables().items():
        declared = spark.createDataFrame([], STAR[name]).schema
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared], name


def test_second_run_of_a_batch_adds_nothing(spark, sources, star, tmp_path):
    folder = str(tmp_path / "star")
    tables.save_star(star, folder)
    later = replace(
        sources,
        loans=sources.loans.unionByName(sources.loans.where("borrow_id = 'L3'").withColumn("borrow_date", F.lit(D(2022, 1, 2)))),
        titles=sources.titles.unionByName(sources.titles.where("book_id = 'B1'").withColumn("book_id", F.lit("B3"))),
    )
    stored = tables.load_star(spark, folder)
    fresh = incremental_load(stored, later, "2021-12-01", "2022-01-31", AS_OF, "2000-01-01")
    counts = dict(rows(row_counts(fresh)))
    assert counts == {
        "dim_date": 31, "dim_book": 1, "dim_members": 0, "dim_suppliers": 0,
        "fact_purchase": 0, "fact_borrowing": 1, "fact_sales": 0,
    }
    assert rows(fresh.dim_book, "book_id", "book_key", "book_status") == [("B3", 100003, "available")]
    tables.save_star(fresh, folder)
    again = incremental_load(tables.load_star(spark, folder), later, "2021-12-01", "2022-01-31", AS_OF, "2000-01-01")
    assert set(dict(rows(row_counts(again))).values()) == {0}


def test_sinks(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    batch = tables.literal_rows(spark, [(1, "a"), (2, "b")], schema)
    tables.refresh(batch, path)
    tables.insert_new(tables.literal_rows(spark, [(2, "x"), (3, "c")], schema), path, ["k"], schema)
    tables.insert_new(tables.literal_rows(spark, [(2, "x"), (3, "c")], schema), path, ["k"], schema)
    assert rows(tables.read_table(spark, path, schema)) == [(1, "a"), (2, "b"), (3, "c")]
    tables.publish(tables.read_table(spark, path, schema), "published")
    assert spark.sql("SELECT count(*) FROM published").first()[0] == 3
    report = str(tmp_path / "report")
    tables.write_report(tables.read_table(spark, path, schema), report, ["v"])
    assert spark.read.csv(report, header=True).count() == 3


def test_stream_adds_every_key_once(spark, tmp_path):
    schema = "k int, v string"
    inbox, path, mark = (str(tmp_path / n) for n in ("inbox", "table", "mark"))
    tables.refresh(tables.literal_rows(spark, [(1, "a")], schema), path)
    for batch in ([(1, "x"), (2, "b"), (2, "b")], [(2, "y"), (3, "c")]):
        tables.append(tables.literal_rows(spark, batch, schema), inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        append_new_rows(stream, path, ["k"], mark).awaitTermination()
    assert rows(tables.read_table(spark, path, schema)) == [(1, "a"), (2, "b"), (3, "c")]


def test_tables_are_counted_one_after_another(spark, star, monkeypatch):
    """No plan holds the joins of several facts, so the driver holds the broadcasts of one fact at a time."""
    want = {n: df.count() for n, df in star.tables().items()}
    unions = []
    monkeypatch.setattr(type(star.dim_date), "unionByName", lambda *a, **b: unions.append(a))
    assert dict(rows(row_counts(star))) == want and not unions
