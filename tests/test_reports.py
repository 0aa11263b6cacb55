from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfstar.catalog import reports
from shelfstar.operators import calendar
from shelfstar.plans import preference, supplier_geo, trend
from shelfstar.sources.commerce import Commerce
from tests.conftest import rows

D = dt.date
SMALL = "/root/testdata/sf0.001"
FIRST = "2020-01-01"


@pytest.fixture(scope="module")
def dim_date(spark):
    days = calendar.days_between(spark, FIRST, "2022-12-31")
    return calendar.dim_date(days, calendar.fixed_holidays(spark, 2000, 2025)).cache()


def key(day):
    return 100001 + (day - D(2020, 1, 1)).days


@pytest.fixture(scope="module")
def lending(spark):
    """Loans per month: Jan 3, Feb 2, (no March), Apr 4 in 2020; Jan 1 in 2021."""
    loans = []
    for day, books in [
        (D(2020, 1, 5), "aab"), (D(2020, 2, 9), "ab"), (D(2020, 4, 1), "bbcc"), (D(2021, 1, 31), "c"),
    ]:
        loans += [(key(day), b, "m1") for b in books]
    return spark.createDataFrame(loans, "date_key bigint, book_key string, member_key string")


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame([("a", "ART"), ("b", "BIO"), ("c", None)], "book_key string, genre string")


@pytest.fixture(scope="module")
def trend_args(spark, dim_date, lending, books):
    spans = spark.createDataFrame(
        [(D(2020, 1, 5), D(2020, 1, 31)), (D(2020, 1, 5), D(2020, 2, 1)), (D(2020, 2, 9), None), (None, None)],
        "start date, end date",
    )
    copies = spark.createDataFrame(
        [("available",), ("Unavailable",), (None,), ("borrowed",)], "book_status string"
    )
    return lending, dim_date, books, spans, copies


def test_trend_month(trend_args):
    got = {(r.year, r.month_num): r for r in trend.trend_month(*trend_args).collect()}
    assert [got[k].borrows for k in sorted(got)] == [3, 2, 4, 1]
    assert [got[k].top_genre for k in sorted(got)] == ["ART", "ART/BIO", "BIO", None]
    assert [got[k].prev_month_borrows for k in sorted(got)] == [None, 3, 2, None]
    assert [str(got[k].moving_avg_3) for k in sorted(got)] == ["3.00", "2.50", "3.00", "1.00"]
    # Returned on the month's last day is no longer open.
    assert [got[k].active_loans_end for k in sorted(got)] == [1, 1, 1, 1]
    assert {r.net_copies_available for r in got.values()} == {2}
    assert str(got[(2020, 2)].mom_pct) == "-33.33"
    assert got[(2020, 1)].festive_events == "Yes" and got[(2020, 4)].festive_events == "No"
    # Means: Jan (3 + 1) / 2 = 2, Feb 2, Apr 4; overall 8 / 3.
    assert [str(got[k].seasonal_index_pct) for k in sorted(got)] == ["-25.00", "-25.00", "50.00", "-25.00"]


def test_missing_months_become_zero_rows(trend_args):
    got = {(r.year, r.month_num): r for r in trend.trend_month(*trend_args, spine=True).collect()}
    assert len(got) == 13
    assert got[(2020, 3)].borrows == 0 and got[(2020, 4)].mom_pct is None
    assert got[(2021, 1)].prev_year_borrows == 3


def test_trend_levels(trend_args):
    both = trend.trend_month_quarter(*trend_args)
    quarters = both.where("grain = 'QUARTER'")
    assert rows(quarters, "year_quarter", "borrows", "prev_period_borrows", "period_end_date") == [
        ("2020-Q1", 5, None, D(2020, 2, 29)), ("2020-Q2", 4, 5, D(2020, 4, 30)), ("2021-Q1", 1, None, D(2021, 1, 31)),
    ]
    report = trend.trend_report(*trend_args, 2020, 2020)
    ordered = report.orderBy("sort_year", "sort_quarter", "sort_row").collect()
    assert [r.period_label for r in ordered] == [
        "Q1    Jan", "      Feb", "Q1 Total", "Q2    Apr", "Q2 Total", "Total", "Grand Total",
    ]
    assert [r.borrows for r in ordered] == [3, 2, 5, 4, 4, 9, 9]
    assert [r.year for r in ordered] == [2020] + [None] * 6
    # Only 2020 counts for the season: Jan 3, Feb 2, Apr 4 around 3.
    assert [r.season_var for r in ordered if r.season_var] == ["+0.00%", "-33.33%", "+33.33%"]


@pytest.fixture(scope="module")
def preference_args(spark, dim_date, books):
    y0, y1 = key(D(2020, 3, 3)), key(D(2021, 3, 3))
    lend = spark.createDataFrame(
        [(y0, "a", "m1"), (y0, "a", "m1"), (y0, "b", "m2"), (y1, "a", "m3"), (y0, "c", "m1")],
        "date_key bigint, book_key string, member_key string",
    )
    sold = spark.createDataFrame(
        [(y0, "a", "m1", Decimal("10.50")), (y0, "c", "m2", Decimal("2.00"))],
        "date_key bigint, book_key string, member_key string, line_total decimal(18,2)",
    )
    genders = spark.createDataFrame([("m1", "M"), ("m2", "F"), ("m3", "U")], "member_key string, gender string")
    return preference.activity(lend, sold, dim_date, books), genders


def test_preference_report(preference_args):
    got = preference.preference_report(*preference_args)
    counts = rows(got, "year", "genre", "borrow_cnt", "sales_cnt", F.col("revenue").cast("string"))
    assert counts == sorted(
        [
            # Loans and sales without a genre do not meet in an outer join.
            ("2020", None, 1, 0, "0.00"), ("2020", None, 0, 1, "2.00"), ("2020", "ART", 2, 1, "10.50"),
            ("2020", "BIO", 1, 0, "0.00"), ("2020", "Total", 4, 2, "12.50"),
            ("2021", "ART", 1, 0, "0.00"), ("2021", "Total", 1, 0, "0.00"),
        ],
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )
    art = got.where("year = '2020' AND genre = 'ART'").first()
    # One man counted for each activity.
    assert (str(art.male_pct), str(art.female_pct), art.preference) == ("100.00", "0.00", "Borrowing Higher")
    assert got.where("year = '2021' AND genre = 'ART'").first().male_pct is None
    total = preference.preference_grand_total(got).first()
    assert (total.borrow_cnt, total.sales_cnt, str(total.revenue)) == (5, 2, "12.50")


def test_preference_view(preference_args):
    got = preference.preference_view(*preference_args)
    assert len(got.columns) == 26
    art = got.where("year = 2020 AND genre = 'ART'").first()
    assert (art.participants_total, art.male_cnt, art.female_cnt) == (1, 1, 0)
    assert str(art.borrow_to_sales_ratio) == "2.000"
    later = got.where("year = 2021 AND genre = 'ART'").first()
    assert (later.borrow_cnt_prev_year, str(later.borrow_yoy_pct)) == (2, "-50.00")
    missing = got.where("genre IS NULL").first()
    assert (missing.borrow_cnt, missing.sales_cnt, missing.participants_total) == (0, 0, 0)
    total = got.where("year = 2020 AND grain_tag = 'YEAR_TOTAL'").first()
    assert (total.borrow_cnt, total.year_genre_key, str(total.borrow_share_of_year_pct)) == (3, "2020|ALL", "100.00")
    shares = got.where("grain_tag = 'GENRE' AND year = 2020").agg(F.sum("borrow_share_of_year_pct")).first()[0]
    assert abs(shares - 100) < Decimal("0.02")


def test_activity_from_the_star_equals_the_direct_one(spark):
    src = Commerce(spark, SMALL)
    who = src.table("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("sold"))
    lines = src.table("lineitem").join(who, F.col("l_orderkey") == F.col("o_orderkey"))
    cols = [F.col("l_partkey").alias("book_key"), F.col("o_custkey").alias("member_key")]
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    net = gross - F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2)
    day = F.to_date("l_shipdate")
    lend = lines.select(calendar.date_key(day, src.first_and_last[0]).alias("date_key"), *cols)
    sold = lines.select(calendar.date_key(F.col("sold"), src.first_and_last[0]).alias("date_key"), *cols, net.alias("line_total"))
    star = preference.activity(lend, sold, src.calendar(), src.book_genres())
    direct = reports.line_activity(src)
    args = ["year", "genre", "member_key", "borrow_cnt", "sales_cnt", F.col("revenue").cast("decimal(18,2)")]
    assert rows(star, *args) == rows(direct, *args)


def test_order_values(spark):
    lines = spark.createDataFrame(
        [
            ("header", "s1", Decimal("9.00"), 1), ("header", "s1", Decimal("9.00"), 2),
            ("lines", "s1", Decimal("9.00"), 1), ("lines", "s1", Decimal("1.00"), None),
            ("one", "s2", Decimal("4.00"), 5),
        ],
        "purchase_order_id string, supplier_key string, total_amount decimal(18,2), quantity bigint",
    )
    got = supplier_geo.po_values(lines, carry=("supplier_key",))
    assert rows(got, "purchase_order_id", F.col("order_value").cast("string"), "order_qty") == [
        ("header", "9.00", 3), ("lines", "10.00", 1), ("one", "4.00", 5),
    ]


@pytest.fixture(scope="module")
def months(spark, dim_date):
    def order(n, supplier, day, value):
        return (f"p{n}", supplier, key(day), Decimal(value), 1)

    orders = spark.createDataFrame(
        [
            order(1, "s1", D(2020, 1, 3), "60"), order(2, "s2", D(2020, 1, 4), "30"),
            order(3, "s2", D(2020, 1, 5), "30"), order(4, "s3", D(2020, 2, 5), "60"),
            order(5, "s1", D(2020, 5, 5), "80"),
        ],
        "purchase_order_id string, supplier_key string, date_key bigint, order_value decimal(28,2), order_qty bigint",
    )
    places = spark.createDataFrame(
        [("s1", "Zed", "rome"), ("s2", "Abe", "oslo"), ("s3", "Bob", None)],
        "supplier_key string, supplier_name string, city string",
    )
    return supplier_geo.supplier_months(orders, dim_date, places)


def test_supplier_report(months):
    got = supplier_geo.supplier_geo_report(months, "m")
    detail = got.where("sort_section = 1").orderBy("sort_period", "city").collect()
    assert [(r.period, r.city, r.top_supplier, r.priority) for r in detail] == [
        # Equal value: more orders win.
        ("Jan", "OSLO", "Abe", "HIGH"), ("Jan", "ROME", None, "HIGH"),
        ("Feb", "OTHERS", "Bob", "HIGH"), ("May", "ROME", "Zed", "HIGH"),
    ]
    total = got.where("sort_section = 3").first()
    assert (total.city, total.orders, str(total.value_rm), total.top_supplier) == ("Year Total:", 5, "260.00", "Zed")
    shares = got.where("sort_section = 1").groupBy("sort_period").agg(F.sum("contrib_pct").alias("s"))
    assert {str(r.s) for r in shares.collect()} == {"100.00"}
    quarters = supplier_geo.supplier_geo_report(months, "Q").where("sort_section = 1")
    # Three suppliers at 60 in the first quarter; Abe has two orders.
    assert quarters.where("city = 'OSLO'").first().top_supplier == "Abe" or quarters.where("top_supplier = 'Abe'").count() == 1
    with pytest.raises(ValueError):
        supplier_geo.supplier_geo_report(months, "Y")


def test_supplier_view(months):
    got = supplier_geo.supplier_geo_view(months)
    assert len(got.columns) == 28
    totals = got.where("tot_row = 1 AND grain = 'MONTH'").orderBy("period_seq").collect()
    assert [str(r.value_rm) for r in totals] == ["120.00", "60.00", "80.00"]
    assert [None if r.delta_value_pct is None else str(r.delta_value_pct) for r in totals] == [None, "-50.00", "33.33"]
    assert [r.period_rank_desc for r in totals] == [3, 2, 1] and totals[-1].is_latest_period == 1
    alone = got.where("grain = 'MONTH' AND month_num = 2 AND tot_row = 0").first()
    assert (alone.city_rank_value_rm, str(alone.contrib_pct), alone.city) == (1, "100.00", "OTHERS")
    sums = got.where("tot_row = 0").groupBy("grain", "period_seq").agg(F.sum("value_rm").alias("v"))
    want = got.where("tot_row = 1").select("grain", "period_seq", F.col("value_rm").alias("v"))
    assert rows(sums) == rows(want)
    assert supplier_geo.year_champion(months).first().top_supplier_year == "Zed"
