from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfstar.functions import dates, labels, numbers, text


def one(spark, schema, values, column):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_segments_count_commas_from_the_right(spark):
    addresses = [("a",), ("a, b",), ("a, b, c",), ("a, b, c, d",), ("a, b, c, d, e",), ("a,, c",), (None,)]
    second = one(spark, "s string", addresses, text.segment_from_right(F.col("s"), 2))
    assert second == ["UNKNOWN", "UNKNOWN", "B", "C", "D", None, "UNKNOWN"]
    fourth = one(spark, "s string", addresses, text.segment_from_right(F.col("s"), 4))
    assert fourth == ["UNKNOWN"] * 4 + ["B", "UNKNOWN", "UNKNOWN"]
    last = one(spark, "s string", addresses, text.segment_from_right(F.col("s"), 1))
    assert last[:3] == ["UNKNOWN", "B", "C"]


def test_text_cleaning(spark):
    values = [("  x ",), ("",), (None,)]
    assert one(spark, "s string", values, text.clean_upper(F.col("s"), "NONE")) == ["X", "NONE", "NONE"]
    genres = [("Non Fiction",), ("Nonfiction",), ("NON-fiction",), (" History",)]
    got = one(spark, "s string", genres, text.normalised_genre(F.col("s")))
    assert got == ["NON-FICTION"] * 3 + ["HISTORY"]
    assert one(spark, "s string", [("M0042",), ("x",)], text.id_number(F.col("s"))) == [42, None]
    ids = one(spark, "n long", [(7,), (123456,)], text.business_id("B", F.col("n"), 4))
    assert ids == ["B0007", "B123456"]


def test_age_edges(spark):
    ages = [(None,), (100,), (17,), (18,), (25,), (26,), (40,), (41,), (55,), (56,), (70,), (71,), (101,)]
    assert one(spark, "a int", ages, labels.age_range(F.col("a"))) == [
        "UNKNOWN", "UNKNOWN", "BELOW 18", "18 TO 25", "18 TO 25", "26 TO 40", "26 TO 40",
        "41 TO 55", "41 TO 55", "56 TO 70", "56 TO 70", "71+", "71+",
    ]


def test_codes(spark):
    genders = [(" Female",), ("male",), ("x",), (None,)]
    assert one(spark, "g string", genders, labels.gender_code(F.col("g"))) == ["F", "M", "U", "U"]
    states = [("Returned",), ("lost",), ("Overdue",), (None,)]
    assert one(spark, "s string", states, labels.return_score(F.col("s"))) == [100, 0, 50, 50]


def test_preference_edge_is_exclusive(spark):
    pairs = [(110, 100), (111, 100), (100, 110), (100, 111), (0, 0)]
    got = one(spark, "b long, s long", pairs, labels.preference_flag(F.col("b"), F.col("s")))
    assert got == ["Balanced", "Borrowing Higher", "Balanced", "Sales Higher", "Balanced"]


def test_priority_uses_the_unrounded_share(spark):
    shares = [(D("29.996"),), (D("30"),), (D("14.996"),), (D("15"),)]
    got = one(spark, "v decimal(18,3)", shares, labels.priority_flag(F.col("v"), F.lit(100)))
    assert got == ["MED", "HIGH", "LOW", "MED"]


@pytest.mark.parametrize(
    "part, whole, expected",
    [(1, 3, "33.33"), (2, 3, "66.67"), (1, 800, "0.13"), (-1, 800, "-0.13"), (-1, 3, "-33.33"), (5, 0, None), (None, 3, None)],
)
def test_percent_rounds_half_away_from_zero(spark, part, whole, expected):
    got = one(spark, "a long, b long", [(part, whole)], numbers.count_percent(F.col("a"), F.col("b")))[0]
    assert got == (None if expected is None else D(expected))


def test_ratio_has_no_double_rounding(spark):
    # 1234499999 / 10^9 would first round to 1.234500 and then up to 1.235.
    got = one(spark, "a long, b long", [(1234499999, 10**9)], numbers.ratio(
        F.col("a").cast("decimal(20,0)"), F.col("b").cast("decimal(20,0)"), 3))[0]
    assert got == D("1.234")


def test_number_helpers(spark):
    values = [(D("-2.00"),), (None,), (D("7.00"),)]
    assert one(spark, "v decimal(5,2)", values, numbers.nonneg(F.col("v"))) == [0, 0, 7]
    assert one(spark, "v decimal(5,2)", values, numbers.clamp(F.col("v"), 1, 5, 3.0)) == [1, 3, 5]
    pairs = [(1, None), (1, 2)]
    assert one(spark, "a int, b int", pairs, numbers.greatest_or_null(F.col("a"), F.col("b"))) == [None, 2]
    assert one(spark, "a int, b int", pairs, numbers.least_or_null(F.col("a"), F.col("b"))) == [None, 1]
    signed = [(D("1.5"),), (D("-0.2"),), (D("0"),), (None,)]
    got = one(spark, "v decimal(9,2)", signed, numbers.signed_percent_text(F.col("v")))
    assert got == ["+1.50%", "-0.20%", "+0.00%", None]
    money = [(D("123456.78"),)]
    cents = numbers.from_cents(numbers.to_cents(F.col("v")))
    assert one(spark, "v decimal(18,2)", money, cents) == [D("123456.78")]


def test_date_helpers(spark):
    d = dt.date
    spans = [(d(2020, 1, 15), d(2021, 7, 15)), (d(2020, 1, 31), d(2020, 2, 29)), (d(2020, 1, 1), d(2022, 4, 1))]
    got = one(spark, "a date, b date", spans, dates.years_text(F.col("b"), F.col("a")))
    assert got == ["1.5 years", "0.1 years", "2.3 years"]
    loans = [
        (d(2020, 1, 10), None), (d(2020, 1, 10), d(2020, 1, 9)), (d(2020, 1, 10), d(2020, 1, 13)),
    ]
    as_of = F.lit("2020-02-10").cast("date")
    assert one(spark, "due date, ret date", loans, dates.overdue_days(F.col("due"), F.col("ret"), as_of)) == [31, 0, 3]
    renew = one(spark, "r date", [(d(2020, 3, 1),)], dates.expiry_after_renewals(F.col("r"), F.lit(1)))
    assert renew == [d(2022, 2, 28)]
    stamps = [("2020-01-01 09:00:00", "2020-01-02 10:59:00"), (None, "2020-01-01 10:00:00")]
    hours = dates.whole_hours(F.to_timestamp("a"), F.to_timestamp("b"))
    assert one(spark, "a string, b string", stamps, hours) == [25, None]
