"""Distinct keys by bitmaps against sets."""

from __future__ import annotations

import random

from shelfstar.operators import people
from tests.conftest import rows

GRAIN = ["y", "m"]


def _rows():
    rng = random.Random(2)
    keys = [-40_000, -1, 0, 1, 32_768, 32_769, 100_001, 1 << 40]
    out = [(2020 + rng.randrange(2), rng.randrange(3), rng.choice(keys)) for _ in range(60)]
    return [*out, *out[:9], (2020, 1, None), (None, 1, 5), (2030, 2, None)]


def test_counts_at_two_grains(spark):
    given = _rows()
    months = people.key_bitmaps(spark.createDataFrame(given, "y int, m int, k long"), GRAIN, "k")
    seen = {(y, m): {k for a, b, k in given if (a, b) == (y, m) and k is not None} for y, m, _ in given}
    assert rows(people.key_counts(months, GRAIN, "n")) == rows(
        spark.createDataFrame([(*g, len(s)) for g, s in seen.items() if s], "y int, m int, n long")
    )
    years = people.merged(months, ["y"])
    want = {y: len({k for a, _, k in given if a == y and k is not None}) for y, _, _ in given}
    assert dict(people.key_counts(years, ["y"], "n").collect()) == {y: n for y, n in want.items() if n}


def test_counts_by_an_attribute_of_the_keys(spark):
    given = _rows()
    months = people.key_bitmaps(spark.createDataFrame(given, "y int, m int, k long"), GRAIN, "k")
    kinds = {-40_000: "a", -1: "a", 1: "b", 32_769: "b", 100_001: "a", 7: "b", 1 << 41: "c"}
    classes = spark.createDataFrame([*kinds.items(), (None, "a")], "k long, kind string")
    got = people.key_counts_within(months, GRAIN, classes, "k", "kind", "n").collect()
    want = {}
    for y, m, k in given:
        if k in kinds and y is not None:
            want.setdefault((y, m, kinds[k]), set()).add(k)
    assert {tuple(r[:3]): r[3] for r in got if r.y is not None} == {g: len(s) for g, s in want.items()}


def test_no_rows(spark):
    none = people.key_bitmaps(spark.createDataFrame([], "y int, m int, k long"), GRAIN, "k")
    assert people.key_counts(people.merged(none, ["y"]), ["y"], "n").count() == 0


def test_facts_are_read_once(spark):
    """The period bitmaps are settled, so what is counted reads small tables only."""
    from shelfstar.plans import preference

    dim_date = spark.sql("SELECT 1L AS date_key, DATE '2020-01-31' AS cal_date, 2020 AS cal_year UNION ALL SELECT 2L, DATE '2020-02-01', 2020")
    lending = spark.createDataFrame([(1, 7), (2, 7), (2, 8)], "date_key long, member_key long")
    sales = spark.createDataFrame([(1, 7), (1, 9), (3, 9)], "date_key long, member_key long")
    genders = spark.createDataFrame([(7, "M"), (8, "F"), (9, "U")], "member_key long, gender string")
    got = preference.participants_by_period(lending, sales, dim_date, genders)
    assert rows(got) == rows(
        spark.createDataFrame(
            [("MONTH", 2020, 1, 1, 2, 1, 0), ("MONTH", 2020, 1, 2, 2, 1, 1), ("QUARTER", 2020, 1, None, 3, 1, 1), ("YEAR", 2020, None, None, 3, 1, 1)],
            "grain string, year int, quarter_num int, month_num int, participants_total long, male_cnt long, female_cnt long",
        )
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "date_key" not in plan
