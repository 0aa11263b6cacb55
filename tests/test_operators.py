from __future__ import annotations

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from shelfstar.operators import calendar
from shelfstar.operators.active import active_at
from shelfstar.operators.asof import CHUNK, asof_lookup, deal, version_spans
from shelfstar.operators.lookup import attach, attach_folded, merged_if_large, sum_by_attribute
from shelfstar.operators.profile import range_profile, value_profile
from shelfstar.operators.split import neighbour, running
from shelfstar.operators.surrogate import assign_keys
from shelfstar.operators.totals import with_totals
from shelfstar.operators.upsert import absent, delete_children, insert_absent, set_where_in, update_from
from shelfstar.operators.windows import leaders, top_rows
from tests.conftest import rows

D = dt.date


def test_calendar(spark):
    days = calendar.days_between(spark, "2009-12-31", "2011-01-02")
    dim = calendar.dim_date(days, calendar.fixed_holidays(spark, 2000, 2025))
    got = {r.cal_date: r for r in dim.collect()}
    assert len(got) == 368
    assert [got[d].date_key for d in sorted(got)] == list(range(100001, 100369))
    day = got[D(2010, 9, 16)]
    assert (day.holiday_indicator, day.festive_event, day.business_day_ind) == ("Y", "Malaysia Day", "N")
    assert (day.full_desc, day.month_name, day.cal_year_quarter) == ("2010 September 16", "SEPTEMBER", "2010-Q3")
    assert (day.day_of_week, day.weekday_indicator, day.day_num_year) == (5, "Y", 259)
    assert calendar.fixed_holidays(spark, 2000, 2025).count() == 5 * 26 + 16
    more = calendar.extend_calendar(dim, "2010-12-30", "2011-01-05")
    assert rows(more, "cal_date", "date_key", "holiday_indicator") == [
        (D(2011, 1, n), 100366 + n, "N") for n in (3, 4, 5)
    ]
    assert calendar.extend_calendar(dim, "2010-01-01", "2010-02-01").count() == 0
    assert calendar.days_between(spark, "2000-01-01", "2025-12-31").count() == 9497


def test_active_at_equals_the_range_join(spark):
    rng = random.Random(1)
    base = D(2020, 1, 1)
    spans = []
    for i in range(400):
        start = base + dt.timedelta(days=rng.randrange(120)) if i % 17 else None
        end = (start or base) + dt.timedelta(days=rng.randrange(-3, 40)) if i % 5 else None
        spans.append((start, end))
    ends = [D(2020, m, 28) for m in (1, 2, 3, 4, 5)]
    got = active_at(
        spark.createDataFrame([(e,) for e in ends], "period_end date"),
        spark.createDataFrame(spans, "start date, end date"),
    )
    want = [
        (e, sum(1 for s, r in spans if s and s <= e and (r is None or r > e))) for e in ends
    ]
    assert rows(got, "period_end", "active") == want


def test_keys_are_dense_unique_and_continue(spark):
    df = spark.range(500).select((F.col("id") * 7).alias("k"))
    dim = assign_keys(df, "k", "key")
    assert sorted(r.key for r in dim.collect()) == list(range(100001, 100501))
    more = assign_keys(spark.range(1000, 1010).select(F.col("id").alias("k")), "k", "key", after=dim)
    assert sorted(r.key for r in more.collect()) == list(range(100501, 100511))


def _hot_events(spark):
    """One key holds most of the rows."""
    rng = random.Random(3)
    data = [
        ("hot" if i % 4 else f"k{i % 7}", D(2021, 1, 1) + dt.timedelta(days=rng.randrange(200)), i, rng.randrange(-9, 9))
        for i in range(600)
    ]
    return spark.createDataFrame(data, "k string, d date, i int, v int").withColumn("m", F.trunc("d", "MM"))


def test_split_windows_equal_plain_windows(spark):
    df = _hot_events(spark)
    w = W.partitionBy("k").orderBy("d", "i")
    for following, step in ((False, F.lag), (True, F.lead)):
        got = neighbour(df, ["k"], "m", ["d", "i"], ["v"], "near", following)
        want = df.withColumn("near", step("v").over(w))
        assert rows(got.select("k", "i", "near.v")) == rows(want, "k", "i", "near")
    for inclusive, last in ((True, W.currentRow), (False, -1)):
        frame = w.rowsBetween(W.unboundedPreceding, last)
        got = running(df, ["k"], "m", ["d", "i"], {"s": ("sum", F.col("v")), "lo": ("min", F.col("v"))}, inclusive)
        want = df.withColumn("s", F.coalesce(F.sum("v").over(frame), F.lit(0))).withColumn("lo", F.min("v").over(frame))
        assert rows(got, "k", "i", "s", "lo") == rows(want, "k", "i", "s", "lo")


def test_lookups_agree_on_both_sides_of_the_bound(spark):
    fact = spark.createDataFrame([(i % 3, i % 5, 1) for i in range(60)], "g int, k int, n int")
    names = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(4)], "k int, name string")
    for how in ("inner", "left"):
        small = sum_by_attribute(fact, names, "k", ["g"], ["n"], how)
        large = sum_by_attribute(fact, names, "k", ["g"], ["n"], how, bound=0)
        assert rows(small) == rows(large)
        assert rows(attach(fact, names, "k", how)) == rows(attach(fact, names, "k", how, bound=0))


def test_asof(spark):
    versions = spark.createDataFrame(
        [
            ("a", 1, D(2020, 1, 1), D(2020, 5, 31), 10),
            ("a", 2, D(2020, 6, 1), D(2020, 6, 1), 20),
            ("a", 3, D(2020, 6, 1), D(9999, 12, 31), 30),
            ("b", 4, D(2020, 3, 1), D(2020, 4, 1), 40),
        ],
        "id string, key int, effective_date date, expiration_date date, price int",
    )
    fact = spark.createDataFrame(
        [(1, "a", D(2019, 1, 1)), (2, "a", D(2020, 5, 31)), (3, "a", D(2020, 6, 1)), (4, "b", D(2020, 9, 9)), (5, "b", D(2020, 4, 1))],
        "n int, id string, day date",
    )
    strict = asof_lookup(fact, versions, "id", "key", "day", ("price",), strict=True)
    assert rows(strict, "n", "key", "price") == [(2, 1, 10), (3, 3, 30), (5, 4, 40)]
    loose = asof_lookup(fact, versions, "id", "key", "day")
    assert rows(loose, "n", "key") == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4)]


@pytest.mark.parametrize("strict", [True, False])
def test_asof_with_very_many_versions(spark, strict):
    """One id with 10,000 versions: a row meets the versions of its stretch of time only."""
    rng, first, n = random.Random(5), D(1990, 1, 1), 10_000
    days = sorted(rng.sample(range(3 * n), n))
    versions = [("hot", k, first + dt.timedelta(days=d), D(9999, 12, 31)) for k, d in enumerate(days)]
    versions += [("cold", n + k, D(2020, 1 + k, 1), D(2020, 1 + k, 20)) for k in range(3)] + [("cold", -1, None, D(2021, 1, 1))]
    fact = [(i, "hot" if i % 4 else "cold", first + dt.timedelta(days=rng.randrange(-50, 3 * n + 50))) for i in range(2000)]
    fact += [(2000, "hot", None), (2001, None, first), (2002, "unknown", first), (2003, "cold", D(2020, 2, 20)), (2004, "cold", D(2020, 2, 21))]
    want = []
    for i, who, day in fact:
        known = [v for v in versions if v[0] == who and v[2]]
        at = bisect.bisect_right([v[2] for v in known], day) - 1 if day else None
        if not known or at is None:
            continue
        if strict:
            want += [(i, known[at][1])] if at >= 0 and day <= known[at][3] else []
        elif at >= 0 or who == "hot":
            want.append((i, known[max(at, 0)][1]))
        else:
            # The version without a date comes first and reaches back to the start.
            want.append((i, -1))
    table = spark.createDataFrame(versions, "id string, key int, effective_date date, expiration_date date")
    facts = spark.createDataFrame(fact, "n int, id string, day date")
    got = asof_lookup(facts, table, "id", "key", "day", strict=strict)
    assert got.columns == ["n", "id", "day", "key"]
    assert rows(got, "n", "key") == sorted(want, key=lambda t: tuple((True, str(v)) for v in t))
    spans = version_spans(table, "id", "key", strict).withColumnRenamed("id", "_id")
    near, dealt = deal(facts, spans, "id", "day", table)
    assert near.join(dealt, (F.col("id") == F.col("_id")) & (F.col("_at_chunk") == F.col("_chunk"))).count() <= len(fact) * CHUNK
    kept = asof_lookup(facts, table, "id", "key", "day", strict=strict, how="left")
    assert kept.count() == len(fact)


def test_table_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string")
    once = insert_absent(target, batch, ["k"])
    assert rows(once) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(insert_absent(once, batch, ["k"])) == rows(once)
    assert rows(update_from(target, batch, ["k"], ["v"])) == [(1, "a"), (2, "x")]
    assert rows(set_where_in(target, batch, ["k"], "v", F.lit("hit"))) == [(1, "a"), (2, "hit")]
    assert rows(delete_children(target, batch, ["k"])) == [(1, "a")]


def test_ranking_and_totals(spark):
    df = spark.createDataFrame([("x", "b", 2), ("x", "a", 2), ("x", "c", 1), ("y", None, 5)], "p string, g string, n int")
    assert rows(leaders(df, ["p"], "n", "g", "top")) == [("x", "a/b"), ("y", None)]
    assert rows(top_rows(df, ["p"], [F.desc("n"), "g"], 2), "p", "g", "row_num") == [("x", "a", 1), ("x", "b", 2), ("y", None, 1)]
    totals = with_totals(df, ["p", "g"], [["p", "g"], ["p"], []], [F.sum("n").alias("n")])
    assert rows(totals.where("level_num = 0"), "p", "g", "n")[-1] == ("y", None, 5)
    assert rows(totals.where("level_num = 1"), "p", "n") == [("x", 5), ("y", 5)]
    assert rows(totals.where("level_num = 2"), "n") == [(10,)]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "s string, v int")
    assert [(r.s, r.cnt, str(r.pct)) for r in value_profile(df, "s").orderBy("s").collect()] == [("a", 2, "66.67"), ("b", 1, "33.33")]
    r = range_profile(df, "v").first()
    assert (r.rows, r.min_value, r.max_value, str(r.avg_value)) == (3, 1, 4, "2.33")


def test_large_lookup_with_small_file_is_not_broadcast(spark, tmp_path):
    """Spark goes by the bytes of a file; the ids of a compressed table of millions of rows look small by that."""
    spark.range(100).write.parquet(str(tmp_path / "ids"))
    ids, fact = spark.read.parquet(str(tmp_path / "ids")), spark.range(0, 1000, 3)
    plan = lambda df: (df.collect(), df._jdf.queryExecution().executedPlan().toString())[1]
    assert "BroadcastHashJoin" in plan(fact.join(ids, "id")) and "BroadcastHashJoin" in plan(attach(fact, ids, "id"))
    joined = attach(fact, ids, "id", bound=99)
    missing = absent(fact, merged_if_large(ids, 99), ["id"])
    folded = attach_folded(fact.withColumn("n", F.lit(1)), ids, "id", [], ["n"], bound=99)
    for df, n in ((joined, 34), (missing, 300), (folded, 34)):
        assert "BroadcastHashJoin" not in plan(df) and df.count() == n
    assert merged_if_large(ids, 100) is ids
