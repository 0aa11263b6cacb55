"""The stored star: partitions read and written, repeated batches, counts and rejects."""

from __future__ import annotations

import datetime as dt
import os
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfstar.operators.upsert import absent, absent_per_key, absent_within, one_per_key
from shelfstar.plans.facts import FACT_KEYS
from shelfstar.session import shared_folder, use_settings
from shelfstar.sources.commerce import ByOrder, Commerce
from shelfstar.sources.store import MONTH, Store
from tests.conftest import rows
from tests.test_load import AS_OF, sources, star  # noqa: F401

D = dt.date
SINCE = "2000-01-01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, star, tmp_path):  # noqa: F811
    made = Store(spark, str(tmp_path / "star"))
    assert made.create(star) == {n: df.count() for n, df in star.tables().items()}
    return made


def later(batch):
    """The batch with a loan, a sale and a title more, and rows that nothing can come from."""
    loan = batch.loans.where("borrow_id = 'L3'")
    more = loan.withColumn("borrow_id", F.lit("L4")).withColumn("borrow_date", F.lit(D(2022, 1, 2)))
    lost = loan.withColumn("borrow_id", F.lit("L5")).withColumn("member_id", F.lit("M9"))
    undated = loan.withColumn("borrow_id", F.lit("L6")).withColumn("borrow_date", F.lit(None).cast("date"))
    foreign = loan.withColumn("borrow_id", F.lit("L7")).withColumn("copy_id", F.lit("C9"))
    title = batch.titles.where("book_id = 'B1'").withColumn("book_id", F.lit("B3"))
    return replace(
        batch,
        loans=batch.loans.unionByName(more).unionByName(lost).unionByName(undated).unionByName(foreign),
        titles=batch.titles.unionByName(title),
    )


def test_batch_is_added_once(store, sources):  # noqa: F811
    batch = later(sources)
    first = {r.table_name: (r.received, r.inserted) for r in store.load(batch, "2021-12-01", "2022-01-31", AS_OF, SINCE).collect()}
    assert first == {
        "dim_date": (31, 31), "dim_book": (1, 1), "dim_members": (0, 0), "dim_suppliers": (0, 0),
        "fact_purchase": (2, 0), "fact_borrowing": (3, 1), "fact_sales": (2, 0), "rejects": (4, 4),
    }
    again = {r.table_name: r.inserted for r in store.load(batch, "2021-12-01", "2022-01-31", AS_OF, SINCE).collect()}
    assert set(again.values()) == {0}
    assert rows(store.rejects()) == [
        ("fact_borrowing", "L5", "no member"),
        ("fact_borrowing", "L6", "no day"),
        ("fact_borrowing", "L7", "no copy"),
        ("fact_sales", "X3", "no day"),
    ]
    assert rows(store.months("fact_borrowing").groupBy(MONTH).count()) == [(202101, 1), (202102, 1), (202201, 1)]
    assert store.star((2022, 2022)).fact_borrowing.count() == 1


def test_only_the_months_of_a_batch_are_read(store, star):  # noqa: F811
    dim_date = store.dimension("dim_date")
    february = store.with_month(star.fact_borrowing, dim_date).where(f"{MONTH} = 202102")
    fresh = store.fresh("fact_borrowing", february, [202102], FACT_KEYS["fact_borrowing"])
    assert fresh.count() == 0
    plan = plan_of(store.fresh("fact_borrowing", february, [202102], FACT_KEYS["fact_borrowing"]))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and f"{MONTH}#" in line]
    assert scans and all("= 202102)" in s.split("PartitionFilters: ")[1].split("PushedFilters")[0] for s in scans)
    year = plan_of(store.fact("fact_borrowing", (2021, 2021)))
    assert f"{MONTH}#" in year and ">= 202101)" in year and "<= 202112)" in year and "PartitionFilters" in year
    reads = [line for line in plan_of(store.fact("fact_sales", (2021, 2021)).select("quantity")).splitlines() if "ReadSchema" in line]
    assert reads and all("struct<quantity:bigint>" in r for r in reads)


def test_sale_that_moved_to_another_month_is_not_new(spark, store, star):  # noqa: F811
    dim_date = store.dimension("dim_date")
    key = {str(r.cal_date): r.date_key for r in dim_date.collect()}
    moved = star.fact_sales.where("sales_id = 'X1'").withColumn("date_key", F.lit(key["2021-11-05"]))
    repeated = moved.withColumn("sales_id", F.lit("X7"))
    batch = moved.unionByName(repeated).unionByName(repeated)
    done = store.insert("fact_sales", batch, dim_date)
    assert (done.received, done.added, done.months) == (3, 1, (202111,))
    assert store.insert("fact_sales", batch, dim_date).added == 0
    undated = repeated.withColumn("sales_id", F.lit(None).cast("string")).withColumn("date_key", F.lit(None).cast("bigint"))
    done = store.insert("fact_sales", undated.unionByName(undated), dim_date)
    assert (done.added, done.months) == (1, (0,))
    assert store.insert("fact_sales", undated, dim_date).added == 0
    assert store.insert("fact_sales", undated.limit(0), dim_date).added == 0


@pytest.mark.parametrize("keys", [["k", "part"], ["k"]])
def test_absent_within_equals_absent(spark, keys):
    rng = random.Random(len(keys))
    schema = "k int, v string, part int"
    pick = lambda n: [(rng.choice([None, *range(12)]), str(rng.randrange(3)), rng.randrange(4)) for _ in range(n)]
    target, batch = spark.createDataFrame(pick(30), schema), spark.createDataFrame([r for r in pick(40) if r[2] < 2], schema)
    assert rows(absent_within(batch, target, keys, "part", [0, 1])) == rows(absent(batch, target, keys))


def test_one_per_key_takes_the_first_row(spark):
    schema = "k int, a int, b string"
    data = [(1, 2, "x"), (1, 1, "z"), (1, 1, "y"), (None, 5, "q"), (None, None, "r"), (2, None, None)]
    df = spark.createDataFrame(data, schema)
    assert rows(one_per_key(df, ["k"])) == rows(spark.createDataFrame([(1, 1, "y"), (None, None, "r"), (2, None, None)], schema))
    assert rows(one_per_key(df, ["k"], ["b"])) == rows(spark.createDataFrame([(1, 2, "x"), (None, 5, "q"), (2, None, None)], schema))
    assert one_per_key(df.select("k"), ["k"]).count() == 3
    assert "Window" not in plan_of(one_per_key(df, ["k"]))


def test_a_batch_is_compared_in_one_shuffle(spark):
    """Repeated and NULL keys, with and without other columns; the batch meets the table where it is reduced to its keys."""
    schema = "k int, a int, b string"
    batch = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (None, 5, "q"), (2, None, None), (3, 3, "z"), (2, None, None)], schema)
    for known in ([(3, 0, "known")], [(None, 1, "n"), (1, 9, "o"), (1, 9, "p")], []):
        target = spark.createDataFrame(known, schema)
        assert rows(absent_per_key(batch, target, ["k"])) == rows(absent(one_per_key(batch, ["k"]), target, ["k"]))
        assert rows(absent_per_key(batch, target, ["k", "a", "b"])) == rows(absent(batch.distinct(), target, ["k", "a", "b"]))
    assert plan_of(absent_per_key(batch, target, ["k"])).count("Exchange hashpartitioning") == 1


def files_of(folder):
    return [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files]


def test_what_a_load_staged_is_gone(spark, store, sources):  # noqa: F811
    folder = shared_folder(spark)
    before = {d for d in os.listdir(folder) if d.startswith("staged-")}
    assert store.load(later(sources), "2021-12-01", "2022-01-31", AS_OF, SINCE).count() == 8
    assert {d for d in os.listdir(folder) if d.startswith("staged-")} == before
    assert store.rejects().count() == 4 and store.fact("fact_borrowing").count() == 3


def test_tables_by_order_can_be_given_up(spark):
    laid_out = ByOrder(Commerce(spark, "/root/testdata/sf0.001"))
    laid_out.drop()
    for name in laid_out.names.values():
        assert not spark.catalog.tableExists(name) and not os.path.exists(f"{shared_folder(spark)}/{name}")


def test_shuffle_files_go_with_their_query(spark):
    use_settings(spark)
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    shuffled = lambda: {f for f in files_of(folder) if os.path.basename(f).startswith("shuffle_")}
    before = shuffled()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert df.count() == 7 and len(df.collect()) == 7 and len(df.collect()) == 7
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before


def test_lines_and_orders_by_order_join_in_place(spark):
    src = Commerce(spark, "/root/testdata/sf0.001")
    laid_out = ByOrder(src)
    for name in ("orders", "lineitem"):
        assert rows(laid_out.table(name)) == rows(src.table(name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" in plan_of(src.loans()) and "Exchange" in plan_of(src.purchase_orders())
        assert "Exchange" not in plan_of(laid_out.loans()) and "Exchange" not in plan_of(laid_out.purchase_orders())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
