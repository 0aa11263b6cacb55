"""Rows a target lacks: what the join shuffles, and NULL keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfstar.operators.upsert import absent
from shelfstar.plans.load import _keyed


def _shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_sides_grouped_by_keys_that_cannot_be_null_are_not_shuffled_again(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(40).select(*[F.coalesce(F.col("id") % n, F.lit(0)).alias(k) for k, n in (("a", 7), ("b", 3))], "id")
        batch = rows.groupBy("a", "b").agg(F.max("id").alias("most"))
        target = rows.where("a < 5").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        for unique in (False, True):
            found = absent(batch, target, ["a", "b"], unique)
            assert _shuffles(found) == 2
            assert sorted(r.a for r in found.collect()) == [5, 5, 5, 6, 6, 6]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_are_equal_on_columns_of_any_kind(spark):
    maybe = spark.createDataFrame([(1, None), (None, "x"), (None, None), (2, "y")], "a int, b string")
    known = spark.createDataFrame([(1, None), (None, None), (None, None)], "a int, b string")
    never = known.select(F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit("y")).alias("b"))
    for unique in (False, True):
        assert sorted(map(str, absent(maybe, known, ["a", "b"], unique).collect())) == ["Row(a=2, b='y')", "Row(a=None, b='x')"]
        assert absent(maybe, never, ["a", "b"], unique).count() == 4
        assert absent(never, maybe, ["a", "b"], unique).count() == 3


def test_keyed_dimension_keeps_its_keys_and_cannot_lose_them(spark):
    dim = spark.createDataFrame([(100001, "u"), (100002, None)], "book_key bigint, book_id string")
    keyed = _keyed(dim, "book_key")
    assert not keyed.schema["book_key"].nullable and keyed.columns == dim.columns
    assert sorted(r.book_key for r in keyed.collect()) == [100001, 100002]
