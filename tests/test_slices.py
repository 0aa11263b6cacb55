"""Keys cut into slices bounded by rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfstar.operators.split import neighbour, with_slices

ROWS = 200


@pytest.fixture(scope="module")
def skewed(spark):
    """One id on one day holds a third of all rows, a NULL id another part."""
    rng = random.Random(11)
    data = [(7, 0, i) for i in range(6000)] + [(None, rng.randrange(40), 100_000 + i) for i in range(3000)]
    data += [(rng.randrange(100, 400), rng.randrange(40), 200_000 + i) for i in range(9000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k int, day int, id int").repartition(5)


def test_slices_are_bounded_and_in_order(skewed):
    cut, bucket = with_slices(skewed, ["k"], ["day", "id"], ROWS)
    spans = cut.groupBy("k", bucket).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("day", "id")).alias("lo"), F.max(F.struct("day", "id")).alias("hi")
    ).collect()
    assert sum(s.n for s in spans) == skewed.count()
    # No slice is more than a small multiple of what was asked for.
    assert max(s.n for s in spans) <= 3 * ROWS
    per_key = {}
    for s in spans:
        per_key.setdefault(s.k, []).append((s[bucket], tuple(s.lo), tuple(s.hi)))
    assert len(per_key[7]) >= 20 and len(per_key[None]) >= 10
    for found in per_key.values():
        found.sort()
        assert all(a[2] < b[1] for a, b in zip(found, found[1:], strict=False))
    assert all(len(found) == 1 for k, found in per_key.items() if k not in (7, None))


@pytest.mark.parametrize("following", [False, True])
def test_neighbour_over_slices_equals_the_plain_one(skewed, following):
    order = ["day", "id"]
    cut, bucket = with_slices(skewed, ["k"], order, ROWS)
    got = neighbour(cut, ["k"], bucket, order, ["id"], "near", following).select("id", "near.id")
    plain = neighbour(skewed, ["k"], None, order, ["id"], "near", following).select("id", "near.id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_no_large_key_leaves_rows_as_they_are(skewed):
    same, bucket = with_slices(skewed, ["k"], ["day", "id"])
    assert bucket is None and same is skewed
    empty, bucket = with_slices(skewed.limit(0), ["k"], ["day", "id"], 1)
    assert bucket is None and empty.count() == 0
