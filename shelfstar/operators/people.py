"""Exact distinct counts at several grains, by bitmaps over dense surrogate keys.

Facts are folded once to one bitmap per finest period and range of 32,768 keys. A coarser period is the union of the bitmaps
of its parts, and no row of a fact is looked at again. An attribute of the keys meets the bitmaps, not the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

RANGE, KEYS = "_range", "_keys"


def key_bitmaps(rows: DataFrame, grain: Sequence[str], key: str) -> DataFrame:
    """One bitmap per grain and range of keys. Rows without a key are left out; repeated rows do no harm. A grain of very many rows
    is a few bitmaps per task before the shuffle."""
    marked = rows.where(F.col(key).isNotNull()).select(
        *grain, F.bitmap_bucket_number(key).alias(RANGE), F.bitmap_bit_position(key).alias("_bit")
    )
    return marked.groupBy(*grain, RANGE).agg(F.bitmap_construct_agg("_bit").alias(KEYS))


def merged(bitmaps: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Bitmaps of a coarser grain."""
    return bitmaps.groupBy(*grain, RANGE).agg(F.bitmap_or_agg(KEYS).alias(KEYS))


def key_counts(bitmaps: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """Distinct keys per grain."""
    return bitmaps.groupBy(*grain).agg(F.sum(F.bitmap_count(KEYS)).alias(name))


def key_counts_within(bitmaps: DataFrame, grain: Sequence[str], classes: DataFrame, key: str, label: str, name: str) -> DataFrame:
    """Distinct keys per grain and value of `label`; `classes` (key, label) has a few values. Grains without a key of a value have no row.

    Keys in both of two sets are the keys of one and of the other less those of their union, so the union is all that is built.
    """
    wanted = key_bitmaps(classes, [label], key).withColumnRenamed(KEYS, "_class")
    pairs = bitmaps.join(wanted, RANGE)
    both = pairs.withColumn("_one", F.explode(F.array(KEYS, "_class"))).groupBy(*grain, label, RANGE).agg(
        F.bitmap_or_agg("_one").alias("_union"),
        F.any_value(F.bitmap_count(KEYS) + F.bitmap_count("_class")).alias("_sum"),
    )
    counts = both.groupBy(*grain, label).agg(F.sum(F.col("_sum") - F.bitmap_count("_union")).alias(name))
    return counts.where(F.col(name) > 0)
