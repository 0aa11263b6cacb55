"""Dense surrogate keys without a single-task numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

FIRST_KEY = 100001


def assign_keys(
    df: DataFrame,
    business_id: str,
    name: str,
    after: DataFrame | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Add a dense key column `name`, numbered in the order of md5(business id).

    The first three hex digits of the digest cut the ids into 4,096 even ranges.
    Each range is numbered by its own task, and the 4,096 range counts give the
    offsets. `after` is an existing dimension whose highest key is continued.
    """
    digest = F.md5(F.col(business_id).cast("string").cast("binary"))
    marked = df.withColumn("_md5", digest).withColumn("_range", F.substring("_md5", 1, 3))
    sizes = marked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = W.partitionBy("_range").orderBy("_md5", business_id, *tie_break)
    numbered = marked.withColumn("_row", F.row_number().over(within)).join(
        F.broadcast(offsets), "_range"
    )
    start = F.lit(FIRST_KEY)
    if after is not None:
        start = F.coalesce(after.agg(F.max(name) + 1).scalar(), start)
    key = (start + F.col("_offset") + F.col("_row") - 1).cast("bigint").alias(name)
    return numbered.select(key, *[c for c in df.columns if c != name])
