"""Table changes as DataFrame-to-DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def absent(batch: DataFrame, target: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows of `batch` whose key the target lacks; NULL keys are equal to each other.

    A key that cannot be NULL on one side is compared by plain equality, so where that holds for all keys the join takes a
    side that was grouped by them as it lies. `unique` says that the target has few rows or one per key, so that making its keys
    distinct first would fold nothing; the result is the same either way.
    """
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    if not unique:
        known = known.distinct()
    same = []
    for k in keys:
        mine, its = batch[k], known[f"_known_{k}"]
        null = batch.schema[k].nullable and known.schema[f"_known_{k}"].nullable
        same.append(mine.eqNullSafe(its) if null else mine == its)
    return batch.join(known, same, "left_anti").select(*batch.columns)


def one_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in `order`; what it leaves open, the other columns decide. NULL keys are equal to each other.
    The least row is taken before the shuffle, so a key of very many rows is one row per task there."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.distinct()
    least = F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_least")
    found = batch.groupBy(*keys).agg(least)
    return found.select(*[F.col(c) if c in keys else F.col(f"_least.{c}").alias(c) for c in batch.columns])


def absent_within(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], part: str, parts: Sequence
) -> DataFrame:
    """`absent` where the target is a table partitioned by `part` and `parts` are its values in the batch.

    Only these partitions of the target are read if the key holds the part, directly or as what it
    is made from (then name the part among the keys). Otherwise a key may stand in any partition: the rows that these
    partitions lack are looked up by key alone in the others.
    """
    near = F.col(part).isin(*parts) if parts else F.lit(False)
    left = absent(batch, target.where(near), keys)
    return left if part in keys else absent(left, target.where(~near), keys)


def absent_per_key(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`absent(one_per_key(batch, keys), target, keys)` in one grouping, so that each row of the batch is shuffled once. Grouping takes
    NULL keys as equal to each other."""
    rest = [c for c in batch.columns if c not in keys]
    names = [f"_k_{n}" for n in range(len(keys))]
    row = F.struct(F.lit(True).alias("_of_batch"), *rest)
    new = batch.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], row.alias("_row"))
    known = target.select(*[F.col(k).cast(batch.schema[k].dataType).alias(n) for k, n in zip(keys, names, strict=True)])
    both = new.unionByName(known.withColumn("_row", F.lit(None).cast(new.schema["_row"].dataType)))
    found = both.groupBy(*names).agg(F.min("_row").alias("_row"), F.bool_or(F.col("_row").isNull()).alias("_known"))
    of = dict(zip(keys, names, strict=True))
    return found.where(~F.col("_known")).select(*[F.col(of[c] if c in of else f"_row.{c}").alias(c) for c in batch.columns])


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the missing rows of `batch` added, one per key; running it twice adds nothing."""
    return target.unionByName(absent(one_per_key(batch, keys), target, keys))


def update_from(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite `columns` where `changes` (one row per key) has a value for the key."""
    fresh = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(fresh, list(keys), "left")
    new = {c: F.coalesce(f"_new_{c}", c) for c in columns}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in target.columns])


def set_where_in(
    target: DataFrame, keys_df: DataFrame, keys: Sequence[str], column: str, value: Column
) -> DataFrame:
    """Set `column` on the rows whose key occurs in `keys_df`."""
    hit = keys_df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = target.join(hit, list(keys), "left")
    changed = F.when(F.col("_hit"), value).otherwise(F.col(column))
    return joined.select(*[changed.alias(c) if c == column else F.col(c) for c in target.columns])


def delete_children(children: DataFrame, deleted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Children left once the parents in `deleted` are gone."""
    return children.join(deleted.select(*on), list(on), "left_anti").select(*children.columns)
