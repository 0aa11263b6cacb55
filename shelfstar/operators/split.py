"""Ordered computations per key that do not need a whole key in one task.

A plain window sorts all rows of a key in one task. Keys of more rows than a slice should hold are cut into slices that
follow the order; the bounds are quantiles of a sample of the key's rows, so a slice is bounded by rows however the rows lie in time,
be it all on one day. Every slice is windowed on its own, and only one row per slice is carried across the key. Where no
key is that large the plain window is all there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfstar.session import settle

SLICE = "_slice"
#: Rows of a key in a slice, about, and rows of the sample per slice.
SLICE_ROWS, SAMPLE = 2_000_000, 48
#: Steps of a binary search; enough for 2**40 slices of a key.
STEPS = 40


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = SLICE_ROWS) -> tuple[DataFrame, str | None]:
    """`df` with a slice number that does not decrease along `order` within a key, and the name of that column; None, and `df` as
    it is, where no key has more than `rows` rows.

    Rows equal in `order` are in one slice. The keys are counted map side first. The table of bounds has one entry per `rows` rows
    of large keys, which is what bounds the broadcast. The sample decides where a key is cut, never what comes out. `df` is read
    up to three times: settle it if it is costly.
    """
    crowded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    crowded = settle(crowded.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n"))
    if crowded.isEmpty():
        return df, None
    spot = F.struct(*order)
    slices = F.ceil(F.col("_n") / rows)
    drawn = _on_keys(df, F.broadcast(crowded), keys, "inner").where(F.rand(17) < SAMPLE * slices / F.col("_n"))
    sample = F.sort_array(F.collect_list(spot))
    per_key = drawn.groupBy(*[f"_k_{k}" for k in keys]).agg(sample.alias("_sample"), F.max(slices).cast("int").alias("_cuts"))
    each = F.size("_sample") / F.col("_cuts")
    picked = F.transform(
        F.sequence(F.lit(1), F.col("_cuts") - 1),
        lambda i: F.element_at("_sample", F.greatest(F.floor(i * each), F.lit(1)).cast("int")),
    )
    bounds = settle(per_key.where("_cuts > 1").withColumn("_bounds", picked).drop("_sample", "_cuts"))
    cut = _on_keys(df, F.broadcast(bounds), keys, "left").withColumn(SLICE, F.coalesce(rank_among(F.col("_bounds"), spot), F.lit(0)))
    return cut.select(*df.columns, SLICE), SLICE


def _on_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, bucket: str | None = None) -> DataFrame:
    """Join on keys, which `other` has under `_k_` names; NULL keys are equal to each other."""
    on = [df[k].eqNullSafe(other[f"_k_{k}"]) for k in keys]
    if bucket:
        on.append(df[bucket] == other[f"_k_{bucket}"])
    return df.join(other, on, how)


def rank_among(bounds: Column, spot: Column) -> Column:
    """How many of the ascending bounds are less than `spot`, by binary search; NULL without bounds."""
    low, high = F.lit(0).alias("low"), F.size(bounds).alias("high")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        open_ = state["low"] < state["high"]
        less = open_ & (F.get(bounds, middle) < spot)
        return F.struct(
            F.when(less, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~less, middle).otherwise(state["high"]).alias("high"),
        )

    # Steps beyond the logarithm of the number of bounds change nothing and are not taken.
    steps = F.sequence(F.lit(0), F.least(F.ceil(F.log2(F.size(bounds) + 1)).cast("int"), F.lit(STEPS)))
    found = F.aggregate(steps, F.struct(low, high), halve, lambda state: state["low"])
    return F.when(bounds.isNotNull(), found)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str | None,
    order: Sequence[str],
    columns: Sequence[str],
    name: str,
    following: bool = False,
) -> DataFrame:
    """Add struct `name` with `columns` of the row before (or after) within the key.

    `bucket` is what `with_slices` gave, or any column that does not decrease along `order`, which must be unique per key.
    The struct is NULL where there is no such row.
    """
    step = F.lead if following else F.lag
    row = F.struct(*columns)
    if not bucket:
        return df.withColumn(name, step(row).over(W.partitionBy(*keys).orderBy(*order)))
    spot = F.struct(*order)
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    edge = (F.min_by if following else F.max_by)(row, spot)
    edges = (
        df.groupBy(*keys, bucket)
        .agg(edge.alias("_edge"))
        .withColumn("_carried", step("_edge").over(W.partitionBy(*keys).orderBy(bucket)))
    )
    edges = edges.select(*[F.col(k).alias(f"_k_{k}") for k in (*keys, bucket)], "_carried")
    near = df.withColumn("_near", step(row).over(inside))
    found = _on_keys(near, edges, keys, "inner", bucket).withColumn(name, F.coalesce("_near", "_carried"))
    return found.select(*df.columns, name)


def running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str | None,
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    inclusive: bool = True,
) -> DataFrame:
    """Add running aggregates along `order` per key.

    `columns` maps a new name to ("sum" | "min", expression). With `inclusive`
    False the current row is left out. `bucket` as in `neighbour`.
    """
    combine = {"sum": F.sum, "min": F.min}
    parts = [*keys, bucket] if bucket else list(keys)
    last = W.currentRow if inclusive else -1
    inside = W.partitionBy(*parts).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    out = df.withColumns({f"_l_{n}": combine[kind](expr).over(inside) for n, (kind, expr) in columns.items()})
    if bucket:
        totals = df.groupBy(*parts).agg(*[combine[kind](expr).alias(f"_t_{n}") for n, (kind, expr) in columns.items()])
        earlier = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
        carried = totals.select(
            *[F.col(k).alias(f"_k_{k}") for k in parts],
            *[combine[kind](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (kind, _) in columns.items()],
        )
        out = _on_keys(out, carried, keys, "inner", bucket)
    added = []
    for n, (kind, _) in columns.items():
        local, before = F.col(f"_l_{n}"), F.col(f"_c_{n}") if bucket else F.lit(None)
        value = F.coalesce(local, F.lit(0)) + F.coalesce(before, F.lit(0)) if kind == "sum" else F.least(local, before)
        added.append(value.alias(n))
    return out.select(*df.columns, *added)


def queue(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str | None,
    order: Sequence[str],
    arrives: Column,
    serves: Column,
    per_service: int,
    prefix: str,
) -> DataFrame:
    """Add the state of a first-come queue per key to every event: `{prefix}place` (arrivals so far) and, at services, `{prefix}before` and
    `{prefix}after` (arrivals served before and after it). A service takes up to `per_service` waiting arrivals.

    With A arrivals before the n-th service, S(n) = min(S(n-1) + c, A(n)) = cn + min(0, min over k <= n of A(k) - ck) are served. So the
    state is a running sum and a running minimum, and what a slice does to it is three numbers: its arrivals a, its services n and its
    lowest spare l, the least A - cn at its services counted from its start. Two slices in a row are (a1 + a2, n1 + n2,
    min(l1, a1 - c*n1 + l2)), which is associative, so slices are summed up on their own and one row of each is scanned.
    """
    c = F.lit(per_service)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    parts = [*keys, bucket] if bucket else list(keys)
    upto = W.partitionBy(*parts).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*parts).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = (
        df.withColumn("_a", F.sum(F.when(arrives, one).otherwise(none)).over(upto))
        .withColumn("_n", F.sum(F.when(serves, one).otherwise(none)).over(upto))
        .withColumn("_spare", F.when(serves, F.col("_a") - F.col("_n") * c))
        .withColumn("_low", F.min("_spare").over(earlier))
    )
    if bucket:
        sums = local.groupBy(*parts).agg(
            F.sum(F.when(arrives, one).otherwise(none)).alias("_sa"),
            F.sum(F.when(serves, one).otherwise(none)).alias("_sn"),
            F.min("_spare").alias("_sl"),
        )
        over = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
        state = sums.withColumn("_a0", F.coalesce(F.sum("_sa").over(over), none)).withColumn("_n0", F.coalesce(F.sum("_sn").over(over), none))
        base = F.col("_a0") - F.col("_n0") * c
        state = state.withColumn("_low0", F.min(base + F.col("_sl")).over(over))
        state = state.select(*[F.col(k).alias(f"_k_{k}") for k in parts], "_a0", "_n0", "_low0")
        local = (
            _on_keys(local, state, keys, "inner", bucket)
            .withColumn("_a", F.col("_a") + F.col("_a0"))
            .withColumn("_n", F.col("_n") + F.col("_n0"))
            .withColumn("_spare", base + F.col("_spare"))
            .withColumn("_low", F.least("_low0", base + F.col("_low")))
        )
    return local.select(
        *df.columns,
        F.col("_a").alias(f"{prefix}place"),
        F.when(serves, (F.col("_n") - 1) * c + F.least(none, "_low")).alias(f"{prefix}before"),
        F.when(serves, F.col("_n") * c + F.least(none, "_low", "_spare")).alias(f"{prefix}after"),
    )
