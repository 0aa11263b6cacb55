"""Sharding by a minimax contiguous partition of ordered atomic groups.

Rows of equal text form one group, which no cut divides. Groups stand in the order of their smallest
id. The smallest capacity C for which a greedy walk fills at most `shards` shards is found by binary
search, and the shards are cut there.

The walk only asks for the last group end at or before an offset. The driver holds a grid of cells with
the first and last group end in each, so every answer is an interval; the search runs once with lower
and once with upper ends, and only the cells between the two outcomes are fetched again on a finer grid,
until the capacity is exact. What the driver holds is bounded by `CELLS` and `REFINED`, whatever the
number of groups.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstar.llm.common import table, written

#: Cells of the first grid; cells made finer per round, each by 2 ** FINER_BITS.
CELLS, REFINED, FINER_BITS = 1 << 13, 512, 7
#: Pieces in which the rows of a shard are numbered.
PIECES = 4096


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot.

    A null text counts as an empty one, and both are one group. Repeated rows are rows of one group. Null
    ids order first. Other columns are not looked at. An empty table gives no rows. With fewer groups
    than shards some shards stay empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    light = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    groups = light.groupBy("digest").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first"))
    ends = group_ends(groups, ["first", "digest"], "bytes")
    cuts = minimax_cuts(ends, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("group_end") > cut).cast("int")
    placed = written(
        light.join(ends.select("digest", shard.alias("shard")), "digest").select(
            "doc_id", "size", "text_crc32", "shard"
        ),
        "shard-rows",
    )
    return numbered(placed, "shard", ["doc_id", "text_crc32"], "slot")


def group_ends(groups: DataFrame, order: list[str], size: str) -> DataFrame:
    """`groups` with group_end, the running sum of `size` in `order`. Rows are dealt to ranges, summed within
    each range and offset by the sums of the ranges before, so no task sees more than one range."""
    ranged = written(
        groups.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-groups"
    )
    before, total = [], 0
    for row in sorted(ranged.groupBy("part").agg(F.sum(size).alias("s")).collect()):  # a row per range
        before.append((row["part"], total))
        total += row["s"]
    offsets = groups.sparkSession.createDataFrame(before, "part int, before long")
    running = F.sum(size).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return written(
        ranged.withColumn("running", running)
        .join(F.broadcast(offsets), "part")
        .select(*groups.columns, (F.col("running") + F.col("before")).alias("group_end")),
        "shard-ends",
    )


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `name`, gapless from 0 within each value of `key`. Rows of a key are numbered in `PIECES` pieces by
    a hash of `order` and offset by the counts of the pieces before."""
    pieces = rows.withColumn("piece", F.pmod(F.xxhash64(*order), F.lit(PIECES)).cast("int"))
    counts = pieces.groupBy(key, "piece").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(key, "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy(key, "piece").orderBy(*order))
    return (
        pieces.withColumn("own", own)
        .join(base, [key, "piece"])
        .select(*rows.columns, (F.col("base") + F.col("own") - 1).cast("long").alias(name))
    )


def minimax_cuts(ends: DataFrame, shards: int) -> list[int]:
    """Offsets of the cuts, at most `shards` - 1 of them: no shard exceeds the smallest feasible capacity, and within it
    shards are as even as the groups allow."""
    total = ends.agg(F.max("group_end")).first()[0] or 0
    if not total:
        return []
    capacity = smallest_capacity(_grid(ends, total), total, shards)
    return _even_cuts(ends, total, shards, capacity)


def _grid(ends: DataFrame, total: int) -> Callable:
    """fetch(bits, cells of the coarser grid or None) -> sorted (first end, last end) of each finer cell."""
    spark = ends.sparkSession

    def fetch(bits: int, within: tuple[int, list[int]] | None) -> list[tuple[int, int]]:
        rows = ends.select("group_end")
        if within:
            coarse, cells = within
            wanted = spark.createDataFrame([(c,) for c in cells], "coarse long")
            rows = rows.withColumn("coarse", F.shiftright(F.col("group_end") - 1, coarse)).join(
                F.broadcast(wanted), "coarse", "left_semi"
            )
        found = rows.groupBy(F.shiftright(F.col("group_end") - 1, bits).alias("cell")).agg(
            F.min("group_end").alias("a"), F.max("group_end").alias("b")
        )
        return sorted((r["a"], r["b"]) for r in found.collect())

    return fetch


def smallest_capacity(fetch: Callable, total: int, shards: int) -> int:
    """The smallest capacity for which the greedy walk needs at most `shards` shards."""
    bits = max(0, (total - 1).bit_length() - (CELLS.bit_length() - 1))
    cells = [(a, b, bits) for a, b in fetch(bits, None)]
    while True:
        firsts = [c[0] for c in cells]

        def reach(at: int, upper: bool) -> int:
            i = bisect_right(firsts, at) - 1
            if i < 0:
                return 0
            a, b, _ = cells[i]
            return b if at >= b else at if upper else a

        def walk(capacity: int, upper: bool) -> list[int]:
            ends, at = [], 0
            for _ in range(shards):
                at = max(at, reach(at + capacity, upper))
                ends.append(at)
            return ends

        def search(upper: bool) -> int:
            low, high = -(-total // shards), total
            while low < high:
                mid = (low + high) // 2
                low, high = (low, mid) if walk(mid, upper)[-1] >= total else (mid + 1, high)
            return low

        least, most = search(True), search(False)
        if least == most:
            return least
        open_cells: set[int] = set()
        for low, high in zip([0, *walk(least, False)], [0, *walk(most, True)], strict=True):
            i, j = bisect_right(firsts, low + least) - 1, bisect_right(firsts, high + most)
            open_cells |= {k for k in range(max(0, i), j) if cells[k][0] < cells[k][1]}
        widest = max(cells[k][2] for k in open_cells)
        chosen = sorted(k for k in open_cells if cells[k][2] == widest)[:REFINED]
        finer = max(0, widest - FINER_BITS)
        gone = set(chosen)
        fresh = fetch(finer, (widest, [(cells[k][0] - 1) >> widest for k in chosen]))
        cells = sorted([c for k, c in enumerate(cells) if k not in gone] + [(a, b, finer) for a, b in fresh])


def _even_cuts(ends: DataFrame, total: int, shards: int, capacity: int) -> list[int]:
    """Cuts under the capacity: each at the group end nearest an even share of what is left, within the
    leftmost place that the shards after it allow."""

    def at_most(x: int) -> int:
        return ends.filter(F.col("group_end") <= x).agg(F.max("group_end")).first()[0] or 0

    def at_least(x: int) -> int:
        return 0 if x <= 0 else ends.filter(F.col("group_end") >= x).agg(F.min("group_end")).first()[0]

    leftmost = [total]
    while len(leftmost) < shards:
        leftmost.append(at_least(leftmost[-1] - capacity))
    cuts, at = [], 0
    for k in range(1, shards):
        left = leftmost[shards - k]
        even = at + -(-(total - at) // (shards - k + 1))
        limit = at + capacity
        below = at_most(min(even, limit))
        above = at_least(min(even + 1, total))
        cut = above if above <= limit and (above - even < even - below or below <= at) else below
        cut = min(max(cut, left), total)
        cuts.append(cut)
        at = cut
    return [c for c in cuts if c < total]


def op2_sharding(spark, folder: str) -> DataFrame:
    rows = shard_documents(table(spark, folder, "documents"), 16)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op2_sharding": op2_sharding}
ORACLE: dict[str, str] = {}
