"""Window helpers over aggregated period tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfstar.functions.numbers import count_percent, ratio


def previous(col: str, order: Sequence, partition: Sequence = (), rows: int = 1) -> Column:
    """The value `rows` rows earlier."""
    return F.lag(col, rows).over(W.partitionBy(*partition).orderBy(*order))


def moving_average(col: str, order: Sequence, partition: Sequence = (), rows: int = 3) -> Column:
    """Average of a count over the current and the earlier rows, to 2 places."""
    w = W.partitionBy(*partition).orderBy(*order).rowsBetween(1 - rows, 0)
    n = "decimal(20,0)"
    return ratio(F.sum(col).over(w).cast(n), F.count(col).over(w).cast(n))


def share_of_total(col: str, partition: Sequence = ()) -> Column:
    """Percent of the partition's total of a count."""
    return count_percent(F.col(col), F.sum(col).over(W.partitionBy(*partition)))


def first_row(order: Sequence, partition: Sequence) -> Column:
    """True on the first row of a partition."""
    return F.row_number().over(W.partitionBy(*partition).orderBy(*order)) == 1


def top_rows(df: DataFrame, partition: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first `n` rows of every group; Spark cuts each group before the shuffle."""
    w = W.partitionBy(*partition).orderBy(*order)
    return df.withColumn("row_num", F.row_number().over(w)).where(F.col("row_num") <= n)


def leaders(df: DataFrame, partition: Sequence[str], by: str, label: str, name: str) -> DataFrame:
    """Per group the labels with the highest `by`, ties joined by '/' in label order."""
    w = W.partitionBy(*partition).orderBy(F.desc(by))
    tied = df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1)
    text = F.array_join(F.array_sort(F.collect_list(label)), "/")
    return tied.groupBy(*partition).agg(F.nullif(text, F.lit("")).alias(name))
