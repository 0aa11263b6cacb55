"""Intervals open at given dates, without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def active_at(
    periods: DataFrame,
    intervals: DataFrame,
    at: str = "period_end",
    start: str = "start",
    end: str = "end",
    name: str = "active",
) -> DataFrame:
    """Add to every row of `periods` the number of intervals with start <= at < end.

    An open interval has a NULL end; one without a start is ignored. Starts and
    ends become +1 and -1 per day, summed map side, and a running sum over the
    days replaces the join. The running sum sees one row per distinct day and
    period, so its size is that of the calendar and not of the intervals.
    """
    s, e = F.col(start), F.col(end)
    moves = F.array(
        F.struct(s.alias("_day"), F.lit(1).alias("_move")),
        F.struct(F.greatest(s, e).alias("_day"), F.when(e.isNotNull(), -1).alias("_move")),
    )
    daily = (
        intervals.where(s.isNotNull())
        .select(F.explode(moves).alias("m"))
        .where(F.col("m._move").isNotNull())
        .groupBy(F.col("m._day").alias("_day"))
        .agg(F.sum("m._move").alias("_move"))
    )
    marked = periods.withColumn("_day", F.col(at)).withColumn("_period", F.lit(True))
    upto = W.orderBy("_day").rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        marked.unionByName(daily, allowMissingColumns=True)
        .withColumn(name, F.coalesce(F.sum("_move").over(upto), F.lit(0)).cast("bigint"))
        .where("_period")
        .drop("_day", "_period", "_move")
    )
