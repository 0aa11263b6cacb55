"""Distribution and range profiles of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstar.functions.numbers import count_percent
from shelfstar.session import settle


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent of all rows per value. The total is taken from the counts, so the rows are read once."""
    counts = settle(df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", count_percent(F.col("cnt"), total))


def range_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows, minimum, maximum and mean of one column."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.round(F.sum(c).cast("decimal(28,2)") / F.count(c), 2).cast("decimal(18,2)").alias(
            "avg_value"
        ),
    )
