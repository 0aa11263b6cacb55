"""The calendar dimension and its holidays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfstar.functions.dates import as_date, quarter_number

FIRST_KEY = 100001
REGULAR_DAY = "Regular Day"

# Holidays of fixed date (month, day, name, type, first year).
FIXED_HOLIDAYS = (
    (1, 1, "New Year's Day", "National", 2000),
    (2, 1, "Federal Territory Day", "Regional", 2000),
    (5, 1, "Labour Day", "National", 2000),
    (8, 31, "National Day", "National", 2000),
    (9, 16, "Malaysia Day", "National", 2010),
    (12, 25, "Christmas", "National", 2000),
)


def fixed_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per fixed-date holiday and year."""
    values = ", ".join(
        f'({month}, {day}, "{name}", "{kind}", {since})'
        for month, day, name, kind, since in FIXED_HOLIDAYS
    )
    rules = spark.sql(
        f"SELECT * FROM VALUES {values} AS r(month, day, festive_event, holiday_type, since)"
    )
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return (
        rules.withColumn("year", years)
        .where(F.col("year") >= F.col("since"))
        .select(
            F.make_date("year", "month", "day").alias("cal_date"), "festive_event", "holiday_type"
        )
    )


def days_between(spark: SparkSession, first, last) -> DataFrame:
    """One row per day of a closed range."""
    return spark.range(1).select(
        F.explode(F.sequence(as_date(first), as_date(last))).alias("cal_date")
    )


def days_covering(*dates: DataFrame) -> DataFrame:
    """One row per day of every whole year touched by the single date column of `dates`."""
    spans = None
    for df in dates:
        d = F.col(df.columns[0])
        span = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
        spans = span if spans is None else spans.unionByName(span)
    return spans.agg(
        F.trunc(F.min("lo"), "YEAR").alias("lo"),
        F.date_sub(F.add_months(F.trunc(F.max("hi"), "YEAR"), 12), 1).alias("hi"),
    ).select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))


def date_key(day: Column, first_day) -> Column:
    """Key of a day in a calendar that starts on `first_day`."""
    return (F.lit(FIRST_KEY) + F.datediff(day, as_date(first_day))).cast("bigint")


def dim_date(days: DataFrame, holidays: DataFrame, first_key: int | Column = FIRST_KEY) -> DataFrame:
    """The calendar dimension over `days` (column cal_date), one row per day.

    Keys count the days from the first one. Both inputs are bounded by the
    calendar, so the holiday join is a broadcast.
    """
    d = F.col("cal_date")
    year, month = F.year(d), F.month(d)
    quarter = F.concat(F.lit("Q"), quarter_number(month).cast("string"))
    weekday = F.dayofweek(d).between(2, 6)
    first = days.agg(F.min("cal_date")).scalar()
    holiday = holidays.groupBy("cal_date").agg(F.min("festive_event").alias("_event"))
    base = first_key if isinstance(first_key, Column) else F.lit(first_key)
    return (
        days.join(F.broadcast(holiday), "cal_date", "left")
        .select(
            (base + F.datediff(d, first)).cast("bigint").alias("date_key"),
            d,
            F.date_format(d, "yyyy MMMM dd").alias("full_desc"),
            F.dayofweek(d).alias("day_of_week"),
            F.dayofmonth(d).alias("day_num_month"),
            F.dayofyear(d).alias("day_num_year"),
            F.upper(F.date_format(d, "MMMM")).alias("month_name"),
            month.alias("cal_month_year"),
            F.date_format(d, "yyyy-MM").alias("cal_year_month"),
            quarter.alias("cal_quarter"),
            F.concat_ws("-", year.cast("string"), quarter).alias("cal_year_quarter"),
            year.alias("cal_year"),
            _yn(F.col("_event").isNotNull()).alias("holiday_indicator"),
            _yn(weekday).alias("weekday_indicator"),
            F.coalesce("_event", F.lit(REGULAR_DAY)).alias("festive_event"),
            _yn(weekday & F.col("_event").isNull()).alias("business_day_ind"),
        )
    )


def extend_calendar(dim: DataFrame, first, last) -> DataFrame:
    """Days of first..last that the calendar lacks, as regular days."""
    every = days_between(dim.sparkSession, first, last)
    days = every.join(dim.select("cal_date"), "cal_date", "left_anti")
    none = every.where(F.lit(False)).select("cal_date", F.lit("").alias("festive_event"))
    start = F.coalesce(dim.agg(F.max("date_key") + 1).scalar(), F.lit(FIRST_KEY))
    return dim_date(days, none, first_key=start)


def month_flags(dim: DataFrame) -> DataFrame:
    """Yes or No per month: does it hold a holiday?"""
    return dim.groupBy(F.trunc("cal_date", "MM").alias("month_start")).agg(
        F.when(F.bool_or(F.col("holiday_indicator") == "Y"), "Yes").otherwise("No").alias(
            "festive_events"
        )
    )


def _yn(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def within_years(
    fact: DataFrame, dim: DataFrame, years: tuple[int, int] | None
) -> tuple[DataFrame, DataFrame]:
    """Fact and calendar limited to a closed range of years.

    The first and last key of the range, one row of the bounded calendar, become
    literals, so the filter reaches the scan of the fact.
    """
    if years is None:
        return fact, dim
    days = dim.where(F.col("cal_date").between(*year_range(*years)))
    low, high = days.agg(F.min("date_key"), F.max("date_key")).first()
    return fact.where(F.col("date_key").between(low, high)), days


def year_range(first_year: int, last_year: int) -> Sequence[str]:
    """The closed date range of whole years, so filters reach the scan as date bounds."""
    return f"{first_year}-01-01", f"{last_year}-12-31"
