"""Lending trends by month, quarter and year.

The lending fact is reduced to (month, genre) in its only scan. Everything
after that works on a table bounded by the calendar, so the windows over all
periods and the cross joins with one-row tables stay small at any fact size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfstar.functions.dates import quarter_number
from shelfstar.functions.numbers import count_change_percent, signed_percent_text
from shelfstar.operators.active import active_at
from shelfstar.operators.calendar import month_flags, within_years, year_range
from shelfstar.operators.lookup import sum_by_attribute
from shelfstar.operators.windows import first_row, moving_average, previous


def genre_months(
    fact: DataFrame, dim_date: DataFrame, dim_book: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """Loans per (month_start, genre). `fact` has date_key and book_key."""
    fact, days = within_years(fact, dim_date, years)
    days = days.select("date_key", F.trunc("cal_date", "MM").alias("month_start"))
    rows = fact.join(F.broadcast(days), "date_key").select(
        "month_start", "book_key", F.lit(1).cast("bigint").alias("borrow_cnt")
    )
    return sum_by_attribute(
        rows, dim_book.select("book_key", "genre"), "book_key", ["month_start"], ["borrow_cnt"], "left"
    )


def month_table(genres: DataFrame) -> DataFrame:
    """Per month: loans and the leading genres, ties joined by '/'."""
    best = F.max("borrow_cnt").over(W.partitionBy("month_start"))
    leading = F.collect_list(F.when(F.col("borrow_cnt") == F.col("_best"), F.col("genre")))
    return (
        genres.withColumn("_best", best)
        .groupBy("month_start")
        .agg(
            F.sum("borrow_cnt").alias("borrow_cnt"),
            F.nullif(F.array_join(F.array_sort(leading), "/"), F.lit("")).alias("top_genre"),
        )
        .select(
            F.year("month_start").alias("yr"),
            F.month("month_start").alias("mon"),
            "month_start",
            F.last_day("month_start").alias("month_end"),
            "borrow_cnt",
            "top_genre",
        )
    )


def with_seasonal_index(months: DataFrame) -> DataFrame:
    """Add the strength of each calendar month in percent; 0 is an average month.

    The mean of a calendar month over the years is set against the mean of those
    twelve means. The month table is bounded by the calendar, hence the window
    over all of it.
    """
    calendar_month = W.partitionBy("mon")
    mean = F.sum("borrow_cnt").over(calendar_month) / F.count("borrow_cnt").over(calendar_month)
    once = first_row(["month_start"], ["mon"])
    marked = months.withColumn("_mean", mean).withColumn("_once", once)
    overall = F.avg(F.when(F.col("_once"), F.col("_mean"))).over(W.partitionBy())
    index = (F.col("_mean") / F.nullif(overall, F.lit(0.0)) * 100 - 100).cast("decimal(20,10)")
    return marked.withColumn(
        "seasonal_index_pct", F.round(index, 2).cast("decimal(18,2)")
    ).drop("_mean", "_once")


def copies_in_service(copies: DataFrame) -> DataFrame:
    status = F.upper(F.coalesce("book_status", F.lit("AVAILABLE")))
    return copies.where(status != "UNAVAILABLE").agg(F.count(F.lit(1)).alias("total_copies"))


def month_stats(
    months: DataFrame, spans: DataFrame, copies: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """The month table with open loans, free copies, seasonality and windows per year."""
    order, per_year = ["month_start"], ["yr"]
    return (
        active_at(months, spans, at="month_end", name="active_loans_end")
        .withColumn(
            "net_copies_available",
            copies_in_service(copies).scalar() - F.col("active_loans_end"),
        )
        .join(F.broadcast(month_flags(dim_date)), "month_start", "left")
        .transform(with_seasonal_index)
        .withColumns(
            {
                "quarter_num": quarter_number(F.col("mon")),
                "prev_month": previous("borrow_cnt", order, per_year),
                "moving_avg_3": moving_average("borrow_cnt", order, per_year),
            }
        )
        .withColumn(
            "pct_vs_prev", count_change_percent(F.col("borrow_cnt"), F.col("prev_month"))
        )
    )


def fill_missing_months(months: DataFrame) -> DataFrame:
    """Add a zero row for every month absent between the first and the last one."""
    following = F.lead("month_start").over(W.orderBy("month_start"))
    until = F.coalesce(F.add_months(following, -1), F.col("month_start"))
    steps = F.sequence("month_start", "_until", F.expr("interval 1 month"))
    filled = months.withColumn("_until", until).withColumn("_start", F.explode(steps))
    real = F.col("_start") == F.col("month_start")
    return filled.select(
        F.year("_start").alias("yr"),
        F.month("_start").alias("mon"),
        F.col("_start").alias("month_start"),
        F.last_day("_start").alias("month_end"),
        F.when(real, F.col("borrow_cnt")).otherwise(0).cast("bigint").alias("borrow_cnt"),
        F.when(real, F.col("top_genre")).alias("top_genre"),
    )


def trend_month(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_book: DataFrame,
    spans: DataFrame,
    copies: DataFrame,
    spine: bool = False,
) -> DataFrame:
    """Monthly trend, 19 columns. With `spine`, missing months count as 0 loans."""
    months = month_table(genre_months(fact, dim_date, dim_book))
    if spine:
        months = fill_missing_months(months)
    last_year = previous("borrow_cnt", ["month_start"], rows=12)
    return (
        month_stats(months, spans, copies, dim_date)
        .withColumn("prev_year_borrows", last_year)
        .select(
            F.col("yr").alias("year"),
            "quarter_num",
            F.col("mon").alias("month_num"),
            F.date_format("month_start", "MMM").alias("month_name"),
            F.date_format("month_start", "yyyy-MM").alias("year_month"),
            (F.col("yr") * 100 + F.col("mon")).alias("year_month_key"),
            F.col("month_start").alias("period_start_date"),
            F.col("month_end").alias("period_end_date"),
            F.col("borrow_cnt").alias("borrows"),
            F.col("prev_month").alias("prev_month_borrows"),
            F.col("pct_vs_prev").alias("mom_pct"),
            "prev_year_borrows",
            count_change_percent(F.col("borrow_cnt"), F.col("prev_year_borrows")).alias("yoy_pct"),
            "moving_avg_3",
            "seasonal_index_pct",
            "active_loans_end",
            "net_copies_available",
            "top_genre",
            "festive_events",
        )
    )


def _levels(stats: DataFrame, names: list[str]) -> DataFrame:
    """One row per month, quarter, year and grand period, from the month rows alone.

    Month-only columns stay NULL above the month; an end-of-period figure is the
    one of the last month present.
    """
    grain, last = F.col("grain"), F.col("month_end")
    month_only = ["moving_avg_3", "seasonal_index_pct", "top_genre", "festive_events"]
    exploded = stats.withColumn("grain", F.explode(F.array(*[F.lit(n) for n in names])))
    keyed = exploded.withColumn("level_year", F.when(grain != "GRAND", F.col("yr"))).withColumn(
        "level_period",
        F.when(grain == "MONTH", F.col("mon")).when(grain == "QUARTER", F.col("quarter_num")),
    )
    return keyed.groupBy("grain", "level_year", "level_period").agg(
        F.min("month_start").alias("start"),
        F.max("month_end").alias("end"),
        F.max("quarter_num").alias("quarter_num"),
        F.sum("borrow_cnt").alias("borrows"),
        F.max_by("active_loans_end", last).alias("active_loans_end"),
        F.max_by("net_copies_available", last).alias("net_copies_available"),
        *[F.max(F.when(grain == "MONTH", F.col(c))).alias(c) for c in month_only],
    )


def _with_previous(levels: DataFrame) -> DataFrame:
    before = previous("borrows", ["level_period"], ["grain", "level_year"])
    return levels.withColumn("prev_borrows", before).withColumn(
        "pct_vs_prev", count_change_percent(F.col("borrows"), F.col("prev_borrows"))
    )


def trend_month_quarter(
    fact: DataFrame, dim_date: DataFrame, dim_book: DataFrame, spans: DataFrame, copies: DataFrame
) -> DataFrame:
    """Month and quarter rows of the trend, 17 columns."""
    months = month_table(genre_months(fact, dim_date, dim_book))
    stats = month_stats(months, spans, copies, dim_date)
    is_month = F.col("grain") == "MONTH"
    quarter = F.concat(F.col("level_year").cast("string"), F.lit("-Q"), F.col("quarter_num"))
    return _with_previous(_levels(stats, ["MONTH", "QUARTER"])).select(
        "grain",
        F.col("level_year").alias("year"),
        "quarter_num",
        F.when(is_month, F.col("level_period")).alias("month_num"),
        F.when(is_month, F.date_format("start", "yyyy-MM")).alias("year_month"),
        F.when(~is_month, quarter).alias("year_quarter"),
        F.col("start").alias("period_start_date"),
        F.col("end").alias("period_end_date"),
        "borrows",
        F.col("prev_borrows").alias("prev_period_borrows"),
        "pct_vs_prev",
        "moving_avg_3",
        "seasonal_index_pct",
        "active_loans_end",
        "net_copies_available",
        "top_genre",
        "festive_events",
    )


# Row labels of the report.
YEAR_TOTAL_LABEL, GRAND_TOTAL_LABEL = "Total", "Grand Total"


def trend_report(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_book: DataFrame,
    spans: DataFrame,
    copies: DataFrame,
    first_year: int,
    last_year: int,
) -> DataFrame:
    """Months with quarter, year and grand totals for a closed range of years.

    Seasonality compares only the chosen years. Order the rows by sort_year,
    sort_quarter, sort_row.
    """
    years = (first_year, last_year)
    months = month_table(genre_months(fact, dim_date, dim_book, years))
    open_by_end = spans.where(F.col("start") <= year_range(*years)[1])
    stats = month_stats(months, open_by_end, copies, dim_date)
    levels = _with_previous(_levels(stats, ["MONTH", "QUARTER", "YEAR", "GRAND"]))
    grain, period = F.col("grain"), F.col("level_period")
    in_quarter = (period - 1) % 3 + 1
    quarter = F.concat(F.lit("Q"), F.col("quarter_num"))
    lead = F.when(in_quarter == 1, quarter).otherwise("")
    within = grain.isin("MONTH", "QUARTER")
    year_row = first_row(["level_period"], ["grain", "level_year"])
    return levels.withColumn("_first", year_row).select(
        F.when((grain == "MONTH") & F.col("_first"), F.col("level_year")).alias("year"),
        F.when(grain == "MONTH", F.concat(F.rpad(lead, 6, " "), F.date_format("start", "MMM")))
        .when(grain == "QUARTER", F.concat(quarter, F.lit(" Total")))
        .when(grain == "YEAR", YEAR_TOTAL_LABEL)
        .otherwise(GRAND_TOTAL_LABEL)
        .alias("period_label"),
        "borrows",
        F.when(within, F.col("prev_borrows")).alias("last_period"),
        F.when(within, F.col("pct_vs_prev")).alias("pct_vs_last"),
        F.col("moving_avg_3").alias("ma3"),
        signed_percent_text(F.col("seasonal_index_pct")).alias("season_var"),
        F.when(within, F.col("net_copies_available")).alias("net_avail"),
        "top_genre",
        "festive_events",
        F.coalesce("level_year", F.lit(9999)).alias("sort_year"),
        F.when(within, F.col("quarter_num")).otherwise(99).alias("sort_quarter"),
        F.when(grain == "MONTH", in_quarter)
        .when(grain == "QUARTER", 91)
        .when(grain == "YEAR", 99)
        .otherwise(999)
        .alias("sort_row"),
    )
