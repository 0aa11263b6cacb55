"""The member, book and supplier dimensions from operational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstar.functions.dates import as_date, open_end, years_text
from shelfstar.functions.labels import age_range, gender_code
from shelfstar.functions.numbers import clamp, nonneg
from shelfstar.functions.text import clean_upper, segment_from_right
from shelfstar.operators.lookup import merged_if_large
from shelfstar.operators.surrogate import assign_keys
from shelfstar.operators.upsert import absent

# Default start of history and popularity.
HISTORY_START = "2004-07-01"
DEFAULT_POPULARITY = 3.0

# Which address segment, counted from the right, holds the place.
MEMBER_SEGMENTS = {"initial": (2, 3), "incremental": (1, 2)}
SUPPLIER_SEGMENTS = {"initial": (3, 4), "incremental": (1, 2)}


def book_rows(titles: DataFrame, load: str = "initial", since: str = HISTORY_START) -> DataFrame:
    """Cleaned book rows without keys.

    The incremental load fills missing texts and limits popularity to 1..5.
    """
    later = load == "incremental"

    def text(name):
        return clean_upper(F.col(name), f"UNKNOWN {name.upper()}" if later else None)

    popularity = F.col("popularity").cast("decimal(4,1)")
    if later:
        popularity = clamp(popularity, 1, 5, DEFAULT_POPULARITY)
    else:
        popularity = F.coalesce(popularity, F.lit(DEFAULT_POPULARITY).cast("decimal(4,1)"))
    return titles.select(
        "book_id",
        F.lit("available" if later else "AVAILABLE").alias("book_status"),
        text("title").alias("title"),
        text("author").alias("author"),
        text("genre").alias("genre"),
        F.round(nonneg(F.col("sales_price")), 2).cast("decimal(18,2)").alias("price"),
        popularity.cast("decimal(4,1)").alias("popularity"),
        as_date(since).alias("effective_date"),
        open_end().alias("expiration_date"),
        F.lit("Y").alias("curr_ind"),
    )


def member_rows(members: DataFrame, as_of, load: str = "initial") -> DataFrame:
    """Cleaned member rows without keys; `as_of` is the day the load stands for."""
    state, city = MEMBER_SEGMENTS[load]
    today = as_date(as_of)
    since = F.coalesce("registration_date", today)
    if load == "incremental":
        name = clean_upper(F.col("member_name"), "UNKNOWN MEMBER")
        ended = F.coalesce("expire_date", today)
        active = F.lower(F.coalesce("member_status", F.lit("expire"))) == "active"
        duration = F.when(active, years_text(today, since)).otherwise(
            years_text(ended, since, " years (expired)")
        )
    else:
        name = clean_upper(F.col("member_name"))
        duration = years_text(today, F.col("registration_date"))
    return members.select(
        "member_id",
        name.alias("member_name"),
        age_range(F.col("member_age")).alias("member_age_range"),
        gender_code(F.col("member_gender")).alias("member_gender"),
        segment_from_right(F.col("member_address"), state).alias("state"),
        segment_from_right(F.col("member_address"), city).alias("city"),
        duration.alias("member_duration"),
        F.col("registration_date").alias("effective_date"),
        open_end().alias("expiration_date"),
        F.lit("Y").alias("curr_ind"),
    )


def supplier_rows(suppliers: DataFrame, load: str = "initial") -> DataFrame:
    state, city = SUPPLIER_SEGMENTS[load]
    default = "UNKNOWN SUPPLIER" if load == "incremental" else None
    return suppliers.select(
        "supplier_id",
        clean_upper(F.col("supplier_name"), default).alias("supplier_name"),
        segment_from_right(F.col("supplier_address"), state).alias("state"),
        segment_from_right(F.col("supplier_address"), city).alias("city"),
    )


def dim_book(titles: DataFrame, since: str = HISTORY_START) -> DataFrame:
    return assign_keys(book_rows(titles, since=since), "book_id", "book_key")


def dim_members(members: DataFrame, as_of) -> DataFrame:
    return assign_keys(member_rows(members, as_of), "member_id", "member_key")


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return assign_keys(supplier_rows(suppliers), "supplier_id", "supplier_key")


def new_books(dim: DataFrame, titles: DataFrame, since: str = HISTORY_START) -> DataFrame:
    """Rows for the titles the dimension lacks; keys continue after its highest."""
    return _new(dim, book_rows(titles, "incremental", since), "book_id", "book_key")


def new_members(dim: DataFrame, members: DataFrame, as_of) -> DataFrame:
    return _new(dim, member_rows(members, as_of, "incremental"), "member_id", "member_key")


def new_suppliers(dim: DataFrame, suppliers: DataFrame) -> DataFrame:
    return _new(dim, supplier_rows(suppliers, "incremental"), "supplier_id", "supplier_key")


def _new(dim: DataFrame, rows: DataFrame, id_col: str, key_col: str) -> DataFrame:
    return assign_keys(absent(rows, merged_if_large(dim), [id_col]), id_col, key_col, after=dim)
