"""Text cleaning, address segments and composed identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "UNKNOWN"


def null_if_blank(col: Column) -> Column:
    """Blank text counts as missing."""
    trimmed = F.trim(col)
    return F.when(trimmed != "", trimmed)


def clean_upper(col: Column, default: str | None = None) -> Column:
    """Trimmed upper-case text; missing text becomes `default` when one is given."""
    cleaned = F.upper(null_if_blank(col))
    return cleaned if default is None else F.coalesce(cleaned, F.lit(default))


def segment_from_right(col: Column, position: int) -> Column:
    """The comma segment `position` places from the right, upper-cased.

    Text holding fewer than `position` commas gives UNKNOWN; an empty segment
    gives NULL.
    """
    parts = F.split(col, ",")
    found = F.upper(null_if_blank(F.try_element_at(parts, F.lit(-position))))
    return F.when(F.size(parts) > position, found).otherwise(F.lit(UNKNOWN))


def business_id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number, e.g. `B0042`; long numbers are kept whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def id_number(col: Column) -> Column:
    """The number inside a business id: `M0042` gives 42."""
    return F.regexp_substr(col, F.lit(r"\d+")).cast("bigint")


def joined_key(*cols: Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def normalised_genre(col: Column) -> Column:
    """Spelling variants of one genre folded to one label (`NONFICTION`, `NON FICTION`)."""
    letters = F.regexp_replace(F.upper(F.trim(col)), r"[\s-]+", " ")
    return F.regexp_replace(letters, r"^NON ?FICTION$", "NON-FICTION")
