"""Date arithmetic used by the loaders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

OPEN_END = "9999-12-31"


def as_date(value) -> Column:
    """A Column for a date given as text, `datetime.date`, None or Column."""
    if isinstance(value, Column):
        return value
    return F.lit(None if value is None else str(value)).cast("date")


def open_end() -> Column:
    return as_date(OPEN_END)


def quarter_number(month: Column) -> Column:
    return F.ceil(month / F.lit(3)).cast("int")


def years_text(until: Column, since: Column, suffix: str = " years") -> Column:
    """Years between two dates to one decimal, as text."""
    years = (F.months_between(until, since) / F.lit(12)).cast("decimal(20,8)")
    return F.concat(F.round(years, 1).cast("decimal(10,1)").cast("string"), F.lit(suffix))


def expiry_after_renewals(registered: Column, renewals: Column) -> Column:
    """Last day of a membership after `renewals` yearly renewals."""
    return F.date_sub(F.add_months(registered, (renewals + 1) * 12), 1)


def overdue_days(due: Column, returned: Column, as_of: Column) -> Column:
    """Days late: open loans count up to `as_of`, returned ones up to the return."""
    late = F.when(returned.isNull(), F.datediff(as_of, due)).otherwise(F.datediff(returned, due))
    return nonneg_int(late)


def loan_days(borrowed: Column, returned: Column, as_of: Column) -> Column:
    return F.coalesce(F.datediff(F.coalesce(returned, as_of), borrowed), F.lit(0)).cast("bigint")


def nonneg_int(col: Column) -> Column:
    return F.greatest(F.coalesce(col, F.lit(0)), F.lit(0)).cast("bigint")


def whole_hours(start: Column, end: Column) -> Column:
    """Full hours between two timestamps, minutes dropped; NULL counts as none."""
    seconds = F.timestamp_diff("SECOND", start, end)
    return F.when(seconds < 0, F.ceil(seconds / 3600)).otherwise(F.floor(seconds / 3600))


def seconds_of_day(col: Column) -> Column:
    return F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
