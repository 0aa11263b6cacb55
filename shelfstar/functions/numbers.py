"""Exact money, ratio and clamp helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

COUNT = "decimal(20,0)"


def money(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def to_cents(col: Column) -> Column:
    """Money as whole cents. Sums of longs aggregate far faster than wide decimals;
    the session raises an error if one should overflow."""
    return (col.cast("decimal(16,2)") * F.lit(100).cast("decimal(3,0)")).cast("bigint")


def from_cents(col: Column) -> Column:
    return (col.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(28,2)")


def nonneg(col: Column) -> Column:
    """Missing or negative becomes 0."""
    return F.greatest(F.coalesce(col, F.lit(0)), F.lit(0))


def clamp(col: Column, low: float, high: float, default: float) -> Column:
    """`col` limited to low..high; missing becomes `default`."""
    value = F.coalesce(col, F.lit(default).cast("decimal(4,1)")).cast("decimal(4,1)")
    return F.least(
        F.greatest(value, F.lit(low).cast("decimal(4,1)")), F.lit(high).cast("decimal(4,1)")
    )


def greatest_or_null(*cols: Column) -> Column:
    """GREATEST that is NULL as soon as one argument is."""
    return _null_aware(F.greatest, cols)


def least_or_null(*cols: Column) -> Column:
    """LEAST that is NULL as soon as one argument is."""
    return _null_aware(F.least, cols)


def _null_aware(pick, cols):
    missing = cols[0].isNull()
    for c in cols[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, pick(*cols))


def rounded_ratio(num: Column, den: Column, scale: int = 2, times: int = 1) -> Column:
    """`times * num / den` rounded half away from zero, with no intermediate rounding.

    Decimal division keeps a limited number of digits and would round twice, so
    the quotient is taken on integers: arguments are whole counts or decimals of
    the same scale. NULL when the denominator is NULL or 0; it must not be negative.
    """
    unit = 10**scale
    sign = F.when(num < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    safe_den = F.when(den != 0, den)
    doubled = F.abs(num) * F.lit(2 * unit * times).cast("decimal(10,0)") + safe_den
    units = F.call_function("div", doubled, safe_den * F.lit(2).cast("decimal(1,0)"))
    return (sign * units).cast("decimal(20,0)").cast(f"decimal({20 + scale},{scale})") / F.lit(
        unit
    ).cast(f"decimal({scale + 1},0)")


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """Share of `whole` in percent, exact to `scale` places."""
    return rounded_ratio(part, whole, scale, times=100).cast(f"decimal(18,{scale})")


def count_percent(part: Column, whole: Column) -> Column:
    return percent(part.cast(COUNT), whole.cast(COUNT))


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    return rounded_ratio(num, den, scale).cast(f"decimal(18,{scale})")


def change_percent(now: Column, before: Column) -> Column:
    """Percent change against an earlier value."""
    return percent(now - before, before)


def count_change_percent(now: Column, before: Column) -> Column:
    return change_percent(now.cast(COUNT), before.cast(COUNT))


def signed_percent_text(col: Column) -> Column:
    """`+1.50%`, `-0.20%`."""
    sign = F.when(col < 0, "-").otherwise("+")
    return F.concat(sign, F.abs(col).cast("decimal(18,2)").cast("string"), F.lit("%"))
