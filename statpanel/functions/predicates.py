"""Boolean and category expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from statpanel.functions.numbers import year_number


def any_null(columns: list[str]) -> Column:
    """True where at least one of the columns is null."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def at_least_year(period: Column, year: int) -> Column:
    """Numeric lower bound on a year held as text; text that is no number does not pass."""
    return year_number(period) >= F.lit(year)


def categorise(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Label of the first LIKE pattern that matches, null when none does."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(text.like(pattern), F.lit(name)) for pattern, name in rules])
