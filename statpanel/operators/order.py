"""Presentation order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Total ascending sort, nulls last. Use it on what is shown or exported, not inside a query."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
