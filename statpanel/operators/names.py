"""Reference lists of entity names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.functions import strip_annotation
from statpanel.operators.joins import join_null_safe
from statpanel.schema import NATIONAL_MARK, NATIONAL_NAME


def first_rows(df: DataFrame, position: str, n: int) -> DataFrame:
    """The first `n` rows by an explicit position column; each task keeps at most `n`."""
    return df.orderBy(F.col(position).asc_nulls_last()).limit(n)


def reference_names(
    country: DataFrame, states: DataFrame, district: DataFrame, *, n: int = 50, word: str = NATIONAL_NAME
) -> DataFrame:
    """`geoname` list: the marked country name, the first `n` states without annotations, the district.

    All three inputs are tables `(position, name)`. The first row of `country` must contain `word`.
    """
    named = F.regexp_extract("name", word, 0)
    nation = first_rows(country, "position", 1).filter(named != "")
    parts = [
        nation.select(F.concat(named, F.lit(NATIONAL_MARK)).alias("geoname")),
        first_rows(states, "position", n).select(strip_annotation(F.col("name")).alias("geoname")),
        first_rows(district, "position", 1).select(F.col("name").alias("geoname")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def keep_listed(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` occurs in the column of the same name of `listed`.

    A list small enough by its measured size is broadcast; a longer one is shuffled. Null is on no list.
    """
    return join_null_safe(df, listed.select(column).dropna().distinct(), [column], "left_semi")
