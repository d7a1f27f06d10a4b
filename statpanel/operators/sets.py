"""Set operations on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.operators.joins import join_null_safe


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct rows of all frames, columns by position; nulls compare equal."""
    return reduce(DataFrame.union, frames).distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns by name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that are in exactly one of two frames with the same columns.

    One aggregation that combines before its only shuffle, in place of two anti joins.
    """
    sides = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(2)))
    return (
        sides.groupBy(*a.columns)
        .agg(F.bit_or("_side").alias("_side"))
        .filter(F.col("_side") != 3)
        .drop("_side")
    )


def first_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Per key, all rows of the first frame that has the key; later frames lose it. Null keys are one key.

    The first frame goes through as it is. Of all frames only the keys are combined, to the first place of each, before they are
    shuffled; rows of later frames are kept by a semi join on key and place, which Spark broadcasts, or splits where one
    key has many rows. So every frame is read twice, once for nothing but its keys: put one that is costly to make
    through `sized` before.
    """
    first, *later = frames
    if not later:
        return first
    keyed = [df.select(*keys).withColumn("_place", F.lit(i)) for i, df in enumerate(frames)]
    owners = reduce(DataFrame.union, keyed).groupBy(*keys).agg(F.min("_place").alias("_place"))
    placed = [df.withColumn("_place", F.lit(i)) for i, df in enumerate(later, 1)]
    kept = join_null_safe(reduce(DataFrame.unionByName, placed), owners.filter("_place > 0"), [*keys, "_place"], "left_semi")
    return first.unionByName(kept.drop("_place"))
