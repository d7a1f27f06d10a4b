"""Change from one period to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statpanel.functions import pct_change, previous
from statpanel.operators.joins import sized


def change(
    df: DataFrame,
    entity: list[str],
    period: str,
    value: str,
    *,
    base: str = "current",
    digits: int = 2,
    prev_name: str = "prev",
    change_name: str = "change",
    chunk: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add the value of the period before and the percent change against it.

    The period before is the one before *among the rows given*: filter periods first if the first
    kept one must have no predecessor. The change divides by the current value unless
    `base="previous"`. Rows of one period are taken in order of their value, so that a re-run
    task gives the same rows.

    A series (one `entity`) holds one row per period, so its window is as long as the calendar.
    For series too long for one task, give `chunk`: a column that never decreases in that order, such
    as `F.substring("timeperiod", 1, 3)`. Each chunk is then its own window, which starts from the last
    value of the chunk before. Results are the same. Where no such column is known, give `ranges`: the rows are dealt
    into so many ranges of (entity, period) of about equal size and written to the shared working folder, and each range of a series is a chunk.
    """
    v = F.col(value)
    order = [F.col(period).asc_nulls_last(), v.asc_nulls_last()]
    if ranges is not None:
        df = _in_ranges(df, entity, order, ranges)
        chunk = F.col("_range")
    if chunk is None:
        series = Window.partitionBy(*entity).orderBy(*order)
        with_prev = df.withColumn(prev_name, previous(v, series))
    else:
        with_prev = _previous_by_chunk(df, entity, period, value, order, prev_name, chunk)
    return with_prev.drop("_range").withColumn(change_name, pct_change(v, F.col(prev_name), base, digits))


def _in_ranges(df: DataFrame, entity: list[str], order: list[Column], ranges: int) -> DataFrame:
    """`df` with the number of its range, which never decreases in the order of a series.

    The bounds of the ranges are drawn from a sample, another one each time, so the numbers are written with the rows.
    """
    by = [F.col(c).asc_nulls_last() for c in entity]
    return sized(df.repartitionByRange(ranges, *by, *order).withColumn("_range", F.spark_partition_id()))


def _previous_by_chunk(
    df: DataFrame,
    entity: list[str],
    period: str,
    value: str,
    order: list[Column],
    prev_name: str,
    chunk: Column,
) -> DataFrame:
    """Last values are combined before the shuffle, and join their next chunk as one extra row."""
    v = F.col(value)
    rows = df.withColumns({"_chunk": chunk, "_carried": F.lit(False)})
    place = F.struct(F.col(period).isNull(), F.col(period), v.isNull(), v)
    chunks = Window.partitionBy(*entity).orderBy(F.col("_chunk").asc_nulls_last())
    carried = (
        rows.groupBy(*entity, "_chunk")
        .agg(F.max_by(v, place).alias(value))
        .withColumns({value: previous(v, chunks), "_carried": F.lit(True)})
    )
    in_chunk = Window.partitionBy(*entity, "_chunk").orderBy(F.col("_carried").desc(), *order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(prev_name, previous(v, in_chunk))
        .filter(~F.col("_carried"))
        .drop("_chunk", "_carried")
    )
