"""Equi-join in which null keys meet null keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame

from statpanel.sources.scratch import scratch_path


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on `keys` with `<=>`, which Spark still plans as an equi-join.

    No side carries a broadcast hint: Spark broadcasts one when its measured size is below
    `spark.sql.autoBroadcastJoinThreshold`, and else shuffles both and splits skewed partitions.
    """
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def sized(df: DataFrame) -> DataFrame:
    """`df` written to the shared working folder and read again, so that Spark knows its bytes.

    For dimensions that Spark cannot size before it runs them, such as the distinct rows of a table: a join then broadcasts
    one below `spark.sql.autoBroadcastJoinThreshold`, and shuffles a larger one. Call it once and pass the result on.
    """
    path = scratch_path(df.sparkSession, "sized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
