"""Top rows of each group, ties kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statpanel.operators.joins import join_null_safe


def top_per_group(df: DataFrame, by: list[str], value: str, k: int = 1) -> DataFrame:
    """Rows whose `value` is among the `k` highest distinct values of their group.

    Distinct values combine before the shuffle, and Spark keeps at most `k` of them per group and
    task (`WindowGroupLimit`), so a group of any size, or any number of ties, is fine. The rows are then
    picked by a semi join on group and value.
    """
    if k == 1:
        highest = df.groupBy(*by).agg(F.max(value).alias(value))
    else:
        best = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last())
        highest = (
            df.select(*by, value)
            .distinct()
            .withColumn("_rank", F.dense_rank().over(best))
            .filter(F.col("_rank") <= k)
            .drop("_rank")
        )
    return join_null_safe(df, highest, [*by, value], "left_semi")


def with_top(df: DataFrame, by: list[str], value: str, label: str, name: str) -> DataFrame:
    """Every row beside the label of the highest row of its group.

    A row is repeated for each tied top row, and rows with a null in `by` are dropped. The highest value per
    group combines before the shuffle, and a semi join picks the rows that have it, so that any number of ties is fine.
    """
    rows = df.dropna(subset=by)
    labels = rows.select(*by, value, F.col(label).alias(name))
    tops = top_per_group(labels, by, value).select(*by, name)
    # The null-safe keys shuffle the tops once more. That makes both join inputs plain shuffles, the
    # only kind of which Spark splits the partition of a large group.
    return join_null_safe(rows, tops, by)
