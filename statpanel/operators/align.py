"""Topics of one panel side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType


#: Rows that one step of the unfolding makes of a row.
STEP = 1 << 12


def _unfolded(df: DataFrame, count: str) -> DataFrame:
    """Every row `count` times. In two steps, so that no array is longer than STEP or a STEP-th of the count."""
    often = F.col(count)
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((often - 1) / STEP))))
    size = F.least(F.lit(STEP), often - F.col("_step") * STEP)
    return steps.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("_each", "_step", count)


def _folded(rows: DataFrame, keys: list[str], value: str, kind: DataType, column: str, count: str) -> DataFrame:
    """Distinct (keys, value) with their number. A float's zeros are one group, so the sign of zero is a key of its own."""
    by = [*keys, F.col(value).alias(column)]
    if not isinstance(kind, FractionalType) or isinstance(kind, DecimalType):
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    negative = F.col(value).cast("string") == "-0.0"
    folded = rows.groupBy(*by, negative.alias("_negative")).agg(F.count(F.lit(1)).alias(count))
    zero = F.when(F.col("_negative"), F.lit(-0.0).cast(kind)).otherwise(F.col(column))
    return folded.withColumn(column, zero).drop("_negative")


def align_topics(
    df: DataFrame,
    keys: list[str],
    topics: dict[str, str],
    *,
    topic: str = "topic",
    value: str = "datavalue",
) -> DataFrame:
    """`keys` plus one column per topic, for the keys that have every topic.

    `topics` maps a topic to its column name. A key that repeats within a topic gives every
    combination; `check_unique` finds such keys. Rows with a null key are dropped.

    Each topic is read by itself, so that a table is pruned to it; its equal rows are folded to counts that combine before the
    shuffle. The topics are then joined on the keys, where Spark broadcasts a small one and splits a key with many values, and
    the counts are unfolded last. Put a panel that is costly to make through `sized` before.
    """
    rows, kind = df.dropna(subset=keys), df.schema[value].dataType
    wide = None
    for i, (name, column) in enumerate(topics.items()):
        side = _folded(rows.filter(F.col(topic) == F.lit(name)), keys, value, kind, column, f"_n{i}")
        wide = side if wide is None else wide.join(side, keys)
    for i in range(len(topics)):
        wide = _unfolded(wide, f"_n{i}")
    return wide.select(*keys, *topics.values())


def align_topics_pivot(
    df: DataFrame,
    keys: list[str],
    topics: dict[str, str],
    *,
    topic: str = "topic",
    value: str = "datavalue",
) -> DataFrame:
    """As `align_topics`, in one scan and one shuffle, for panels where (keys, topic) is unique."""
    picked = [F.col(topic) == F.lit(name) for name in topics]
    columns = [
        F.max(F.when(is_topic, F.col(value))).alias(column)
        for is_topic, column in zip(picked, topics.values())
    ]
    present = [F.count_if(is_topic).alias(f"_n{i}") for i, is_topic in enumerate(picked)]
    rows = df.filter(F.col(topic).isin(*topics)).dropna(subset=keys)
    wide = rows.groupBy(*keys).agg(*columns, *present)
    for i in range(len(picked)):
        wide = wide.filter(F.col(f"_n{i}") > 0)
    return wide.select(*keys, *topics.values())
