"""Dense rank inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, NumericType

from statpanel.operators.joins import join_null_safe

# Bits of the slot number that one window covers: at most 2**21 slots, so as many rows.
BITS = 21
_LONG_MIN = -(2**63)
_SLOT_LIMIT = float(2**62)


def _bits(real: Column) -> Column:
    """A bigint that grows with a double and that at most a few neighbouring doubles share: exponent, then mantissa."""
    size = F.abs(real)
    power = F.greatest(F.floor(F.log2(size)), F.lit(-1074))
    rest = F.least(F.greatest(size / F.pow(F.lit(2.0), power), F.lit(1.0)), F.lit(2.0))
    # The exponent alone fills a double's digits, so it is added as a whole number.
    slot = (power + 1075).cast("bigint") * 2**51 + ((rest - 1) * float(2**51)).cast("bigint")
    slot = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2100 * 2**51)).otherwise(slot)
    return F.when(real < 0, -slot).when(real.isNotNull(), slot)


def _slot(value: Column, kind: DataType, digits: int | None) -> Column:
    """A bigint that never decreases as the value grows; nulls come lowest, NaN highest."""
    if isinstance(kind, IntegralType):
        slot = value.cast("bigint")
    elif digits is None:
        real = value.cast("double")
        slot = F.when(~F.isnan(real), _bits(real)).when(value.isNotNull(), F.lit(2**63 - 1))
    else:
        real = value.cast("double")
        scaled = F.floor(F.least(F.greatest(real * float(10**digits), F.lit(-_SLOT_LIMIT)), F.lit(_SLOT_LIMIT)))
        slot = F.when(~F.isnan(real), scaled).when(value.isNotNull(), F.lit(2**63 - 1))
        if isinstance(kind, DecimalType):
            slot = scaled
    return F.coalesce(slot, F.lit(_LONG_MIN))


def rank_within(df: DataFrame, by: list[str], value: str, name: str, *, digits: int | None = None) -> DataFrame:
    """Add `name`: dense rank (bigint, 1 = highest) of `value` among the rows with the same `by`.

    Nulls rank last and are ranked, not left out; rows with null `by` form their own group.

    A dense rank depends only on the distinct values, and a group such as (year, category) holds a
    large share of all rows. So the rows are first reduced to distinct values, which combines before
    the shuffle. The values are then cut into slots in order: a window inside one slot range gives
    the local rank, the counts of the ranges above it give the offset. No window holds more than 2**22
    values, whether whole or fractional (but decimals that are one double share a slot). For numbers rounded
    to `digits`, naming that makes fewer and fuller windows; do not name it for others, whose slots would fill without
    bound. At the end the ranks are joined back; only that join moves whole rows.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, NumericType):
        raise TypeError(f"rank_within needs a numeric column, {value!r} is {kind.simpleString()}")

    values = df.select(*by, value).distinct().withColumn("_slot", _slot(F.col(value), kind, digits))
    values = values.select(
        *by,
        value,
        F.shiftright("_slot", BITS).alias("_fine"),
        F.shiftright("_slot", 2 * BITS).alias("_coarse"),
    )
    fine = values.groupBy(*by, "_coarse", "_fine").agg(F.count(F.lit(1)).alias("_n"))
    coarse = fine.groupBy(*by, "_coarse").agg(F.sum("_n").alias("_n"))

    offsets = join_null_safe(
        _count_above(fine, [*by, "_coarse"], "_fine", "_above_fine"),
        _count_above(coarse, by, "_coarse", "_above_coarse"),
        [*by, "_coarse"],
    ).select(*by, "_fine", (F.col("_above_fine") + F.col("_above_coarse")).alias("_above"))

    in_range = Window.partitionBy(*by, "_fine").orderBy(F.col(value).desc_nulls_last())
    local = values.select(*by, value, "_fine", F.dense_rank().over(in_range).cast("bigint").alias("_local"))
    ranks = join_null_safe(local, offsets, [*by, "_fine"]).select(
        *by, value, (F.col("_local") + F.col("_above")).alias(name)
    )
    return join_null_safe(df, ranks, [*by, value])


def _count_above(counts: DataFrame, within: list[str], slot: str, name: str) -> DataFrame:
    """Number of values in the higher slots of the same parent range."""
    higher = (
        Window.partitionBy(*within)
        .orderBy(F.col(slot).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn(name, F.coalesce(F.sum("_n").over(higher), F.lit(0))).drop("_n")
