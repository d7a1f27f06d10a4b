"""Landing of extracts as one table, partitioned by dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from statpanel.functions import dataset_of, table_of
from statpanel.operators.names import keep_listed
from statpanel.operators.sets import union_by_name
from statpanel.schema import DATASET_OF_TABLE, UNROUTED


def route(df: DataFrame, datasets: dict[str, str] = DATASET_OF_TABLE) -> DataFrame:
    """Add `dataset`, found by the table part of the code; codes of unknown tables get `_unrouted`."""
    dataset = dataset_of(table_of(F.col("code")), datasets)
    return df.withColumn("dataset", F.coalesce(dataset, F.lit(UNROUTED)))


def _same_types(frames: list[DataFrame]) -> list[DataFrame]:
    """Numbers that are whole in one frame and not in another become text, which holds both without loss."""
    kinds: dict[str, list] = {}
    for frame in frames:
        for field in frame.schema:
            if isinstance(field.dataType, NumericType):
                kinds.setdefault(field.name, []).append(field.dataType)
    mixed = [n for n, k in kinds.items() if len({isinstance(x, IntegralType) for x in k}) > 1]
    return [f.withColumns({n: F.col(n).cast("string") for n in mixed if n in f.columns}) for f in frames]


def land(
    frames: list[DataFrame],
    names: DataFrame | None,
    path: str,
    datasets: dict[str, str] = DATASET_OF_TABLE,
    *,
    rebalance: bool = False,
) -> DataFrame:
    """Write all frames as parquet under `path/dataset=...` and return the rows per dataset.

    Keeps the rows whose `geoname` is listed in `names` (all rows if None). The write needs no shuffle:
    a task reads one extract, so it writes one dataset. With `rebalance=True` the rows are
    shuffled by dataset first, small partitions are merged and large ones split by size, for
    inputs that are mixed or come in many small pieces. The counts come from the file footers.

    A measure that is whole in some frames and fractional in others lands as text: a common number type would round
    whole numbers above 2**53. `load_tables` gives each dataset its own type again.
    """
    rows = union_by_name(*_same_types(frames))
    if names is not None:
        rows = keep_listed(rows, names, "geoname")
    rows = route(rows, datasets)
    if rebalance:
        rows = rows.hint("rebalance", "dataset")
    rows.write.mode("errorifexists").partitionBy("dataset").parquet(path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return written.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))
