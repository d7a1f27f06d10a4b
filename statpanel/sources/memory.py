"""Arrow tables and cached frames."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def from_arrow(spark: SparkSession, table: pa.Table, view: str | None = None) -> DataFrame:
    """DataFrame of an Arrow table held by the driver, also under a view name if one is given."""
    df = spark.createDataFrame(table)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def to_arrow(df: DataFrame, max_rows: int = 100_000) -> pa.Table:
    """Arrow table of a small result. A larger one raises: write it with a sink instead."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it with a sink instead")
    return table


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` on the executors, spilling to disk, while the block runs."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


class Memo:
    """Frames kept on the executors, found again by what they compute.

    `memo(df)` gives the kept frame of the same meaning, and keeps `df` if there is none: two callers that build one panel separately share it,
    as they would the result of a memoised function. At most `most` frames are kept; the one unused for longest is released first.
    `release` lets one go, or all; as a context manager the memo releases all at its end.
    """

    def __init__(self, most: int = 8):
        self.most = most
        self._kept: OrderedDict[int, list[DataFrame]] = OrderedDict()

    def __len__(self) -> int:
        return sum(map(len, self._kept.values()))

    def __call__(self, df: DataFrame) -> DataFrame:
        key = df.semanticHash()
        for kept in self._kept.get(key, []):
            if kept.sameSemantics(df) and kept.columns == df.columns:
                self._kept.move_to_end(key)
                return kept
        while len(self) >= self.most:
            self.release(next(iter(self._kept.values()))[0])
        self._kept.setdefault(key, []).append(df.persist(StorageLevel.MEMORY_AND_DISK))
        self._kept.move_to_end(key)
        return df

    def release(self, df: DataFrame | None = None) -> None:
        for key, frames in list(self._kept.items()):
            gone = [kept for kept in frames if df is None or kept.sameSemantics(df)]
            for kept in gone:
                kept.unpersist()
                frames.remove(kept)
            if not frames:
                del self._kept[key]

    def __enter__(self) -> Memo:
        return self

    def __exit__(self, *_) -> None:
        self.release()
