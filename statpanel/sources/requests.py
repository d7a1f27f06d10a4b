"""Requests of a manifest as a data source of Spark: one request is one input partition, and filters choose the requests."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

REQUEST = ("table", "line_code", "code")


class Request(InputPartition):
    def __init__(self, table: str, line_code: str, code: str):
        super().__init__((table, line_code, code))
        self.parts = (table, line_code, code)


def open_requests(
    manifest: DataFrame, fetch: Callable[[str, str], Iterator], schema: StructType, *, most: int = 1_000_000
) -> DataFrame:
    """A frame with the columns of `schema`, and `table`, `line_code` and `code`, that fetches a request when a task reads it.

    Each request of the manifest is one input partition. Filters that compare `table`, `line_code` or `code` with constants are
    applied to the list of requests before anything is planned, so those that are not wanted are never fetched; Spark evaluates all
    others. `fetch(table, line_code)` yields Arrow record batches with the columns of `schema`; it must be repeatable and picklable,
    as for `fetch_requests`. A plan names its input partitions, so the distinct requests go to the driver: a manifest of
    more than `most` raises, use `fetch_requests` there. Null parts of a request are left out. An empty manifest gives no rows.

    Lets the session push filters to Python sources (`spark.sql.python.filterPushdown.enabled`).
    """
    spark = manifest.sparkSession
    rows = manifest.select(*REQUEST).dropna().distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} requests; use fetch_requests")
    requests = sorted(tuple(r) for r in rows)
    names = schema.fieldNames()
    out = StructType([*schema.fields, *[StructField(c, StringType()) for c in REQUEST]])

    class Reader(DataSourceReader):
        def __init__(self):
            self.wanted = requests

        def pushFilters(self, filters: list[Filter]):  # noqa: N802
            for f in filters:
                column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
                if column not in REQUEST:
                    yield f
                    continue
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted = [r for r in self.wanted if r[REQUEST.index(column)] in values]

        def partitions(self):
            # Spark wants at least one partition, also where no request is left.
            return [Request(*r) for r in self.wanted] or [Request("", "", "")]

        def read(self, partition: Request):
            import pyarrow as pa

            if partition.parts == ("", "", ""):
                return
            for batch in fetch(*partition.parts[:2]):
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                columns += [pa.array([part] * batch.num_rows, pa.string()) for part in partition.parts]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *REQUEST])

    class Requests(DataSource):
        @classmethod
        def name(cls):
            return source

        def schema(self):
            return out

        def reader(self, schema):
            return Reader()

    source = f"requests_{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Requests)
    return spark.read.format(source).load()
