"""Observations per request, where a request is a (table, line code) pair of a manifest."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def fetch_requests(
    manifest: DataFrame,
    fetch: Callable[[str, str], Iterator],
    schema: StructType,
    *,
    partitions: int | None = None,
) -> DataFrame:
    """Run `fetch(table, line_code)` for every request of the manifest, in parallel tasks.

    `fetch` yields Arrow record batches with the columns of `schema`, so that a response is never held
    whole; `code` (the request) is added. The manifest stays distributed; it is dealt out over
    `partitions` tasks, by default one per core. `fetch` must be repeatable, as a lost
    task is run again, and must be picklable: define it inside a function, with its imports in its body.
    """
    names = schema.fieldNames()

    def pull(batches):
        import pyarrow as pa

        for batch in batches:
            requests = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for table, line_code, code in requests:
                for part in fetch(table, line_code):
                    columns = [part.column(part.schema.get_field_index(n)) for n in names]
                    columns.append(pa.array([code] * part.num_rows, pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "code"])

    requests = manifest.select("table", "line_code", "code")
    # Dealt out by number: a repartition by the key columns would be folded into the shuffle of a
    # distinct manifest, whose few small partitions are then merged into one.
    tasks = partitions or manifest.sparkSession.sparkContext.defaultParallelism
    requests = requests.repartition(tasks)
    out = StructType([*schema.fields, StructField("code", StringType())])
    return requests.mapInArrow(pull, out)


def write_responses(df: DataFrame, path: str) -> None:
    """Land response rows as JSON lines, one folder `code=...` per request.

    Rows are brought together by request first, large requests split by size, so that the files are few.
    """
    df = df.hint("rebalance", "code")
    df.write.mode("errorifexists").partitionBy("code").json(path)


def read_responses(
    spark: SparkSession, path: str, schema: StructType, manifest: DataFrame | None = None
) -> DataFrame:
    """Landed responses as rows with `code`, for the requests of the manifest (all if None).

    Spark splits large responses over tasks, and prunes the folders of requests not in the manifest.
    """
    with_code = StructType([*schema.fields, StructField("code", StringType())])
    rows = spark.read.schema(with_code).option("mode", "FAILFAST").json(path)
    if manifest is None:
        return rows
    return rows.join(manifest.select(F.col("code")), "code", "left_semi")
