"""Requests as a data source, and the memo of frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from statpanel import sources as src

SCHEMA = StructType([StructField("datavalue", LongType()), StructField("noteref", StringType())])
REQUESTS = [(t, str(n), f"{t}-{n}") for t in ("A", "B") for n in range(4)]


def opened(spark, folder, requests=REQUESTS, **options):
    """A source whose fetcher leaves a file per request that it was asked for."""
    import os

    os.makedirs(f"{folder}/asked", exist_ok=True)

    def fetch(table, line_code):
        import pyarrow as pa

        open(f"{folder}/asked/{table}-{line_code}", "w").close()
        values = [int(line_code) * 10 + i for i in range(3)]
        yield pa.RecordBatch.from_pydict({"noteref": [None, "x", ""], "datavalue": values})
        yield pa.RecordBatch.from_pydict({"noteref": pa.array([], pa.string()), "datavalue": pa.array([], pa.int64())})

    manifest = spark.createDataFrame(requests, "table string, line_code string, code string")
    return src.open_requests(manifest, fetch, SCHEMA, **options)


def asked(folder):
    import os

    return sorted(os.listdir(f"{folder}/asked"))


def test_every_request_is_fetched_and_named(spark, folder):
    df = opened(spark, folder, [*REQUESTS, REQUESTS[0], (None, "1", "x"), ("A", None, "y")])
    assert df.columns == ["datavalue", "noteref", "table", "line_code", "code"]
    want = [(int(n) * 10 + i, note, t, n, code) for t, n, code in REQUESTS for i, note in enumerate([None, "x", ""])]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert asked(folder) == sorted(code for _, _, code in REQUESTS)
    assert df.rdd.getNumPartitions() == len(REQUESTS)


@pytest.mark.parametrize(
    "condition, wanted",
    [
        ("table = 'A'", ["A-0", "A-1", "A-2", "A-3"]),
        ("table = 'B' and line_code in ('1', '3', '9')", ["B-1", "B-3"]),
        ("code = 'A-2'", ["A-2"]),
        ("table = 'C'", []),
        ("table = 'A' and datavalue = 11", ["A-0", "A-1", "A-2", "A-3"]),
        ("table > 'A' and line_code = '0'", ["A-0", "B-0"]),
    ],
)
def test_a_filter_plans_only_its_requests(spark, folder, condition, wanted):
    df = opened(spark, folder).filter(condition)
    rows = df.collect()
    assert asked(folder) == wanted
    every = spark.createDataFrame(
        [(int(n) * 10 + i, t, n, code) for t, n, code in REQUESTS for i in range(3)], "datavalue long, table string, line_code string, code string"
    )
    assert len(rows) == every.filter(condition).count()


def test_empty_and_too_large_manifests(spark, folder):
    assert opened(spark, folder, []).count() == 0
    with pytest.raises(ValueError, match="more than 3 requests"):
        opened(spark, folder, most=3)


def panel(spark, n=100):
    return spark.range(n).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))


def test_frames_built_apart_are_kept_once(spark):
    with src.Memo() as memo:
        one, two = memo(panel(spark)), memo(panel(spark))
        assert one is two and len(memo) == 1 and one.is_cached
        other = memo(panel(spark, 50))
        assert other is not one and len(memo) == 2
        renamed = memo(panel(spark).withColumnRenamed("v", "w"))
        assert renamed.columns == ["k", "w"]
        assert one.count() == 100 and other.count() == 50
    assert len(memo) == 0 and not one.is_cached and not other.is_cached


def test_a_memo_is_bounded_and_releases(spark):
    memo = src.Memo(most=2)
    frames = [memo(panel(spark, n)) for n in (10, 20)]
    memo(panel(spark, 10))  # used again, so 20 is the one unused for longest
    memo(panel(spark, 30))
    assert len(memo) == 2 and frames[0].is_cached and not frames[1].is_cached
    memo.release(panel(spark, 10))
    assert len(memo) == 1 and not frames[0].is_cached
    memo.release()
    assert len(memo) == 0


def test_a_panel_that_two_callers_build_is_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def slow(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    def build():
        return spark.range(100).mapInArrow(slow, "id long")

    with src.Memo() as memo:
        kept = memo(build())
        assert kept.count() == 100 and memo(kept.select("id")).count() == 100
    assert runs.value == 100
