from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statpanel.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, score double"


def brute(rows, asked, k=5, kind=np.float32):
    def ok(v):
        return v and all(x is not None and np.isfinite(kind(x)) for x in v) and any(x != 0 for x in v)

    rows = [(i, np.array(v, kind)) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, a in [r for r in rows if r[0] in asked]:
        near = [(-neighbours.cosine(a[None], b[None])[0], i) for i, b in rows if i != q and len(b) == len(a)]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def frame(spark, rows, kind=np.float32):
    schema = SCHEMA if kind is np.float32 else SCHEMA.replace("array<float>", "array<double>")
    return spark.createDataFrame([(i, v, 0, 7, 0.5) for i, v in rows], schema).repartition(3)


def check(spark, rows, asked, kind=np.float32, **sizes):
    vectors = frame(spark, rows, kind)
    got = neighbours.nearest(vectors, vectors.filter(F.col("vec_id").isin(list(asked))), **sizes)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, asked, kind=kind)


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 70, "tile_queries": 9}, {"tile_rows": 70, "tile_queries": 9, "merge_rows": 40}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(400)]
    rows += [(500 + i, rows[i % 3][1]) for i in range(60)]  # ties
    check(spark, rows, set(range(0, 560, 20)), **sizes)


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, []), (7, [1.0, 2.0, 3.0]), (8, [1e38, 3e38]), (9, [1e-40, 0.0]), (10, [2.0, 0.0]), (None, [1.0, 0.0]), (0, [0.5, 0.5]),
    ]
    check(spark, rows, {0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10})


def test_doubles_stay_doubles(spark):
    """Components beyond the range of floats take part, and neighbours that differ only beyond the digits of floats are told apart."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=8)
    rows = [(i, [float(x) for x in base + 1e-9 * rng.normal(size=8)]) for i in range(120)]
    rows += [(200, [1.0, 1e39] + [0.0] * 6), (201, [1.0, 1e300] + [0.0] * 6), (202, [1e-300] * 8), (203, [float("inf")] + [1.0] * 7)]
    check(spark, rows, {0, 20, 40, 200, 201, 202, 203}, kind=np.float64, tile_rows=50, merge_rows=10)


def test_empty(spark):
    check(spark, [], {0})


def test_query_on_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op10_nearest"](spark, folder)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, {i for i, _ in rows if i % 50 == 0})
