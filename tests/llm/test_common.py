from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from statpanel.llm import common


def classes(edges):
    group = {x: x for e in edges for x in e}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        group[high] = low
    return {x: root(x) for x in group}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(0, 60)] + [(70, 70)],
        "star": [(5, i) for i in range(6, 40)] + [(6, 5), (6, 5)],
        "none": [],
    }[shape]
    links = spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long")
    got = {r["id"]: r["component"] for r in common.components(links, "t").collect()}
    assert got == classes([e for e in edges if e[0] != e[1]])


def test_nothing_among_the_members_is_lost(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 - 5000).alias("k"), F.lit(1).alias("place"), F.lit("x").alias("bucket"))
    members = rows.filter("k % 40 = 0").select("k")
    kept = common.perhaps_among(rows, "k", members)
    assert kept.columns == rows.columns and kept.filter("place <> 1 or bucket <> 'x'").isEmpty()
    found = {r["k"] for r in kept.select("k").collect()}
    assert {r["k"] for r in members.collect()} <= found
    assert len(found) < 700
    assert common.perhaps_among(rows, "k", members.limit(0)).isEmpty()


def test_spent_and_working_tables_are_removed(spark):
    from pathlib import Path

    rows = spark.range(10)
    one = common.written(rows, "one")
    two = common.written(one.filter("id > 3"), "two", one, rows)
    assert not Path(one._written).exists() and two.count() == 6
    with common.working(spark) as outer:
        first = common.written(two, "first")
        with common.working(spark) as inner:
            kept, lost = inner(common.written(first, "kept")), common.written(first, "lost")
        assert kept.count() == 6 and not Path(lost._written).exists()
        with pytest.raises(ZeroDivisionError), common.working(spark):
            broken = common.written(first, "broken")
            1 / 0
        last = outer(common.written(kept, "last"))
    assert [Path(t._written).exists() for t in (first, kept, broken, last, two)] == [False, False, False, True, True]
    assert last.count() == 6
