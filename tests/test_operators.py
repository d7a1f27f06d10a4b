from __future__ import annotations

import random
import sys
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from statpanel import operators as op
from statpanel.operators import align
from statpanel.schema import UNROUTED, landed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


# ---- change -------------------------------------------------------------------------------------

SERIES = "e string, y string, v bigint"


def test_change_uses_the_row_before_across_gaps(spark):
    df = spark.createDataFrame(
        [("a", "2000", 10), ("a", "2003", 20), ("a", "2004", 0), ("a", "2005", 5), ("b", "2004", 7)], SERIES
    )
    assert rows(op.change(df, ["e"], "y", "v")) == [
        ("a", "2000", 10, None, None),
        ("a", "2003", 20, 10, 50.0),
        ("a", "2004", 0, 20, None),
        ("a", "2005", 5, 0, 100.0),
        ("b", "2004", 7, None, None),
    ]


def test_change_nulls(spark):
    df = spark.createDataFrame([("a", "2000", None), ("a", "2001", 4), ("a", None, 8), (None, "2000", 1)], SERIES)
    assert rows(op.change(df, ["e"], "y", "v")) == [
        ("a", "2000", None, None, None),
        ("a", "2001", 4, None, None),
        ("a", None, 8, 4, 50.0),
        (None, "2000", 1, None, None),
    ]


def test_filtering_first_leaves_no_predecessor(spark):
    df = spark.createDataFrame([("a", "1999", 10), ("a", "2000", 20)], SERIES).filter("y >= '2000'")
    assert rows(op.change(df, ["e"], "y", "v")) == [("a", "2000", 20, None, None)]


def test_chunked_change_equals_plain(spark):
    rng = random.Random(1)
    data = [
        (
            rng.choice(["a", "b", None]),
            rng.choice([None, *[str(y) for y in range(1985, 2021)]]),
            rng.choice([None, *range(-3, 9)]),
        )
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, SERIES)
    plain = op.change(df, ["e"], "y", "v")
    chunks = [
        F.substring("y", 1, 3),
        F.col("y"),
        F.lit(1),
        F.struct(F.col("y").isNull(), "y", F.col("v").isNull(), "v"),
    ]
    for chunk in chunks:
        assert rows(op.change(df, ["e"], "y", "v", chunk=chunk)) == rows(plain)


# ---- rank and top -------------------------------------------------------------------------------


def dense_ranks(values):
    """Brute force: distinct values in descending order, nulls last."""
    distinct = sorted({v for v in values if v is not None}, reverse=True)
    place = {v: i + 1 for i, v in enumerate(distinct)}
    return {**place, None: len(distinct) + 1}


@pytest.mark.parametrize("kind", ["bigint", "int", "double", "decimal(20,4)"])
def test_rank_within_equals_brute_force(spark, kind):
    rng = random.Random(3)

    def value():
        pick = rng.random()
        if pick < 0.2:
            return None
        if pick < 0.3:
            return 0
        if pick < 0.8 or kind == "int":
            return rng.randrange(-1000, 1000)
        return rng.choice([-1, 1]) * rng.randrange(1, 2 ** rng.randrange(1, 50))

    data = [(rng.choice(["x", "y", None]), rng.choice([1, None]), value(), i) for i in range(1500)]
    df = spark.createDataFrame(data, "g string, h int, v bigint, id int").withColumn("v", F.col("v").cast(kind))
    if kind == "double":
        df = df.withColumn("v", F.col("v") / 128)
    got = op.rank_within(df, ["g", "h"], "v", "r").collect()
    assert len(got) == len(data)
    key = lambda r: (str(r.g), str(r.h))
    for _, members in groupby(sorted(got, key=key), key=key):
        members = list(members)
        want = dense_ranks([m.v for m in members])
        assert [m.r for m in members] == [want[m.v] for m in members]


def test_rank_within_extreme_values(spark):
    longs = [2**63 - 1, -(2**63), 0, None, 2**42, 2**42 - 1, 2**21, -(2**21)]
    df = spark.createDataFrame([(v,) for v in longs], "v bigint").withColumn("g", F.lit(1))
    got = {r.v: r.r for r in op.rank_within(df, ["g"], "v", "r").collect()}
    assert got == dense_ranks(longs)
    doubles = [1e300, -1e300, 1e18, 0.001, 0.002, -0.0, None, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in doubles], "v double").withColumn("g", F.lit(1))
    got = {r.v: r.r for r in op.rank_within(df, ["g"], "v", "r").collect()}
    assert got == dense_ranks(doubles)
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double").withColumn("g", F.lit(1))
    got = {str(r.v): r.r for r in op.rank_within(df, ["g"], "v", "r").collect()}
    assert got == {"nan": 1, "1.0": 2, "None": 3}


def test_rank_within_ties_and_all_null_groups(spark):
    data = [("a", 5.0), ("a", 5.0), ("a", 1.0), ("a", None), ("b", None), ("b", None)]
    df = spark.createDataFrame(data, "g string, v double")
    assert rows(op.rank_within(df, ["g"], "v", "r")) == [
        ("a", 1.0, 2),
        ("a", 5.0, 1),
        ("a", 5.0, 1),
        ("a", None, 3),
        ("b", None, 1),
        ("b", None, 1),
    ]


def test_rank_within_needs_a_number(spark):
    with pytest.raises(TypeError):
        op.rank_within(spark.createDataFrame([("a", "b")], "g string, v string"), ["g"], "v", "r")


def test_top_per_group(spark):
    data = [("a", 3, 1), ("a", 3, 2), ("a", 2, 3), ("a", None, 4), ("b", None, 5), (None, 1, 6), ("a", 1, 7)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(op.top_per_group(df, ["g"], "v")) == [1, 2, 5, 6]
    assert ids(op.top_per_group(df, ["g"], "v", k=2)) == [1, 2, 3, 5, 6]
    assert ids(op.top_per_group(df, ["g"], "v", k=4)) == [1, 2, 3, 4, 5, 6, 7]


def test_with_top_keeps_ties(spark):
    data = [("a", 3, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "u"), ("b", None, "w"), (None, 9, "q")]
    df = spark.createDataFrame(data, "g string, v int, t string")
    assert rows(op.with_top(df, ["g"], "v", "t", "top")) == [
        ("a", 2, "z", "x"),
        ("a", 2, "z", "y"),
        ("a", 3, "x", "x"),
        ("a", 3, "x", "y"),
        ("a", 3, "y", "x"),
        ("a", 3, "y", "y"),
        ("b", None, "u", "u"),
        ("b", None, "u", "w"),
        ("b", None, "w", "u"),
        ("b", None, "w", "w"),
    ]


@pytest.mark.parametrize("ranges", [1, 7])
def test_ranges_give_the_same_as_the_whole_series(spark, ranges):
    rng = random.Random(ranges)
    hot = [("hot", f"{i:05d}" if i % 50 else None, rng.choice([None, i, -i])) for i in range(1500)]
    data = hot + hot[:20] + [(f"e{i % 40}", str(1990 + i // 40), rng.randint(0, 5)) for i in range(800)] + [(None, "2000", 1), (None, "2001", 2)]
    df = spark.createDataFrame(data, SERIES).repartition(5)
    want = op.change(df, ["e"], "y", "v")
    got = op.change(df, ["e"], "y", "v", ranges=ranges)
    assert got.columns == want.columns
    assert Counter(rows(got)) == Counter(rows(want))


# ---- align, sets, names -------------------------------------------------------------------------


def test_align_topics(spark):
    data = [("a", "2000", "J", 1), ("a", "2000", "P", 2), ("a", "2001", "J", 3), ("b", "2000", "P", None)]
    data += [("b", "2000", "J", 5), (None, "2000", "J", 1), (None, "2000", "P", 1), ("a", "2000", "Z", 9)]
    df = spark.createDataFrame(data, "geoname string, timeperiod string, topic string, datavalue bigint")
    want = [("a", "2000", 1, 2), ("b", "2000", 5, None)]
    for align in (op.align_topics, op.align_topics_pivot):
        assert rows(align(df, ["geoname", "timeperiod"], {"J": "jobs", "P": "people"})) == want


def test_align_topics_repeats_for_repeated_keys(spark):
    data = [("a", "J", 1), ("a", "J", 2), ("a", "P", 3)]
    df = spark.createDataFrame(data, "k string, topic string, datavalue bigint")
    assert rows(op.align_topics(df, ["k"], {"J": "j", "P": "p"})) == [("a", 1, 3), ("a", 2, 3)]


def test_align_topics_folds_and_unfolds_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(align, "STEP", 4)
    data = [("a", "J", 1)] * 11 + [("a", "J", 2)] + [("a", "P", None)] * 9 + [("b", "J", 1)] * 3 + [("c", "P", 1)]
    df = spark.createDataFrame(data, "k string, topic string, datavalue bigint")
    got = op.align_topics(df, ["k"], {"J": "j", "P": "p"}).collect()
    assert Counter(tuple(r) for r in got) == {("a", 1, None): 99, ("a", 2, None): 9}


@pytest.mark.parametrize("kind", ["double", "float", "decimal(20,4)"])
def test_align_topics_keeps_values_as_they_are(spark, kind):
    data = [("a", "J", v) for v in (0.0, -0.0, 0.0, 1.5, float("nan"), None)] + [("a", "P", 2.0)]
    df = spark.createDataFrame(data, "k string, topic string, v double").filter(F.lit(kind != "decimal(20,4)") | ~F.isnan("v"))
    got = op.align_topics(df.select("k", "topic", F.col("v").cast(kind).alias("datavalue")), ["k"], {"J": "j", "P": "p"})
    assert got.schema["j"].dataType.simpleString() == kind
    zeros = ["-0.0", "0.0", "0.0"] if kind != "decimal(20,4)" else ["0.0000"] * 3
    assert sorted(str(r["j"]) for r in got.collect() if r["j"] == 0) == zeros
    assert got.count() == (6 if kind != "decimal(20,4)" else 5)


def test_unions(spark):
    a = spark.createDataFrame([("x", 1, "n"), ("x", 1, "n"), (None, None, None)], "a string, b int, n string")
    b = spark.createDataFrame([("x", 1), (None, None)], "a string, b int")
    assert rows(op.union_distinct(a.select("a", "b"), b)) == [("x", 1), (None, None)]
    assert rows(op.union_by_name(a, b.select("b", "a"))) == [
        ("x", 1, "n"),
        ("x", 1, "n"),
        ("x", 1, None),
        (None, None, None),
        (None, None, None),
    ]


def test_symmetric_difference(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "n string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "n string")
    assert rows(op.symmetric_difference(a, b)) == [("x",), ("z",)]


def test_first_wins(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 3), ("y", 4), (None, 5)], "k string, v int")
    c = spark.createDataFrame([("y", 6), (None, 7)], "k string, v int")
    assert rows(op.first_wins([a, b, c], ["k"])) == [("x", 1), ("x", 2), ("y", 4), (None, 5)]
    assert rows(op.first_wins([a], ["k"])) == rows(a)
    assert rows(op.first_wins([a.limit(0), b, b, b.limit(0)], ["k"])) == rows(b)


def test_first_wins_with_null_parts_and_other_column_orders(spark):
    a = spark.createDataFrame([("x", None, 1), (None, None, 2)], "k string, l string, v int")
    b = spark.createDataFrame([(3, None, "x"), (4, "l", "x"), (5, None, None), (6, "", "x")], "v int, l string, k string")
    want = [("x", None, 1), (None, None, 2), ("x", "l", 4), ("x", "", 6)]
    assert Counter(rows(op.first_wins([a, b], ["k", "l"]))) == Counter(want)


def test_reference_names_and_keep_listed(spark):
    schema = "position int, name string"
    country = spark.createDataFrame([(2, "other"), (1, "The United States of America")], schema)
    states = spark.createDataFrame([(i, f"S{i}[B]" if i % 2 else f"S{i}") for i in range(60, 0, -1)], schema)
    district = spark.createDataFrame([(1, "DC"), (2, "Elsewhere")], schema)
    names = op.reference_names(country, states, district)
    listed = {r.geoname for r in names.collect()}
    assert listed == {"United States *", "DC", *(f"S{i}" for i in range(1, 51))}
    df = spark.createDataFrame([("S1",), ("S1",), ("S51",), ("United States",), (None,)], "geoname string")
    assert rows(op.keep_listed(df, names.unionByName(df.filter("geoname is null")), "geoname")) == [
        ("S1",),
        ("S1",),
    ]


def test_in_order_puts_nulls_last(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", None), ("a", 3)], "x string, y int")
    assert [tuple(r) for r in op.in_order(df, "x", "y").collect()] == [("a", 3), ("a", None), ("b", 2), (None, 1)]


# ---- dictionary, enrichment, landing, checks ----------------------------------------------------

DICTIONARY = [
    ("1", "[SAGDP4N] Compensation of employees: All industry total"),
    ("1", "[SAGDP4N] Compensation of employees: All industry total"),
    ("3(a)", "[SAGDP4N] Compensation of employees: Odd (21)"),
    ("11", "[SAGDP4N] Compensation of employees: Mining (21)"),
    ("1(a)", "[SAPCE2] Per capita personal consumption expenditures: Services"),
    ("5", "no tag"),
]


def dictionary(spark):
    return op.prepare_dictionary(spark.createDataFrame(DICTIONARY, "Key string, Desc string"))


def test_request_manifest_excludes_bracket_keys_of_one_table(spark):
    manifest = op.request_manifest(dictionary(spark), ["SAGDP4N", "SAPCE2"])
    assert rows(manifest) == [
        ("SAGDP4N", "1", "SAGDP4N-1"),
        ("SAGDP4N", "11", "SAGDP4N-11"),
        ("SAPCE2", "1(a)", "SAPCE2-1(a)"),
    ]
    assert op.request_manifest(dictionary(spark)).count() == 3


def facts(spark):
    names = ["Code", "GeoFips", "GeoName", "TimePeriod", "CL_UNIT", "UNIT_MULT", "DataValue", "NoteRef"]
    data = [
        ("SAGDP4N-1", "00000", "United States *", "2000", "u", 3, 10, None),
        ("SAGDP4N-11", "01000", "Ohio", "2000", "u", 3, 20, "x"),
        ("SAPCE2-1(a)", "01000", "Ohio", "2000", "u", 0, 30, None),
        ("SAGDP4N-99", "01000", "Ohio", "2000", "u", 0, 40, None),
        (None, "01000", "Ohio", "2000", "u", 0, 50, None),
    ]
    return spark.createDataFrame(data, landed()).toDF(*names)


def test_enrich(spark):
    got = op.enrich(facts(spark), dictionary(spark))
    assert got.columns == [*landed().fieldNames(), "table", "endpoint", "topic"]
    assert rows(got.select("code", "geoname", "datavalue", "table", "endpoint", "topic")) == [
        ("SAGDP4N-1", "United States", 10, "SAGDP4N", "1", "All industry total"),
        ("SAGDP4N-11", "Ohio", 20, "SAGDP4N", "11", "Mining"),
        ("SAPCE2-1(a)", "Ohio", 30, "SAPCE2", "1(a)", "Per capita personal consumption expenditures: Services"),
    ]


def test_enrich_is_the_same_without_broadcast(spark):
    want = rows(op.enrich(facts(spark), dictionary(spark)))
    topics = op.sized(op.topics_of(dictionary(spark)))
    assert rows(op.enrich(facts(spark), dictionary(spark), topics=topics)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(op.enrich(facts(spark), dictionary(spark))) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_codes(spark):
    df = spark.createDataFrame([("SA-1",), ("SA-1",), ("SA-1-2",)], "code string")
    assert rows(op.split_codes(df)) == [("SA-1", "SA", "1"), ("SA-1-2", "SA", "1")]


@pytest.mark.parametrize("rebalance", [False, True])
def test_land_routes_by_table(spark, folder, rebalance):
    lower = facts(spark).toDF(*landed().fieldNames())
    other = spark.createDataFrame([("CAINC4-7", "Ohio"), ("XX-1", "Ohio"), ("CAINC4-7", "Mars")], "code string, geoname string")
    names = spark.createDataFrame([("Ohio",), ("United States *",)], "geoname string")
    counts = op.land([lower, other], names, f"{folder}/landed", rebalance=rebalance)
    assert rows(counts) == [
        (UNROUTED, 2),
        ("compensation", 3),
        ("consumption_expenditures", 1),
        ("employment", 1),
    ]
    back = spark.read.parquet(f"{folder}/landed").filter("dataset = 'compensation'")
    assert back.count() == 3


def checked(df):
    return sorted((r.dataset, r.check, r.observed, r.passed) for r in df.collect())


def test_key_checks_count_each_null_column(spark):
    full = ("c", "f", "g", "2000", "t", "e", "p")
    data = [("d1", *full), ("d1", *full[:3], "(NA)", *full[4:])]
    data += [("d2", *full[:i], None, *full[i + 1 :]) for i in range(7)]
    columns = "dataset code geofips geoname timeperiod table endpoint topic".split()
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))
    assert checked(op.check_keys(df)) == [
        ("d1", "non_numeric_periods", 1, False),
        ("d1", "null_records", 0, True),
        ("d2", "non_numeric_periods", 0, True),
        ("d2", "null_records", 7, False),
    ]


def test_coverage_uniqueness_sentinels(spark):
    data = [("d", "SAPCE2-1", str(i), f"n{i // 2}", "2000", "t") for i in range(6)]
    columns = "dataset code geofips geoname timeperiod topic".split()
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    assert checked(op.check_coverage(df, 4)) == [("d", "geofips_count", 6, True), ("d", "geoname_count", 3, False)]
    assert checked(op.check_unique(df)) == [("d", "repeated_keys", 3, False)]
    assert checked(op.check_sentinels(df)) == [("d", "sentinel_records", 6, True)]
    assert checked(op.check_sentinels(df, ["X-1"])) == [("d", "sentinel_records", 0, False)]


def test_unmatched_codes(spark):
    df = facts(spark).withColumn("dataset", F.lit("d")).withColumnRenamed("Code", "code")
    matched = df.filter("code = 'SAGDP4N-1'").withColumn("dataset", F.lit("e"))
    got = op.unmatched_codes(df.unionByName(matched), dictionary(spark))
    assert checked(got) == [("d", "unmatched_codes", 2, False), ("e", "unmatched_codes", 0, True)]
