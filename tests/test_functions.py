from __future__ import annotations

import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statpanel import functions as fn
from statpanel.plans.views import EXPENDITURE_CATEGORIES, INCOME_CATEGORIES


def texts(spark, values, column):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "n int, x string")
    return [r.y for r in df.select("n", column(F.col("x")).alias("y")).orderBy("n").collect()]


def test_round_half_away_equals_sql_round(spark):
    rng = random.Random(5)
    values = [0.285, 1.005, 2.675, -0.125, 12.345, 0.0, -0.0, 1e17 + 3, -2.5e300, math.inf, -math.inf]
    values += [0.0049999999999999994, 4503599627370497.5]
    values += [rng.uniform(-1000, 1000) for _ in range(20000)]
    values += [rng.randrange(-(10**6), 10**6) / 1000 for _ in range(20000)]
    table = pa.table({"n": range(len(values)), "x": values})
    con = duckdb.connect()
    con.register("given", table)
    want = [r[0] for r in con.sql("select round(x, 2) from given order by n").fetchall()]
    df = spark.createDataFrame(table).select("n", fn.round_half_away(F.col("x")).alias("y"))
    got = [r.y for r in df.orderBy("n").collect()]
    assert [repr(v) for v in got] == [repr(v) for v in want]
    assert got[:2] == [0.28, 1.0]


def test_pct_change(spark):
    rows = [(1, 50, 40), (2, 0, 40), (3, None, 40), (4, 40, None), (5, 40, 50), (6, -10, 10)]
    df = spark.createDataFrame(rows, "n int, v bigint, p bigint")
    current = fn.pct_change(F.col("v"), F.col("p")).alias("c")
    previous = fn.pct_change(F.col("v"), F.col("p"), base="previous").alias("p")
    got = [tuple(r) for r in df.select("n", current, previous).orderBy("n").collect()]
    assert got == [
        (1, 20.0, 25.0),
        (2, None, -100.0),
        (3, None, None),
        (4, None, None),
        (5, -25.0, -20.0),
        (6, 200.0, -200.0),
    ]
    with pytest.raises(ValueError):
        fn.pct_change(F.col("v"), F.col("p"), base="first")


def test_pct_change_of_double_zero_is_null(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "v double, p double")
    assert df.select(fn.pct_change(F.col("v"), F.col("p"))).first()[0] is None


def test_year_bounds(spark):
    got = texts(spark, ["1999", "2000", "(NA)", None], lambda x: fn.at_least_year(x, 2000))
    assert got == [False, True, None, None]


def test_categories_first_match_wins_and_case_matters(spark):
    topics = ["Nondurable goods", "Durable goods", "Services", "Housing", "durable", "Other", None]
    got = texts(spark, topics, lambda x: fn.categorise(x, EXPENDITURE_CATEGORIES))
    assert got == ["nondurable goods", "durable goods", "services", "housing", None, None, None]
    got = texts(
        spark,
        ["Per capita disposable personal income", "Per capita personal income"],
        lambda x: fn.categorise(x, INCOME_CATEGORIES),
    )
    assert got == ["disposable income", "personal income"]
    assert texts(spark, ["a"], lambda x: fn.categorise(x, [])) == [None]


def test_codes(spark):
    codes = ["SA-1", "SA-1-2", "SA", "-", None]
    assert texts(spark, codes, fn.table_of) == ["SA", "SA", "SA", None, None]
    assert texts(spark, codes, fn.endpoint_of) == ["1", "1", None, None, None]
    assert texts(spark, codes[:1], lambda x: fn.request_tag(x, F.lit("7"))) == ["SA-1-7"]


def test_descriptions(spark):
    descs = ["[AB] x", "[AB] x [CD] y", "zz", None]
    assert texts(spark, descs, fn.table_tag) == ["AB", "AB] x [CD", None, None]
    assert texts(spark, descs, fn.description_text) == ["x", "x [CD", None, None]


def test_names(spark):
    names = ["United States *", "United States", "Ohio *", None]
    assert texts(spark, names, fn.unmark_name) == ["United States", "United States", "Ohio *", None]
    assert texts(spark, ["Ohio[B]", "Utah"], fn.strip_annotation) == ["Ohio", "Utah"]


def test_topics_per_dataset(spark):
    descs = [
        "Compensation of employees: Mining (21)",
        "Compensation of employees: Utilities (3)",
        "Compensation of employees: A (21,22) b (xx)",
        "Compensation of employees: Trailing (21) ",
        None,
    ]
    got = texts(spark, descs, lambda x: fn.clean_topic(x, F.lit("compensation")))
    assert got == ["Mining", "Utilities (3)", "A", "Trailing (21) ", None]
    kept = "Per capita personal consumption expenditures: Services"
    assert texts(spark, [kept], lambda x: fn.clean_topic(x, F.lit("consumption_expenditures"))) == [kept]
    state = "Gross domestic product (GDP) by state: Mining (21)"
    assert texts(spark, [state], lambda x: fn.clean_topic(x, F.lit("gdp"))) == ["Mining"]
    assert texts(spark, ["Real GDP: Mining (21)"], lambda x: fn.clean_topic(x, F.lit("real_gdp"))) == ["Mining"]
    assert texts(spark, [state], lambda x: fn.clean_topic(x, F.lit(None).cast("string"))) == [state]


def test_dataset_lookup(spark):
    assert texts(spark, ["SAPCE2", "CAINC4", "??", None], fn.dataset_of) == [
        "consumption_expenditures",
        "employment",
        None,
        None,
    ]


def test_pct_change_of_large_whole_numbers(spark):
    df = spark.createDataFrame([(3 * 10**17, 10**17), (2**62, -(2**62)), (5, 4), (None, 1)], "v long, p long")
    got = [r[0] for r in df.select(fn.pct_change(F.col("v"), F.col("p"))).collect()]
    assert got == [66.66 if got[0] == 66.66 else 66.67, 200.0, 20.0, None]
