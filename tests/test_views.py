"""The four views on hand-written tables with the real topics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from statpanel.operators import in_order
from statpanel.plans import views
from statpanel.schema import enriched

SPEND = "Per capita personal consumption expenditures: "


def table(spark, rows, value=None):
    data = [("T-1", "0", name, year, "u", 0, v, None, "T", "1", topic) for name, year, topic, v in rows]
    return spark.createDataFrame(data, enriched(value))


def shown(df, name):
    return [tuple(r) for r in in_order(df, *views.ORDER[name]).collect()]


@pytest.fixture
def consumption(spark):
    return table(
        spark,
        [
            ("Ohio", "1999", SPEND + "Services", 1),
            ("Ohio", "2000", SPEND + "Services", 100),
            ("Ohio", "2001", SPEND + "Services", 125),
            ("Ohio", "2003", SPEND + "Services", 100),
            ("Utah", "2000", SPEND + "Services", 50),
            ("Utah", "2001", SPEND + "Services", 50),
            ("United States", "2000", SPEND + "Services", 200),
            ("United States", "2001", SPEND + "Services", 250),
            ("Ohio", "2001", SPEND + "Nondurable goods", 7),
            ("Ohio", "2001", SPEND + "Durable goods", 8),
            ("Ohio", "2001", SPEND + "Gasoline", 9),
        ],
    )


def test_consumer_expenditures(consumption):
    assert shown(views.consumer_expenditures(consumption), "consumer_expenditures") == [
        ("Ohio", "2000", 100, None, None, 1, "services"),
        ("United States", "2000", 200, None, None, 1, "services"),
        ("Utah", "2000", 50, None, None, 1, "services"),
        ("Ohio", "2001", 8, None, None, 1, "durable goods"),
        ("Ohio", "2001", 7, None, None, 1, "nondurable goods"),
        ("Ohio", "2001", 125, 100, 20.0, 1, "services"),
        ("United States", "2001", 250, 200, 20.0, 1, "services"),
        ("Utah", "2001", 50, 50, 0.0, 2, "services"),
        ("Ohio", "2003", 100, 125, -25.0, 1, "services"),
    ]


def test_views_with_chunked_series(consumption, income_tables):
    decade = F.substring("year", 1, 3)
    plain = shown(views.consumer_expenditures(consumption), "consumer_expenditures")
    assert shown(views.consumer_expenditures(consumption, chunk=decade), "consumer_expenditures") == plain
    year = F.col("year")
    assert shown(views.income(*income_tables, chunk=year), "income") == shown(views.income(*income_tables), "income")


@pytest.fixture
def income_tables(spark):
    disposable = [
        ("Ohio", "1999", views.DISPOSABLE_INCOME_TOPIC, 1.0),
        ("Ohio", "2000", views.DISPOSABLE_INCOME_TOPIC, 10.0),
        ("Ohio", "2000", views.DISPOSABLE_INCOME_TOPIC, 10.0),
        ("Ohio", "2001", views.DISPOSABLE_INCOME_TOPIC, 12.5),
        ("Ohio", "(NA)", views.DISPOSABLE_INCOME_TOPIC, 12.5),
    ]
    personal = [
        ("Ohio", "2000", views.PERSONAL_INCOME_TOPIC, 20),
        ("Ohio", "2001", views.PERSONAL_INCOME_TOPIC, 16),
        ("Ohio", "2001", "Population", 16),
    ]
    return table(spark, disposable, DoubleType()), table(spark, personal)


def test_income(income_tables):
    assert shown(views.income(*income_tables), "income") == [
        ("Ohio", "2000", 10.0, None, None, 1, "disposable income"),
        ("Ohio", "2000", 20.0, None, None, 1, "personal income"),
        ("Ohio", "2001", 12.5, 10.0, 20.0, 1, "disposable income"),
        ("Ohio", "2001", 16.0, 20.0, -25.0, 1, "personal income"),
    ]


@pytest.fixture
def wages(spark):
    return table(
        spark,
        [
            ("Ohio", "1999", "Total employment", 1),
            ("Ohio", "1999", "Population", 2),
            ("Ohio", "2000", "Total employment", 3),
            ("Ohio", "2000", "Population", 4),
            ("Ohio", "2001", "Population", 5),
            ("United States", "2000", "Total employment", 6),
            ("United States", "2000", "Population", 7),
        ],
    )


def test_employment_population(wages):
    assert shown(views.employment_population(wages), "employment_population") == [
        ("Ohio", "2000", 3, 4, "Total employment"),
        ("United States", "2000", 6, 7, "Total employment"),
    ]


@pytest.fixture
def compensation(spark):
    return table(
        spark,
        [
            ("Ohio", "1998", "All industry total", 99),
            ("Ohio", "1998", "Private industries", 98),
            ("Ohio", "1998", "Mining", 5),
            ("Ohio", "1998", "Farming", 4),
            ("Ohio", "1998", None, 50),
            ("United States", "1998", "Mining", 70),
            ("Utah", "1998", "Mining", 6),
            ("Utah", "1998", "Farming", 6),
        ],
    )


INDUSTRY = [
    ("Ohio", "1998", 4, "Farming", "Mining"),
    ("Ohio", "1998", 5, "Mining", "Mining"),
    ("Utah", "1998", 6, "Farming", "Farming"),
    ("Utah", "1998", 6, "Farming", "Mining"),
    ("Utah", "1998", 6, "Mining", "Farming"),
    ("Utah", "1998", 6, "Mining", "Mining"),
]


def test_industry_compensation(compensation):
    assert sorted(shown(views.industry_compensation(compensation), "industry_compensation")) == INDUSTRY


def test_views_in_the_session(spark, no_views_left, consumption, income_tables, wages, compensation):
    consumption.createOrReplaceTempView("consumption_expenditures")
    income_tables[0].createOrReplaceTempView("disposable_income")
    income_tables[1].createOrReplaceTempView("employment")
    wages.createOrReplaceTempView("wages_salary")
    compensation.createOrReplaceTempView("compensation")
    names = ["consumer_expenditures", "employment_population", "income", "industry_compensation"]
    assert views.create_views(spark, replace=False) == names
    assert views.create_views(spark, replace=False) == []
    assert views.create_views(spark) == names
    counts = [spark.sql(f"select count(*) from {name}").first()[0] for name in names]
    assert counts == [9, 2, 4, 6]
    best = spark.sql("select state from consumer_expenditures where change_rank = 1 and year = '2001' order by 1")
    assert [r.state for r in best.collect()] == ["Ohio", "Ohio", "Ohio", "United States"]
