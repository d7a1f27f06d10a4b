"""The four analytic views, as compositions of the operators.

Every view filters its periods before it looks at the period before, so the first kept period has no change;
such rows are ranked too, below all others. No view drops the national row unless it says so.
Rows come unsorted: sort with `in_order(view, *ORDER[name])` where they are shown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statpanel.functions import at_least_year, categorise
from statpanel.operators import align_topics, change, rank_within, union_distinct, with_top
from statpanel.schema import NATIONAL_NAME
from statpanel.sources import create_missing_views, create_or_replace_views

# ---- Fixed values -------------------------------------------------------------------------------
EXPENDITURE_TOPICS = [
    "Per capita personal consumption expenditures: Durable goods",
    "Per capita personal consumption expenditures: Housing and utilities",
    "Per capita personal consumption expenditures: Nondurable goods",
    "Per capita personal consumption expenditures: Services",
]
# Patterns in order: the first that matches gives the category.
EXPENDITURE_CATEGORIES = [
    ("%Nondurable%", "nondurable goods"),
    ("%Durable%", "durable goods"),
    ("%Services%", "services"),
    ("%Housing%", "housing"),
]
DISPOSABLE_INCOME_TOPIC = "Per capita disposable personal income"
PERSONAL_INCOME_TOPIC = "Per capita personal income"
INCOME_CATEGORIES = [
    ("%disposable%", "disposable income"),
    ("%personal%", "personal income"),
]
EMPLOYMENT_TOPIC = "Total employment"
POPULATION_TOPIC = "Population"
AGGREGATE_INDUSTRIES = [
    "All industry total",
    "Private industries",
    "Private services-providing industries",
]
FIRST_YEAR = 2000
ORDER = {
    "consumer_expenditures": ["year", "consumer_expenditure", "state"],
    "employment_population": ["state", "year"],
    "income": ["year", "income_type", "state"],
    "industry_compensation": ["state", "year"],
}
# -------------------------------------------------------------------------------------------------


def consumer_expenditures(
    panel: DataFrame,
    *,
    topics: list[str] = EXPENDITURE_TOPICS,
    categories: list[tuple[str, str]] = EXPENDITURE_CATEGORIES,
    since: int = FIRST_YEAR,
    chunk: Column | None = None,
) -> DataFrame:
    """Spend per state, year and category, its change, and the rank of the change.

    `chunk` (over `year`) splits long series, see `change`.
    """
    rows = panel.filter(F.col("topic").isin(topics) & (F.col("timeperiod") >= str(since))).select(
        F.col("geoname").alias("state"),
        F.col("timeperiod").alias("year"),
        F.col("datavalue").alias("spend"),
        "topic",
    )
    changed = change(
        rows,
        ["state", "topic"],
        "year",
        "spend",
        prev_name="prev_year_spend",
        change_name="spend_change",
        chunk=chunk,
    ).withColumn("consumer_expenditure", categorise(F.col("topic"), categories))
    ranked = rank_within(changed, ["year", "consumer_expenditure"], "spend_change", "change_rank", digits=2)
    return ranked.select(
        "state",
        "year",
        "spend",
        "prev_year_spend",
        "spend_change",
        "change_rank",
        "consumer_expenditure",
    )


def income(
    disposable: DataFrame,
    personal: DataFrame,
    *,
    disposable_topic: str = DISPOSABLE_INCOME_TOPIC,
    personal_topic: str = PERSONAL_INCOME_TOPIC,
    categories: list[tuple[str, str]] = INCOME_CATEGORIES,
    since: int = FIRST_YEAR,
    chunk: Column | None = None,
) -> DataFrame:
    """Disposable and personal income per state and year, the change, and the rank of the change.

    `chunk` (over `year`) splits long series, see `change`.
    """

    def one(panel: DataFrame, topic: str) -> DataFrame:
        return panel.filter((F.col("topic") == topic) & at_least_year(F.col("timeperiod"), since)).select(
            F.col("geoname").alias("state"),
            F.col("timeperiod").alias("year"),
            F.col("datavalue").alias("income"),
            "topic",
        )

    rows = union_distinct(one(disposable, disposable_topic), one(personal, personal_topic))
    changed = change(
        rows,
        ["state", "topic"],
        "year",
        "income",
        prev_name="prev_year_income",
        change_name="income_change",
        chunk=chunk,
    ).withColumn("income_type", categorise(F.col("topic"), categories))
    ranked = rank_within(changed, ["year", "income_type"], "income_change", "change_rank", digits=2)
    return ranked.select(
        "state",
        "year",
        "income",
        "prev_year_income",
        "income_change",
        "change_rank",
        "income_type",
    )


def employment_population(
    panel: DataFrame,
    *,
    employment_topic: str = EMPLOYMENT_TOPIC,
    population_topic: str = POPULATION_TOPIC,
    since: int = FIRST_YEAR,
) -> DataFrame:
    """Employment beside population per state and year."""
    rows = panel.filter(at_least_year(F.col("timeperiod"), since))
    topics = {employment_topic: "employment", population_topic: "population"}
    return align_topics(rows, ["geoname", "timeperiod"], topics).select(
        F.col("geoname").alias("state"),
        F.col("timeperiod").alias("year"),
        "employment",
        "population",
        F.lit(employment_topic).alias("topic"),
    )


def industry_compensation(
    panel: DataFrame,
    *,
    national: str = NATIONAL_NAME,
    aggregates: list[str] = AGGREGATE_INDUSTRIES,
) -> DataFrame:
    """Compensation per state, year and industry beside the industry that pays most there.

    Leaves out the national row and aggregate industries, before the top is found. Tied top industries give
    a row each.
    """
    rows = panel.filter((F.col("geoname") != national) & ~F.col("topic").isin(aggregates)).select(
        F.col("geoname").alias("state"),
        F.col("timeperiod").alias("year"),
        F.col("datavalue").alias("compensation"),
        F.col("topic").alias("industry"),
    )
    return with_top(rows, ["state", "year"], "compensation", "industry", "top_industry")


def view_builders(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """The views over the session tables that carry the dataset names.

    Personal income is read from the table `employment`, and employment and population from
    `wages_salary`: those tables hold these topics.
    """
    return {
        "consumer_expenditures": lambda: consumer_expenditures(spark.table("consumption_expenditures")),
        "employment_population": lambda: employment_population(spark.table("wages_salary")),
        "income": lambda: income(spark.table("disposable_income"), spark.table("employment")),
        "industry_compensation": lambda: industry_compensation(spark.table("compensation")),
    }


def create_views(spark: SparkSession, *, replace: bool = True) -> list[str]:
    """Create the four views in the session, all or only the missing ones; returns those created."""
    builders = view_builders(spark)
    if not replace:
        return create_missing_views(spark, builders)
    create_or_replace_views({name: build() for name, build in builders.items()})
    return sorted(builders)
