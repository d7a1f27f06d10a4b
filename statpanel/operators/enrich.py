"""Dictionary preparation and enrichment of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.functions import (
    clean_topic,
    dataset_of,
    description_text,
    endpoint_of,
    request_tag,
    table_of,
    table_tag,
    unmark_name,
)
from statpanel.schema import DATASET_OF_TABLE, EXCLUDED_LINE_CODES, NATIONAL_NAME, TOPIC_RULES


def prepare_dictionary(raw: DataFrame) -> DataFrame:
    """`(Key, Desc)` with `[TABLE] text` descriptions -> `(Key, Desc, table)` with plain ones."""
    return raw.select(
        "Key",
        description_text(F.col("Desc")).alias("Desc"),
        table_tag(F.col("Desc")).alias("table"),
    )


def request_manifest(
    dictionary: DataFrame,
    tables: list[str] | None = None,
    exclude: dict[str, str] = EXCLUDED_LINE_CODES,
) -> DataFrame:
    """Distinct requests `(table, line_code, code)` of the wanted tables (all if None).

    `exclude` maps a table to a pattern; line codes of that table that contain it are left out.
    """
    keys = dictionary.select("table", F.col("Key").alias("line_code")).dropna()
    if tables is not None:
        keys = keys.filter(F.col("table").isin(tables))
    for table, pattern in exclude.items():
        keys = keys.filter(~((F.col("table") == table) & F.col("line_code").rlike(pattern)))
    return keys.distinct().withColumn("code", request_tag(F.col("table"), F.col("line_code")))


def split_codes(df: DataFrame) -> DataFrame:
    """Distinct codes with their table and endpoint."""
    return df.select("code").distinct().select(
        "code", table_of(F.col("code")).alias("table"), endpoint_of(F.col("code")).alias("endpoint")
    )


def topics_of(
    dictionary: DataFrame,
    datasets: dict[str, str] = DATASET_OF_TABLE,
    rules: dict[str, list[str]] = TOPIC_RULES,
) -> DataFrame:
    """Distinct `(table, endpoint, topic)`; the dataset of the table picks the rules."""
    renamed = dictionary.withColumnsRenamed({"Key": "endpoint", "Desc": "desc"})
    topic = clean_topic(F.col("desc"), dataset_of(F.col("table"), datasets), rules)
    return renamed.distinct().select("table", "endpoint", topic.alias("topic")).distinct()


def enrich(
    facts: DataFrame,
    dictionary: DataFrame,
    datasets: dict[str, str] = DATASET_OF_TABLE,
    *,
    rules: dict[str, list[str]] = TOPIC_RULES,
    national: str = NATIONAL_NAME,
    topics: DataFrame | None = None,
) -> DataFrame:
    """Landed observations with lower-case columns, clean names, and table, endpoint and topic.

    The code is split on the row itself, so the observations are read once and never reduced to
    their distinct codes. Patterns run on the dictionary, not on the observations. Rows whose code has
    no description are dropped; `unmatched_codes` counts them.

    `topics`, if given, is used in place of the dictionary's `topics_of`. Put through `sized` once it serves any number of
    calls, and Spark broadcasts it if its bytes allow; else both sides are shuffled.
    """
    if topics is None:
        topics = topics_of(dictionary, datasets, rules)
    rows = facts.toDF(*[c.lower() for c in facts.columns])
    rows = rows.withColumns(
        {
            "geoname": unmark_name(F.col("geoname"), national),
            "table": table_of(F.col("code")),
            "endpoint": endpoint_of(F.col("code")),
        }
    )
    return rows.join(topics, ["table", "endpoint"]).select(*rows.columns, "topic")
