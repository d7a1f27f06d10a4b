"""Text column expressions. Text that does not fit a pattern becomes null, it never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statpanel.schema import (
    DATASET_OF_TABLE,
    NAME_ANNOTATION,
    NATIONAL_MARK,
    NATIONAL_NAME,
    TOPIC_RULES,
)


def _none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def table_tag(desc: Column) -> Column:
    """Text between the first `[` and the last `]`."""
    return _none_if_empty(F.regexp_extract(desc, r"(?<=\[).+(?=\])", 0))


def description_text(desc: Column) -> Column:
    """Second piece of a description split at `"] "`."""
    return F.get(F.split(desc, r"\] "), F.lit(1))


def _code_piece(code: Column, n: int) -> Column:
    return _none_if_empty(F.split_part(code, F.lit("-"), F.lit(n)))


def table_of(code: Column) -> Column:
    """`SAGDP4N` of `SAGDP4N-11`."""
    return _code_piece(code, 1)


def endpoint_of(code: Column) -> Column:
    """`11` of `SAGDP4N-11`; a third piece is ignored."""
    return _code_piece(code, 2)


def request_tag(table: Column, line_code: Column) -> Column:
    return F.concat_ws("-", table, line_code)


def dataset_of(table: Column, datasets: dict[str, str] = DATASET_OF_TABLE) -> Column:
    """Dataset of a source table, null for an unknown one; a lookup inside the row, not a join."""
    pairs = [F.lit(text) for pair in sorted(datasets.items()) for text in pair]
    return F.create_map(*pairs)[table]


def strip_annotation(name: Column, mark: str = NAME_ANNOTATION) -> Column:
    """Name without a literal annotation mark."""
    return F.replace(name, F.lit(mark), F.lit(""))


def unmark_name(name: Column, clean: str = NATIONAL_NAME, mark: str = NATIONAL_MARK) -> Column:
    """Exactly `clean + mark` becomes `clean`; every other name stays."""
    return F.when(name == F.lit(clean + mark), F.lit(clean)).otherwise(name)


def clean_topic(
    desc: Column, dataset: Column, rules: dict[str, list[str]] = TOPIC_RULES
) -> Column:
    """Topic of a description: the patterns of its dataset removed in order, else the description."""
    topics = []
    for name, patterns in rules.items():
        topic = desc
        for pattern in patterns:
            topic = F.regexp_replace(topic, pattern, "")
        topics.append(F.when(dataset == F.lit(name), topic))
    return F.coalesce(*topics, desc)
