"""Column expressions."""

from statpanel.functions.numbers import (
    pct_change,
    previous,
    round_half_away,
    round_whole,
    year_number,
)
from statpanel.functions.predicates import any_null, at_least_year, categorise
from statpanel.functions.text import (
    clean_topic,
    dataset_of,
    description_text,
    endpoint_of,
    request_tag,
    strip_annotation,
    table_of,
    table_tag,
    unmark_name,
)

__all__ = [
    "any_null",
    "at_least_year",
    "categorise",
    "clean_topic",
    "dataset_of",
    "description_text",
    "endpoint_of",
    "pct_change",
    "previous",
    "request_tag",
    "round_half_away",
    "round_whole",
    "strip_annotation",
    "table_of",
    "table_tag",
    "unmark_name",
    "year_number",
]
