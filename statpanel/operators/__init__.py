"""Operators: functions from DataFrames to DataFrames."""

from statpanel.operators.align import align_topics, align_topics_pivot
from statpanel.operators.change import change
from statpanel.operators.checks import (
    check_coverage,
    check_groups,
    check_keys,
    check_rows,
    check_sentinels,
    check_unique,
    report_of,
    row_measures,
    unmatched_codes,
)
from statpanel.operators.enrich import (
    enrich,
    prepare_dictionary,
    request_manifest,
    split_codes,
    topics_of,
)
from statpanel.operators.joins import sized
from statpanel.operators.landing import land, route
from statpanel.operators.names import first_rows, keep_listed, reference_names
from statpanel.operators.order import in_order
from statpanel.operators.rank import rank_within
from statpanel.operators.sets import (
    first_wins,
    symmetric_difference,
    union_by_name,
    union_distinct,
)
from statpanel.operators.top import top_per_group, with_top

__all__ = [
    "align_topics",
    "align_topics_pivot",
    "change",
    "check_coverage",
    "check_groups",
    "check_keys",
    "check_rows",
    "check_sentinels",
    "check_unique",
    "enrich",
    "first_rows",
    "first_wins",
    "in_order",
    "keep_listed",
    "land",
    "prepare_dictionary",
    "rank_within",
    "reference_names",
    "request_manifest",
    "report_of",
    "route",
    "row_measures",
    "sized",
    "split_codes",
    "symmetric_difference",
    "top_per_group",
    "topics_of",
    "union_by_name",
    "union_distinct",
    "unmatched_codes",
    "with_top",
]
