"""Row shapes and fixed values of the panels.

Types are declared, never inferred: a column that happens to hold no nulls in one extract must not
change type in the next one.
"""

from __future__ import annotations

from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType


def _fields(*pairs: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in pairs])


def landed(value: DataType | None = None, noteref: bool = True) -> StructType:
    """Observation rows before enrichment."""
    pairs = [
        ("code", StringType()),
        ("geofips", StringType()),
        ("geoname", StringType()),
        ("timeperiod", StringType()),
        ("cl_unit", StringType()),
        ("unit_mult", LongType()),
        ("datavalue", value or LongType()),
    ]
    if noteref:
        pairs.append(("noteref", StringType()))
    return _fields(*pairs)


def enriched(value: DataType | None = None, noteref: bool = True) -> StructType:
    """Observation rows after enrichment: the landed columns, then table, endpoint and topic."""
    extra = _fields(("table", StringType()), ("endpoint", StringType()), ("topic", StringType()))
    return StructType(landed(value, noteref).fields + extra.fields)


DICTIONARY = _fields(("Key", StringType()), ("Desc", StringType()), ("table", StringType()))
RAW_DICTIONARY = _fields(("Key", StringType()), ("Desc", StringType()))

# Columns that identify an observation and must not be null.
KEY_COLUMNS = ["code", "geofips", "geoname", "timeperiod", "table", "endpoint", "topic"]

# ---- Fixed values -------------------------------------------------------------------------------
# Dataset of each source table.
DATASET_OF_TABLE = {
    "CAGDP9": "real_gdp",
    "CAINC1": "population",
    "CAINC30": "wages_salary",
    "CAINC4": "employment",
    "SAGDP2N": "gdp",
    "SAGDP4N": "compensation",
    "SAINC30": "personal_income",
    "SAINC51": "disposable_income",
    "SAPCE2": "consumption_expenditures",
}

# Line code whose presence marks a table as complete.
SENTINEL_CODES = [
    "CAGDP9-1",
    "CAINC1-1",
    "CAINC30-10",
    "CAINC4-1",
    "SAGDP2N-1",
    "SAGDP4N-1",
    "SAINC30-10",
    "SAINC51-51",
    "SAPCE2-1",
]

# Datasets whose measure is a double, and datasets without footnotes.
DOUBLE_DATASETS = ["disposable_income", "gdp", "personal_income"]
DATASETS_WITHOUT_NOTEREF = ["consumption_expenditures"]

# Patterns removed from descriptions to get the topic, in order of application.
INDUSTRY_CODE_SUFFIX = r" \(\d.+\)$"
TOPIC_RULES = {
    "compensation": ["Compensation of employees: ", INDUSTRY_CODE_SUFFIX],
    "gdp": [r"Gross domestic product \(GDP\) by state\: ", INDUSTRY_CODE_SUFFIX],
    "real_gdp": ["Real GDP: ", INDUSTRY_CODE_SUFFIX],
}

# Line codes that are not requested, per table.
EXCLUDED_LINE_CODES = {"SAGDP4N": r"\("}

# National row: its landed name and its clean name.
NATIONAL_NAME = "United States"
NATIONAL_MARK = " *"
NAME_ANNOTATION = "[B]"
# -------------------------------------------------------------------------------------------------

UNROUTED = "_unrouted"


def dataset_schema(dataset: str) -> StructType:
    """Schema of one enriched dataset table."""
    value = DoubleType() if dataset in DOUBLE_DATASETS else LongType()
    return enriched(value, noteref=dataset not in DATASETS_WITHOUT_NOTEREF)
