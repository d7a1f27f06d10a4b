"""Checks. Each gives rows `(dataset, check, observed, passed)` and never raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statpanel.functions import any_null, endpoint_of, table_of, year_number
from statpanel.schema import KEY_COLUMNS, SENTINEL_CODES


def _report(measured: DataFrame, passed: Column) -> DataFrame:
    """One row per dataset and measure, from one column per measure."""
    measures = [c for c in measured.columns if c != "dataset"]
    long = measured.unpivot("dataset", measures, "check", "observed")
    return long.withColumn("passed", passed)


def row_measures(sentinels: list[str] | None = None) -> dict[str, Column]:
    """What is counted row by row: the check's name and the condition of its rows. `rows` are all of them."""
    period = F.col("timeperiod")
    measures = {
        "rows": F.lit(True),
        "null_records": any_null(KEY_COLUMNS),
        "non_numeric_periods": period.isNotNull() & year_number(period).isNull(),
        "null_values": F.col("datavalue").isNull(),
    }
    if sentinels is not None:
        measures["sentinel_records"] = F.coalesce(F.col("code").isin(sentinels), F.lit(False))
    return measures


def _passed(minimum: int) -> Column:
    check = F.col("check")
    return (
        F.when(check.isin("geofips_count", "geoname_count"), F.col("observed") >= minimum)
        .when(check == "sentinel_records", F.col("observed") > 0)
        .otherwise(F.col("observed") == 0)
    )


def report_of(observed: DataFrame, minimum: int = 50) -> DataFrame:
    """Rows `(dataset, check, observed)` with whether the check passed."""
    return observed.withColumn("passed", _passed(minimum))


def check_keys(df: DataFrame, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """Rows with a null key column, and rows whose period is no number; all datasets in one pass."""
    period = F.col("timeperiod")
    measured = df.groupBy("dataset").agg(
        F.count_if(any_null(columns)).alias("null_records"),
        F.count_if(period.isNotNull() & year_number(period).isNull()).alias("non_numeric_periods"),
    )
    return _report(measured, F.col("observed") == 0)


def check_coverage(df: DataFrame, minimum: int = 50) -> DataFrame:
    """Distinct entity ids and names, of which at least `minimum` are expected."""
    measured = df.groupBy("dataset").agg(
        F.count_distinct("geofips").alias("geofips_count"),
        F.count_distinct("geoname").alias("geoname_count"),
    )
    return _report(measured, F.col("observed") >= minimum)


def check_rows(df: DataFrame, minimum: int = 50, sentinels: list[str] | None = None) -> DataFrame:
    """`check_keys` and `check_coverage`, the rows without a measure, and with `sentinels` also `check_sentinels`, in one pass."""
    measures = [F.count_if(test).alias(name) for name, test in row_measures(sentinels).items() if name != "rows"]
    distinct = [F.count_distinct("geofips").alias("geofips_count"), F.count_distinct("geoname").alias("geoname_count")]
    return _report(df.groupBy("dataset").agg(*measures, *distinct), _passed(minimum))


def check_unique(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once; aligning and comparing periods rely on there being none."""
    keys = keys or ["geoname", "timeperiod", "topic"]
    counted = df.groupBy("dataset", *keys).agg(F.count(F.lit(1)).alias("_n"))
    measured = counted.groupBy("dataset").agg(F.count_if(F.col("_n") > 1).alias("repeated_keys"))
    return _report(measured, F.col("observed") == 0)


def check_groups(df: DataFrame, minimum: int = 50) -> DataFrame:
    """`check_unique` and `check_coverage` from one scan and one shuffle of the rows, which are counted per group before it."""
    keys = ["geoname", "timeperiod", "topic"]
    groups = df.groupBy("dataset", "geofips", *keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = groups.groupBy("dataset", *keys).agg(F.sum("_n").alias("_n"))
    repeated = counted.groupBy("dataset").agg(F.count_if(F.col("_n") > 1).alias("repeated_keys"))
    # Both sides use the counts, so that they ask for the same shuffle and share it.
    return check_coverage(groups.filter(F.col("_n") > 0), minimum).union(_report(repeated, F.col("observed") == 0))


def check_sentinels(df: DataFrame, sentinels: list[str] = SENTINEL_CODES) -> DataFrame:
    """Whether a dataset holds the line code that marks it as complete."""
    is_sentinel = F.col("code").isin(sentinels)
    measured = df.groupBy("dataset").agg(F.count_if(is_sentinel).alias("sentinel_records"))
    return _report(measured, F.col("observed") > 0)


def unmatched_codes(facts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct codes without a description, which enrichment drops."""
    known = dictionary.select("table", F.col("Key").alias("endpoint")).distinct()
    codes = facts.select("dataset", "code").distinct().withColumns(
        {"table": table_of(F.col("code")), "endpoint": endpoint_of(F.col("code"))}
    )
    # A left join keeps the datasets whose codes all match.
    matched = codes.join(known.withColumn("_known", F.lit(True)), ["table", "endpoint"], "left")
    measured = matched.groupBy("dataset").agg(F.count_if(F.col("_known").isNull()).alias("unmatched_codes"))
    return _report(measured, F.col("observed") == 0)
