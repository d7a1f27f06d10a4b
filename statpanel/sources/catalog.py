"""Tables and views in the session catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def create_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    *,
    bucket_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    buckets: int = 200,
) -> DataFrame:
    """Create or replace table `name` from `df` as parquet, and return the table.

    With `bucket_by` the rows are dealt by these columns into `buckets` files, sorted by `sort_by`: joins, aggregations and windows over the
    same columns, such as `change` over an entity's series, then read the table without a shuffle. One shuffle deals them, so that a
    task writes one bucket whole. A value with very many rows makes its bucket as large: leave such tables unbucketed.
    """
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.format("parquet").mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by, *(sort_by or []))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def view_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.tableType in ("VIEW", "TEMPORARY"))


def create_or_replace_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def create_missing_views(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]]) -> list[str]:
    """Create the views of `builders` that do not exist yet, and return their names."""
    missing = sorted(set(builders) - set(view_names(spark)))
    create_or_replace_views({name: builders[name]() for name in missing})
    return missing


def describe_columns(spark: SparkSession, names: list[str]) -> DataFrame:
    """`(table_name, position, column_name, column_type)` of tables or views."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name in names
        for i, field in enumerate(spark.table(name).schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, column_type string"
    )
