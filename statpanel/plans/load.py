"""From landed observations to checked tables.

A load stages everything in a new folder and then publishes it: until the last row is written and counted, readers see the tables as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statpanel.operators import (
    check_groups,
    check_rows,
    check_unique,
    enrich,
    report_of,
    row_measures,
    sized,
    topics_of,
    unmatched_codes,
)
from statpanel.schema import DATASET_OF_TABLE, TOPIC_RULES, UNROUTED, dataset_schema
from statpanel.sources.columnar_json import typed_number

_STAGED = "name string, ddl string, measures map<string,bigint>"


def _columns(schema: StructType) -> list[tuple]:
    return [(f.name.lower(), f.dataType) for f in schema]


def load_tables(
    spark: SparkSession,
    observations: DataFrame,
    dictionary: DataFrame,
    path: str,
    *,
    datasets: dict[str, str] = DATASET_OF_TABLE,
    schemas: dict[str, StructType] | None = None,
    rules: dict[str, list[str]] = TOPIC_RULES,
    sentinels: list[str] | None = None,
    publish: bool = True,
) -> DataFrame:
    """Enrich landed observations (with `dataset`), register one table per dataset, and return what was counted on the way.

    The rows are written as parquet under the new folder `path`, in one job per type of `datavalue`; observations landed by dataset
    are read once, as each job prunes the others' partitions. The same jobs count what `check_rows` would count, but for distinct
    names; the counts come back as rows `(dataset, check, observed, passed)`, for `check_tables` to go on from.

    Only when all is written are the tables pointed at the new files, see `publish_tables`. A load that fails half way has changed no
    table, and its folder cannot be published. With `publish=False` the tables stay as they are until `publish_tables` is called.

    The tables are external; the files that a table pointed at before stay, so that queries that have begun end as they began. A managed
    table of that name is refused, as replacing it would delete its files, and so is one with other columns. Rows of no known
    dataset and of codes without a description are not loaded; `check_tables` reports them. A fraction in a dataset of whole numbers fails.
    """
    names = sorted(set(datasets.values()))
    schemas = schemas or {name: dataset_schema(name) for name in names}
    for name in names:
        if not spark.catalog.tableExists(name):
            continue
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table; drop it or choose another name")
        if _columns(spark.table(name).schema) != _columns(schemas[name]):
            raise ValueError(f"{name} has other columns; drop it or choose another name")
    topics = sized(topics_of(dictionary, datasets, rules))
    by_type: dict = {}
    for name in names:
        by_type.setdefault(schemas[name]["datavalue"].dataType, []).append(name)
    measures: dict[str, dict[str, int]] = {}
    for n, (kind, members) in enumerate(by_type.items()):
        rows = observations.filter(F.col("dataset").isin(members))
        typed = rows.withColumn("datavalue", typed_number(F.col("datavalue"), rows.schema["datavalue"].dataType, kind))
        enriched = enrich(typed, dictionary, datasets, rules=rules, topics=topics)
        counted = Observation()
        # The last thing before the write, in its own stage, where each row is counted with the one attempt that commits it.
        each = {(name, check): test for name in members for check, test in row_measures(sentinels).items()}
        counts = [F.count_if((F.col("dataset") == name) & test).alias(f"{i}") for i, ((name, _), test) in enumerate(each.items())]
        mode = "append" if n else "errorifexists"
        enriched.observe(counted, *counts).write.mode(mode).partitionBy("dataset").parquet(path)
        for i, (name, check) in enumerate(each):
            measures.setdefault(name, {})[check] = counted.get[str(i)]
    staged = [(name, schemas[name].toDDL(), measures[name]) for name in names]
    spark.createDataFrame(staged, _STAGED).coalesce(1).write.json(f"{path}/_staged")
    if publish:
        publish_tables(spark, path)
    found = [(name, check, n) for name, by in measures.items() if by["rows"] for check, n in by.items() if check != "rows"]
    return report_of(spark.createDataFrame(found, "dataset string, check string, observed bigint"))


def publish_tables(spark: SparkSession, path: str) -> list[str]:
    """Point the tables of a complete load at the files under `path`, and return their names.

    Only the catalog changes, by one statement per table: a reader finds the old files of a table or the new ones, never none. Where
    the driver is lost in between, calling it again ends the step; calling it with an older folder goes back to that load.
    """
    staged = spark.read.schema(_STAGED).json(f"{path}/_staged").orderBy("name").collect()  # a row per dataset
    for table in staged:
        place = f"{path}/dataset={table.name}"
        if spark.catalog.tableExists(table.name):
            quoted = place.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE `{table.name}` SET LOCATION '{quoted}'")
        else:
            spark.catalog.createTable(table.name, place, "parquet", StructType.fromDDL(table.ddl))
    return [table.name for table in staged]


def check_tables(
    spark: SparkSession,
    names: list[str],
    minimum: int = 50,
    *,
    observations: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    sentinels: list[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """All checks of the loaded tables, as rows `(dataset, check, observed, passed)`.

    With the landed observations also the rows that belong to no dataset, and with the dictionary beside them the codes
    without a description and their rows: what the load leaves out. With `counted`, what `load_tables` returned, the tables are read
    once, for repeated keys and distinct names; else twice.
    """
    tables = [spark.table(name).withColumn("dataset", F.lit(name)) for name in names]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table, allowMissingColumns=True)
    if counted is None:
        report = check_rows(rows, minimum, sentinels).union(check_unique(rows))
    else:
        report = counted.filter(F.col("dataset").isin(names)).union(check_groups(rows, minimum))
    if observations is not None:
        unrouted = observations.filter(F.col("dataset") == UNROUTED).agg(F.count(F.lit(1)).alias("observed"))
        report = report.union(
            unrouted.select(
                F.lit(UNROUTED).alias("dataset"),
                F.lit("unrouted_records").alias("check"),
                "observed",
                (F.col("observed") == 0).alias("passed"),
            )
        )
        if dictionary is not None:
            routed = observations.filter(F.col("dataset") != UNROUTED)
            report = report.union(unmatched_codes(routed, dictionary))
    return report
