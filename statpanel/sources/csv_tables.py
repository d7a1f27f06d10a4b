"""CSV tables and database export.

Quotes inside a field are doubled, on both sides. An empty text and a null are the same in CSV: both come
back as null.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from statpanel.schema import DICTIONARY

_FORMAT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").options(**_FORMAT).csv(path)


def import_csv(spark: SparkSession, path: str, schema: StructType, *, multi_line: bool = False) -> DataFrame:
    """Read CSV with a declared schema; a row that does not fit it fails.

    `multi_line` is needed for fields with line breaks. A file is then still read in blocks by many tasks, see `_records`.
    """
    if not multi_line:
        return spark.read.schema(schema).options(**_FORMAT, mode="FAILFAST").csv(path)
    options = {k: v for k, v in _FORMAT.items() if k not in ("header", "multiLine")}
    parsed = F.from_csv("record", schema.toDDL(), {**options, "mode": "FAILFAST"}).alias("row")
    return _records(spark, path).select(parsed).select("row.*")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of CSV files without their headers, put together from lines that blocks of the files hold.

    A line break ends a record if an even number of quotes stands before it, as a quote inside a field is doubled. So each block counts its
    quotes by itself, the parity at its start is a running sum over the few blocks of a file, and that at each of its lines
    one over the block. Only the lines of records that reach over line breaks are shuffled, to be joined.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    lines = lines.withColumn("odd", (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2)
    block = Window.partitionBy("file", "block").orderBy("line")
    lines = lines.withColumn("inside", F.sum("odd").over(block) - F.col("odd"))
    blocks = Window.partitionBy("file").orderBy("block")
    before = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    before = before.select("file", "block", (F.sum("odd").over(blocks) - F.col("odd")).alias("before"))
    placed = lines.join(before, ["file", "block"]).withColumn("open", (F.col("before") + F.col("inside")) % 2)
    # A record is named by its first line; lines at the start of a block may belong to one that began in a block before.
    starts = placed.withColumn("first", F.when(F.col("open") == 0, F.struct("block", "line")))
    starts = starts.withColumn("first", F.last("first", ignorenulls=True).over(block))
    carried = starts.groupBy("file", "block").agg(F.max("first").alias("last"))
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("file", "block", F.max("last").over(earlier).alias("carried"))
    named = starts.join(carried, ["file", "block"]).withColumn("first", F.coalesce("first", "carried"))
    head = F.min(F.when(F.col("block") == 0, F.col("line"))).over(Window.partitionBy("file", "block"))
    named = named.withColumn("head", head).filter((F.col("first.block") != 0) | F.col("head").isNull() | (F.col("first.line") != F.col("head")))
    single = named.filter("open = 0 and odd = 0").select(F.col("value").alias("record"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"])
    joined = named.filter("open = 1 or odd = 1").groupBy("file", "first").agg(F.array_join(parts, "\n").alias("record"))
    # Outside quotes a carriage return can only belong to the line's end.
    return single.union(joined.select("record")).select(F.regexp_replace("record", r"\r\z", "").alias("record")).filter("record <> ''")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Line-code dictionary `(Key, Desc, table)`, every column text."""
    return import_csv(spark, path, DICTIONARY)


def _line_breaks(df: DataFrame) -> Column | None:
    """Whether a text column holds a line break, which a reader of single lines would take for the end of a row; null without rows."""
    texts = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema if isinstance(f.dataType, StringType)]
    found = [F.coalesce(t.rlike(r"[\r\n]"), F.lit(False)) for t in texts]
    return F.bool_or(reduce(or_, found)) if found else None


def _quoted(value: str, mark: str) -> str:
    return mark + (value.replace("`", "``") if mark == "`" else value.replace("\\", "\\\\").replace("'", "\\'")) + mark


def export_database(
    spark: SparkSession, tables: dict[str, DataFrame], path: str, views: dict[str, str] | None = None
) -> None:
    """Write each table as CSV under `path`, with the scripts `schema.sql` and `load.sql`.

    `run_script` runs them: the first creates the tables, and the views over them from their SELECT text, the second fills
    the tables. A row that does not fit its table fails the load. Whether a text holds line breaks is found while it is written;
    the script reads such tables a file per task, `import_csv` reads them in blocks.
    """
    creates, loads = [], []
    for name, df in tables.items():
        found, seen = _line_breaks(df), Observation()
        write_csv(df if found is None else df.observe(seen, found.alias("broken")), f"{path}/{name}")
        broken = found is not None and bool(seen.get["broken"])
        options = {**_FORMAT, "multiLine": str(broken).lower(), "mode": "FAILFAST"}
        ddl = df.schema.toDDL()
        listed = ", ".join(f"{key} {_quoted(value, chr(39))}" for key, value in options.items())
        table, source = _quoted(name, "`"), _quoted(f"{name}_csv", "`")
        creates.append(f"CREATE TABLE {table} ({ddl}) USING parquet")
        loads.append(
            f"CREATE OR REPLACE TEMPORARY VIEW {source} ({ddl}) USING csv "
            f"OPTIONS (path {_quoted(f'{path}/{name}', chr(39))}, {listed})"
        )
        loads.append(f"INSERT INTO {table} SELECT * FROM {source}")
    for name, select in (views or {}).items():
        creates.append(f"CREATE OR REPLACE VIEW {_quoted(name, '`')} AS {' '.join(select.split())}")
    for script, statements in (("schema.sql", creates), ("load.sql", loads)):
        lines = spark.createDataFrame(list(enumerate(statements)), "n int, statement string")
        lines.coalesce(1).sortWithinPartitions("n").select("statement").write.text(f"{path}/{script}")


def run_script(spark: SparkSession, path: str) -> None:
    """Run an exported script, one statement per line in file order."""
    text = spark.read.text(path, wholetext=True).collect()
    for statement in (line for row in text for line in row.value.splitlines() if line):
        spark.sql(statement)
