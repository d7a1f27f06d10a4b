"""Column-oriented JSON documents: `{"Col": {"row id": value}}`, JSON-encoded twice.

A text line is one document. A file of a single document is the common case; `write_columnar_json`
writes many documents of bounded size per file, which Spark reads in parallel.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, StringType, StructType

from statpanel.schema import UNROUTED

# Without the first option a document over 20 MB decodes to null; the second makes a broken one fail.
_JSON = {"maxStringLen": str(2**31 - 1), "mode": "FAILFAST"}
_CELLS = "map<string,string>"


def _typed(text: Column, kind: DataType) -> Column:
    """A JSON scalar as the declared type. `12.0` is a whole number, `12.5` in its place fails."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, IntegralType):
        number = text.try_cast("decimal(38,9)")
        whole = F.when(number % 1 == 0, number.try_cast(kind)).when(
            number.isNotNull(), F.raise_error(F.concat(F.lit("not a whole number: "), text))
        )
        return F.coalesce(text.try_cast(kind), whole)
    return text.try_cast(kind)


def typed_number(value: Column, given: DataType, kind: DataType) -> Column:
    """A measure as the declared type. A fraction in a whole number's place, and text that is no number, fail."""
    if not isinstance(kind, IntegralType) or isinstance(given, IntegralType):
        return value.cast(kind)
    text = value.cast("string")
    number = text.cast("decimal(38,9)") if isinstance(given, StringType) else value
    fraction = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast(kind)
    exact = F.coalesce(text.try_cast(kind), number.cast(kind)) if isinstance(given, StringType) else value.cast(kind)
    return F.when(number % 1 != 0, fraction).otherwise(exact)


def _decoded(text: Column) -> Column:
    """Percent-encoded text; a plus sign stands for itself."""
    return F.url_decode(F.regexp_replace(text, r"\+", "%2B"))


def dataset_of_path(path: Column) -> Column:
    """Dataset named by a file's address: `.../name.json`, or a part file under `.../dataset=name/`.

    The address is percent-encoded; the name of a folder is so once more.
    """
    folder = F.nullif(F.regexp_extract(path, r"dataset=([^/]+)/[^/]*$", 1), F.lit(""))
    file = F.nullif(F.regexp_extract(path, r"([^/]+)\.json$", 1), F.lit(""))
    return F.coalesce(_decoded(_decoded(folder)), _decoded(file))


def read_columnar_json(
    spark: SparkSession, path: str, schema: StructType, pattern: str = "*.json"
) -> DataFrame:
    """Rows of all documents in the files of a folder that match `pattern`, plus `dataset`.

    Column names match without regard to case. The columns of a document are zipped by row id, so a
    document becomes rows where it is read, with no shuffle. A column that a document lacks is null.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path)
        .filter(F.length("value") > 0)
        .select(dataset_of_path(F.col("_metadata.file_path")).alias("dataset"), "value")
    )
    inner = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>", _JSON)
    docs = lines.select("dataset", F.get(inner, F.lit(0)).alias("text")).select(
        "dataset", F.from_json("text", f"map<string,{_CELLS}>", _JSON).alias("doc")
    )
    columns = docs.select(
        "dataset", F.transform_keys("doc", lambda key, _: F.lower(key)).alias("doc")
    )
    rows = columns.select("dataset", F.explode(_rows(F.col("doc"), schema)).alias("row"))
    typed = [
        _typed(F.col("row")[i], field.dataType).alias(field.name) for i, field in enumerate(schema.fields)
    ]
    return rows.select(*typed, "dataset")


def _rows(doc: Column, schema: StructType) -> Column:
    """The rows of a document, each an array of cells in schema order.

    Where all columns list the same row ids in the same order, as most documents do, their values are zipped by place; else by id.
    """
    names = [name.lower() for name in schema.fieldNames()]
    ids = F.map_keys(F.get(F.map_values(doc), F.lit(0)))
    present = F.filter(F.map_values(doc), lambda cells: cells.isNotNull())
    same = F.forall(present, lambda cells: F.map_keys(cells) == ids)
    blank = F.transform(ids, lambda _: F.lit(None).cast("string"))
    columns = [F.coalesce(F.map_values(doc[F.lit(n)]), blank).alias(f"c{i}") for i, n in enumerate(names)]
    zipped = F.transform(F.arrays_zip(*columns), lambda row: F.array(*[row.getField(f"c{i}") for i in range(len(names))]))
    return F.when(same, zipped).otherwise(F.map_values(_zipped(doc, schema)))


def _zipped(doc: Column, schema: StructType) -> Column:
    """Map of row id -> array of cells in schema order."""
    nothing = F.create_map().cast(_CELLS)

    def add(rows: Column, numbered: tuple[int, str]) -> Column:
        width, name = numbered
        cells = F.coalesce(doc[F.lit(name.lower())], nothing)
        blank = F.array_repeat(F.lit(None).cast("string"), width)
        return F.map_zip_with(
            rows,
            cells,
            lambda _, row, cell: F.concat(F.coalesce(row, blank), F.array(cell)),
        )

    start = F.create_map().cast("map<string,array<string>>")
    return reduce(add, enumerate(schema.fieldNames()), start)


def name_document(spark: SparkSession, folder: str, path: str) -> None:
    """Move the one part file below `folder` to `path`, as documents that others name `name.json` are found by their name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    (found,) = fs.globStatus(hadoop.Path(f"{folder}/part-*"))
    fs.mkdirs(target.getParent())
    if not fs.rename(found.getPath(), target):
        raise OSError(f"cannot write {path}")


def _cell(value: Column, kind: DataType) -> Column:
    """What JSON has no number for is null."""
    if not isinstance(kind, FractionalType) or isinstance(kind, DecimalType):
        return value
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def write_columnar_json(df: DataFrame, path: str, max_bytes: int = 1 << 22, max_rows: int = 1 << 12) -> None:
    """Write rows (with a `dataset` column) as documents under `path/dataset=...`, one per line.

    A document holds rows of one dataset that one task read one after the other, at most `max_rows` of them and of about `max_bytes`
    bytes at most. Rows are numbered where they are read; a run of `max_rows` numbers meets in one group, whatever the dataset, so no group
    grows with the data, and is cut into documents there. Rows without a dataset go to `_unrouted`. Numbers that are
    infinite or none are written as null. Built-in functions do all of it.
    """
    fields = [f for f in df.schema if f.name != "dataset"]
    name = lambda f: F.col("`" + f.name.replace("`", "``") + "`")
    cells = F.struct(*[_cell(name(f), f.dataType).alias(f"c{i}") for i, f in enumerate(fields)])
    numbered = df.select(F.coalesce("dataset", F.lit(UNROUTED)).alias("dataset"), F.monotonically_increasing_id().alias("id"), cells.alias("cells"))
    runs = numbered.select("dataset", F.floor(F.col("id") / max_rows).alias("run"), F.struct((F.col("id") % max_rows).alias("row"), "cells").alias("one"))
    texts = [F.coalesce(F.length(F.col(f"one.cells.c{i}")), F.lit(0)) for i, f in enumerate(fields) if isinstance(f.dataType, StringType)]
    # Beside its value a cell holds its row's number, quotes and commas.
    size = reduce(add, texts, F.lit(20 * len(fields)))
    # By number, so that small tables are not encoded by a single task.
    runs = runs.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "dataset", "run")
    runs = runs.groupBy("dataset", "run").agg(F.sum(size).alias("size"), F.collect_list("one").alias("rows"))
    pieces = F.least(F.ceil(F.col("size") / max_bytes), F.size("rows"))
    each = runs.withColumn("per", F.ceil(F.size("rows") / pieces).cast("int"))
    each = each.withColumn("at", F.explode(F.sequence(F.lit(0), F.ceil(F.size("rows") / F.col("per")).cast("int") - 1)))
    each = each.select("dataset", F.slice("rows", F.col("at") * F.col("per") + 1, F.col("per")).alias("rows"))

    def column(i: int) -> Column:
        entry = lambda r: F.struct(r["row"].cast("string"), r["cells"][f"c{i}"])
        return F.map_from_entries(F.transform("rows", entry)).alias(fields[i].name)

    document = F.to_json(F.struct(*[column(i) for i in range(len(fields))]), {"ignoreNullFields": "false"})
    # A text alone has no JSON function: it is written as the only item of an array, without the brackets.
    line = F.to_json(F.array(document))
    line = F.substring(line, F.lit(2), F.length(line) - 2)
    each.select("dataset", line.alias("value")).write.mode("errorifexists").partitionBy("dataset").text(path)
