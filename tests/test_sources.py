from __future__ import annotations

import json
import os
import random
import subprocess
import sys
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statpanel import operators as op
from statpanel import sources as src
from statpanel.schema import dataset_schema, enriched, landed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def panel(spark, n=25):
    data = [
        (f"T-{i % 3}", f"0{i:04d}", f"N{i}", "2000", "u", 0, None if i % 5 == 0 else i * 10, 'a "q", b', "T", str(i % 3), "x")
        for i in range(n)
    ]
    return spark.createDataFrame(data, enriched())


# ---- column-oriented JSON -----------------------------------------------------------------------


def write_document(folder, name, columns):
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps(json.dumps(columns)))


def test_columnar_json_documents(spark, folder):
    write_document(
        folder,
        "gdp.json",
        {
            "Code": {"0": "G-1", "3": "G-2", "4": "G-3"},
            "GeoName": {"4": "c", "0": "United States *", "3": None},
            "DataValue": {"0": 12.0, "3": None, "4": 7},
            "UNIT_MULT": {"0": 3, "4": 3},
        },
    )
    write_document(folder, "population.json", {"Code": {"1": 'P"1\n'}, "NoteRef": {"1": "n"}})
    write_document(folder, "old.json.bak", {"Code": {"1": "no"}})
    write_document(folder, "empty.json", {"Code": {}})
    got = src.read_columnar_json(spark, folder, landed())
    assert got.schema.fieldNames() == [*landed().fieldNames(), "dataset"]
    assert rows(got.select("dataset", "code", "geoname", "unit_mult", "datavalue", "noteref")) == sorted(
        [
            ("gdp", "G-1", "United States *", 3, 12, None),
            ("gdp", "G-2", None, None, None, None),
            ("gdp", "G-3", "c", 3, 7, None),
            ("population", 'P"1\n', None, None, None, "n"),
        ],
        key=str,
    )


def test_columnar_json_reads_documents_over_20_mb(spark, folder):
    n = 900_000
    write_document(folder, "big.json", {"Code": {str(i): "SAGDP4N-1" for i in range(n)}})
    assert os.path.getsize(f"{folder}/big.json") > 20_000_000
    schema = StructType([StructField("code", StringType())])
    assert src.read_columnar_json(spark, folder, schema).count() == n


def test_broken_document_fails(spark, folder):
    with open(f"{folder}/bad.json", "w") as f:
        f.write(json.dumps('{"Code": {"0": '))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        src.read_columnar_json(spark, folder, landed()).collect()


def test_fraction_in_a_whole_column_fails(spark, folder):
    write_document(folder, "a.json", {"DataValue": {"0": 1e3, "1": None, "2": "(NA)"}})
    assert rows(src.read_columnar_json(spark, folder, landed()).select("datavalue")) == [(1000,), (None,), (None,)]
    write_document(folder, "b.json", {"DataValue": {"0": 12.5}})
    with pytest.raises(Exception, match="not a whole number: 12.5"):
        src.read_columnar_json(spark, folder, landed()).collect()


def test_columnar_json_roundtrip(spark, folder):
    df = panel(spark).withColumn("dataset", F.when(F.col("endpoint") == "1", "one").otherwise("two"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        src.write_columnar_json(df, f"{folder}/out")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    back = src.read_columnar_json(spark, f"{folder}/out", enriched(), pattern="*.txt")
    assert rows(back) == rows(df)


def test_columnar_json_doubles(spark, folder):
    schema = dataset_schema("gdp")
    value = F.when(F.col("geofips") == "00003", float("nan")).otherwise(F.col("datavalue") / 7)
    df = panel(spark).withColumn("datavalue", value).withColumn("dataset", F.lit("gdp"))
    src.write_columnar_json(df, f"{folder}/out")
    back = src.read_columnar_json(spark, f"{folder}/out", schema, pattern="*.txt")
    want = df.withColumn("datavalue", F.nanvl("datavalue", F.lit(None).cast("double")))
    assert rows(back) == rows(want)


# ---- CSV ----------------------------------------------------------------------------------------


def test_csv_roundtrip_keeps_quotes_and_leading_zeros(spark, folder):
    df = panel(spark)
    src.write_csv(df, f"{folder}/t")
    assert rows(src.import_csv(spark, f"{folder}/t", enriched())) == rows(df)


def test_csv_written_elsewhere(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('Key,Desc,table\n01,"say ""hi"", all",T\n02,,T\n03,"",T\n')
    got = rows(src.read_dictionary(spark, f"{folder}/t.csv"))
    assert got == [("01", 'say "hi", all', "T"), ("02", None, "T"), ("03", None, "T")]


def test_csv_with_line_breaks(spark, folder):
    df = spark.createDataFrame([("a\nb", "c")], "x string, y string")
    src.write_csv(df, f"{folder}/t")
    assert rows(src.import_csv(spark, f"{folder}/t", df.schema, multi_line=True)) == [("a\nb", "c")]


def test_database_export_and_restore(spark, folder):
    first, second = panel(spark), panel(spark, 4).drop("noteref")
    src.export_database(spark, {"exp_one": first, "exp_two": second}, f"{folder}/db")
    src.run_script(spark, f"{folder}/db/schema.sql")
    src.run_script(spark, f"{folder}/db/load.sql")
    assert spark.table("exp_one").schema == first.schema
    assert rows(spark.table("exp_one")) == rows(first)
    assert rows(spark.table("exp_two")) == rows(second)


# ---- catalog, memory ----------------------------------------------------------------------------


def test_tables_can_be_created_again(spark, folder):
    for n in (5, 3):
        table = src.create_table(panel(spark, n), "again", f"{folder}/again")
        assert table.count() == n
    got = rows(src.describe_columns(spark, ["again"]).select("column_name", "column_type"))
    assert ("datavalue", "bigint") in got and len(got) == 11


def test_only_missing_views_are_created(spark):
    calls = []

    def builder(name):
        def build():
            calls.append(name)
            return spark.range(3)

        return build

    spark.range(1).createOrReplaceTempView("kept_view")
    spark.range(1).createOrReplaceTempView("unrelated_view")
    builders = {"kept_view": builder("kept_view"), "new_view": builder("new_view")}
    assert src.create_missing_views(spark, builders) == ["new_view"]
    assert calls == ["new_view"]
    assert spark.table("kept_view").count() == 1
    assert {"kept_view", "new_view", "unrelated_view"} <= set(src.view_names(spark))


def test_arrow(spark):
    table = pa.table({"a": [1, 2, None], "b": ["x", None, "z"]})
    df = src.from_arrow(spark, table, "from_arrow_view")
    assert spark.table("from_arrow_view").count() == 3
    assert src.to_arrow(df).to_pydict() == table.to_pydict()
    with pytest.raises(ValueError):
        src.to_arrow(df, max_rows=2)


def test_cached(spark):
    with src.cached(spark.range(10)) as df:
        assert df.is_cached and df.count() == 10
    assert not df.is_cached


def test_scratch_path_is_below_the_shared_folder(spark):
    a, b = src.scratch_path(spark, "x"), src.scratch_path(spark, "x")
    assert a != b
    assert a.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


# ---- responses ----------------------------------------------------------------------------------


def response_schema():
    return StructType([f for f in landed().fields if f.name != "code"])


def test_landed_responses_of_a_manifest(spark, folder):
    df = panel(spark).select(*landed().fieldNames())
    src.write_responses(df, f"{folder}/r")
    dictionary = spark.createDataFrame([("0", "d", "T"), ("2", "d", "T"), ("9", "d", "T")], "Key string, Desc string, table string")
    manifest = op.request_manifest(dictionary)
    got = src.read_responses(spark, f"{folder}/r", response_schema(), manifest)
    want = df.filter("code in ('T-0', 'T-2')")
    assert rows(got.select(*df.columns)) == rows(want)
    assert src.read_responses(spark, f"{folder}/r", response_schema()).count() == 25


def test_worker_functions_need_no_package_on_the_workers(spark, folder, monkeypatch):
    """Executors have Spark and Arrow, but not this package."""
    sent = []

    def keep(self, function, schema):
        sent.append(cloudpickle.dumps(function))
        return self.limit(0).select(F.lit("d").alias("dataset"), F.lit("v").alias("value"))

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", keep)
    src.write_columnar_json(panel(spark).withColumn("dataset", F.lit("d")), f"{folder}/out")
    assert not sent  # the encoder is all built-in functions
    manifest = spark.createDataFrame([("T", "1", "T-1")], "table string, line_code string, code string")
    src.fetch_requests(manifest, lambda table, code: iter(()), response_schema())
    assert len(sent) == 1
    for i, pickled in enumerate(sent):
        with open(f"{folder}/{i}", "wb") as f:
            f.write(pickled)
        load = f"from pyspark import cloudpickle; f = cloudpickle.load(open('{folder}/{i}', 'rb')); list(f(iter(())))"
        subprocess.run([sys.executable, "-c", load], cwd="/", check=True, timeout=120)


def test_fetch_requests_in_parallel_tasks(spark):
    def fetch(table, line_code):
        import pyarrow as pa

        for part in range(3):
            yield pa.record_batch({"v": [int(line_code) * 10 + part], "t": [table]})

    schema = StructType.fromDDL("v bigint, t string")
    dictionary = spark.createDataFrame([(str(i), "d", "T") for i in range(20)], "Key string, Desc string, table string")
    got = src.fetch_requests(op.request_manifest(dictionary), fetch, schema, partitions=8)
    assert got.rdd.getNumPartitions() == 8
    assert rows(got) == sorted(((i * 10 + p, "T", f"T-{i}") for i in range(20) for p in range(3)), key=str)


TRICKY = [
    (1, " both ", 1.5), (2, "tab\t", None), (3, "x  ", 0.1), (4, 'q"uo"te, comma', 1e300), (5, "line\nbreak", 2.0),
    (6, "carriage\rreturn", 2.0), (7, None, 2.0), (8, "back\\slash \\\"", -0.0),
]


def test_export_restores_blanks_and_line_breaks(spark, folder):
    df = spark.createDataFrame(TRICKY, "id int, text string, `odd``name` double")
    path = f"{folder}/it's here"
    src.export_database(spark, {"statpanel_tricky": df}, path, {"statpanel_tricky_view": "SELECT id\nFROM statpanel_tricky"})
    for script in ("schema.sql", "load.sql"):
        src.run_script(spark, f"{path}/{script}")
    try:
        assert sorted(spark.table("statpanel_tricky").collect()) == sorted(df.collect())
        assert spark.table("statpanel_tricky_view").count() == len(TRICKY)
    finally:
        spark.sql("DROP VIEW statpanel_tricky_view")
        spark.sql("DROP TABLE statpanel_tricky")


def test_a_row_that_does_not_fit_fails_the_restore(spark, folder):
    df = spark.createDataFrame([("x",)], "a string")
    src.export_database(spark, {"statpanel_unfit": df}, folder)
    spark.sql("CREATE TABLE statpanel_unfit (a string) USING parquet")
    bad = spark.createDataFrame([("a",), ('a,b,c',)], "value string").coalesce(1)
    bad.write.mode("append").option("lineSep", "\n").text(f"{folder}/statpanel_unfit")
    try:
        with pytest.raises(Exception, match="(?i)malformed"):
            src.run_script(spark, f"{folder}/load.sql")
    finally:
        spark.sql("DROP TABLE statpanel_unfit")


def test_csv_keeps_blanks(spark, folder):
    df = spark.createDataFrame([(i, t) for i, t, _ in TRICKY if t and "\n" not in t and "\r" not in t], "id int, text string")
    src.write_csv(df, f"{folder}/c")
    assert sorted(src.import_csv(spark, f"{folder}/c", df.schema).collect()) == sorted(df.collect())


def test_names_of_datasets_come_back(spark, folder):
    names = ["real gdp", "a+b", "50%", "ü", None]
    rows = [("T-1", "0", "n", "2000", "u", 0, i, None, name) for i, name in enumerate(names)]
    schema = StructType([*landed().fields, StructField("dataset", StringType())])
    src.write_columnar_json(spark.createDataFrame(rows, schema), f"{folder}/j")
    back = src.read_columnar_json(spark, f"{folder}/j", landed(), "*.txt")
    assert {(r["datavalue"], r["dataset"]) for r in back.collect()} == {
        (i, name or "_unrouted") for i, name in enumerate(names)
    }


def test_documents_hold_odd_cells_and_bounded_rows(spark, folder):
    odd = ['say "hi"', "a\\b\n\t\u2028", "", None, "漢字 é 😀", "null", "1.0", "\x00\x7f"]
    data = [(t, float(i) if i % 3 else float("inf"), Decimal(f"{i}.25"), 2**53 + i, i % 2 == 0, "d" if i % 4 else None) for i, t in enumerate(odd * 3)]
    df = spark.createDataFrame(data, "text string, x double, d decimal(20,2), n bigint, b boolean, dataset string").coalesce(1)
    src.write_columnar_json(df, f"{folder}/o", max_rows=5)
    lines = [r["value"] for r in spark.read.text(f"{folder}/o").collect()]
    documents = [json.loads(json.loads(line)) for line in lines]
    assert len(documents) == 10 and all(1 <= len(d["text"]) <= 5 for d in documents)
    for d in documents:
        assert list(d) == ["text", "x", "d", "n", "b"] and all(cells.keys() == d["text"].keys() for cells in d.values())
    cells = sorted(((d["text"][k], d["x"][k], d["n"][k], d["b"][k]) for d in documents for k in d["text"]), key=str)
    assert cells == sorted(((t, None if x == float("inf") else x, n, b) for t, x, _, n, b, _ in data), key=str)
    shape = StructType.fromDDL("text string, x double, d decimal(20,2), n bigint")
    back = src.read_columnar_json(spark, f"{folder}/o", shape, "*.txt").select("text", "x", "d", "n")
    want = df.select("text", F.when(F.col("x") != float("inf"), F.col("x")).alias("x"), "d", "n")
    assert rows(back) == rows(want)
    src.write_columnar_json(df.limit(0), f"{folder}/none")
    assert src.read_columnar_json(spark, f"{folder}/none", shape, "*.txt").isEmpty()


def test_documents_are_bounded_and_zip_by_id_or_place(spark, folder):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("code"), F.lit("d").alias("dataset"), F.col("id").alias("datavalue")
    )
    src.write_columnar_json(rows.coalesce(1), f"{folder}/j", max_bytes=2000)
    assert spark.read.text(f"{folder}/j").count() > 20
    shape = StructType([f for f in landed().fields if f.name in ("code", "datavalue", "noteref")])
    back = src.read_columnar_json(spark, f"{folder}/j", shape, "*.txt")
    assert back.filter("code = datavalue and noteref is null and dataset = 'd'").count() == 5000
    document = {"Code": {"0": "a", "2": "b"}, "DataValue": {"2": 7, "0": 5, "9": 1}, "Other": {"0": 1}}
    spark.createDataFrame([(json.dumps(json.dumps(document)),)], "value string").coalesce(1).write.text(f"{folder}/k/dataset=z")
    back = src.read_columnar_json(spark, f"{folder}/k", shape, "*.txt").select("code", "datavalue").collect()
    assert sorted(map(tuple, back), key=str) == [("a", 5), ("b", 7), (None, 1)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_with_line_breaks_is_read_in_many_blocks(spark, folder, end):
    rng = random.Random(3)
    data = []
    for i in range(4000):
        text = "".join(rng.choices(["a", "é", '"', '""', ",", "\n", "\r", "\n\n", " ", "漢"], k=rng.randint(0, 30)))
        data.append((i, text or None, rng.choice(["plain", 'say "hi"', "x\ny", None])))
    data[1000] = (1000, "line\n" * 3000, "one record over several blocks")
    quoted = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"'
    with open(f"{folder}/t.csv", "w", newline="") as f:
        f.write(f"id,a,b{end}" + "".join(f"{i},{quoted(a)},{quoted(b)}{end}" for i, a, b in data))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = src.import_csv(spark, f"{folder}/t.csv", StructType.fromDDL("id bigint, a string, b string"), multi_line=True)
        blocks = spark.read.option("lineSep", "\n").text(f"{folder}/t.csv").rdd.getNumPartitions()
        got = rows(back)
    finally:
        for key, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{key}", value)
    assert blocks > 10
    assert got == rows(spark.createDataFrame(data, "id bigint, a string, b string"))


def test_records_of_several_files_and_empty_ones(spark, folder):
    os.makedirs(f"{folder}/c")
    for name, text in (("a", "id,t\n1,\"x\ny\"\n2,z"), ("b", "id,t\n"), ("d", ""), ("e", "id,t\n3,\"\"\"\n\"\"\"\n")):
        with open(f"{folder}/c/{name}.csv", "w", newline="") as f:
            f.write(text)
    back = src.import_csv(spark, f"{folder}/c", StructType.fromDDL("id bigint, t string"), multi_line=True)
    assert rows(back) == [(1, "x\ny"), (2, "z"), (3, '"\n"')]
    with open(f"{folder}/c/f.csv", "w") as f:
        f.write("id,t\nno number,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        src.import_csv(spark, f"{folder}/c", StructType.fromDDL("id bigint, t string"), multi_line=True).collect()


def test_export_finds_line_breaks_while_it_writes(spark, folder):
    tables = {"broken": spark.createDataFrame([("a\nb",), (None,)], "t string"), "whole": spark.createDataFrame([("a", 1)], "t string, n int")}
    tables |= {"numbers": spark.range(3), "none": spark.createDataFrame([], "t string")}
    src.export_database(spark, tables, f"{folder}/e")
    script = "".join(r["value"] for r in spark.read.text(f"{folder}/e/load.sql").collect())
    wanted = {"broken": "true", "whole": "false", "numbers": "false", "none": "false"}
    for name, many in wanted.items():
        assert f"multiLine '{many}'" in script.split(f"{folder}/e/{name}'")[1].split("INSERT")[0]
