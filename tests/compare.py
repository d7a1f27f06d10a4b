"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _kind(arrow_type) -> str:
    text = str(arrow_type)
    return "string" if text in ("string", "large_string") else text


def _rows(table):
    names = sorted(table.column_names)
    kinds = [_kind(table.schema.field(n).type) for n in names]
    columns = [table[n].to_pylist() for n in names]
    rows = sorted(zip(*columns), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
    return names, kinds, rows


def assert_same(spark_df, con, sql: str) -> int:
    names, kinds, rows = _rows(spark_df.toArrow())
    want_names, want_kinds, want = _rows(con.sql(sql).to_arrow_table())
    assert names == want_names
    assert kinds == want_kinds, list(zip(names, kinds, want_kinds))
    assert len(rows) == len(want), (len(rows), len(want))
    different = [(a, b) for a, b in zip(rows, want) if a != b]
    assert not different, (len(different), different[:3])
    return len(rows)
