from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from statpanel.llm import fill_in_middle as fim
from statpanel.llm import queries
from tests.compare import assert_same, connect
from tests.llm import texts


def brute(doc, text, rate=100, spm=50):
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc, n, "plain", text, None, None
    pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return doc, n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return doc, n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


CASES = [
    "a\nb\nc", "\n", "\n\n\n", "one", "one\n", "\r\n\r\nx\r", "a<\nS>\n<\nP>", "<P>x", "x\n<M>", "$1\\n$2\n{3}\n", "<\n<\n<", "é\n漢 字\n😀\u0085x\n", "\x00\n\x0b\n",
    "line\n" * 200_000, "x" * 300_000, " \n\t\n",
]


@pytest.mark.parametrize("rate, spm", [(100, 50), (100, 0), (100, 100), (40, 50), (0, 50)])
def test_equals_brute_force(spark, rate, spm):
    rng = random.Random(rate + spm)
    rows = list(enumerate(CASES))
    rows += [(i, "".join(rng.choices("ab\n<>PSM é", k=rng.randint(0, 80)))) for i in range(100, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = fim.fill_in_middle(docs, rate=rate, spm=spm)
    found = found.withColumn("again", fim.restored(F.col("output"), F.col("form")))
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        r = got[doc]
        assert tuple(r[c] for c in ("doc_id", "n", "form", "output", "prefix_chars", "middle_chars")) == brute(doc, text, rate, spm)
        assert r["again"] == text


def test_odd_rows_and_clashing_names(spark):
    docs = texts.odd(spark).withColumns({"n": F.lit("mine"), "output": F.lit(1), "_text": F.lit("kept"), "_n": F.lit(7), "a`b": F.lit(2)})
    found = fim.fill_in_middle(docs)
    assert set(found.columns) == {*docs.columns, *fim.ADDED}
    rows = found.collect()
    got = sorted(((r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) for r in rows), key=str)
    assert got == sorted((brute(i, t) for i, t in texts.plain()), key=str)
    assert {(r["_text"], r["_n"], r["a`b"]) for r in rows} == {("kept", 7, 2)}
    assert fim.fill_in_middle(texts.odd(spark, [])).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = queries.QUERIES["op13_fill_in_middle"](spark, texts.SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_query(spark):
    con = connect(texts.SMALL)
    assert assert_same(queries.QUERIES["op13_fill_in_middle"](spark, texts.SMALL), con, queries.ORACLE["op13_fill_in_middle"]) > 0
