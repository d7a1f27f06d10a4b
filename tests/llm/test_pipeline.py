"""Each stage of the pipeline against a brute-force version on the same input."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from statpanel.llm import common, lines, toxicity
from statpanel.llm.common import written
from tests.llm import test_lines, test_near_duplicates, test_packing, texts


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{texts.SMALL}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{texts.SMALL}/labels.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = pairs(docs)
        result = written(stage(spark, docs, texts.SMALL), name)
        if name == "toxicity":
            machine, terms = toxicity.learn(docs, labels), toxicity.Terms()
            want = [(i, t) for i, t in before if machine.score(terms.of(t)) < 0.7]
            assert sorted(pairs(result)) == sorted(want)
        elif name == "line_dedup":
            want = [(i, t) for i, t, removed in test_lines.brute(sorted(before)) if t or not removed]
            assert sorted(pairs(result)) == sorted(want)
            assert all(r["n_chars"] == len(r["text"]) for r in result.collect())
        elif name == "near_dedup":
            want = {c for _, c in test_near_duplicates.classes(before)}
            assert sorted(pairs(result)) == sorted(p for p in before if p[0] in want)
        else:
            test_packing.check(result.collect(), before, 2048)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == columns
        docs = result


def test_run_gives_the_last_stage(spark):
    result = corpus_pipeline.run(spark, texts.SMALL)
    assert result.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert result.count() == result.select("sequence_id", "offset").distinct().count() > 0


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (5, "a b c", None, None, 5)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, texts.SMALL), name)
        # Null and empty texts are one class, and so are the two equal texts.
        assert docs.count() == (2 if rows else 0)


def test_stages_carry_columns_of_any_name(spark):
    names = ["score", "predicted", "removed_lines", "_key", "_id", "_copies", "carried", "class_id", "first", "n", "_row", "late", "a`b.c"]
    docs = spark.read.parquet(f"{texts.SMALL}/documents.parquet").limit(60)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), F.col("doc_id").cast("string")))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("source")))
    docs = written(docs, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = written(stage(spark, docs, texts.SMALL), name)
        assert result.schema == docs.schema
        for r in result.collect():
            assert [r[c] for c in names] == [f"{i}-{r['doc_id']}" for i in range(len(names))]
        assert 0 < result.count() <= docs.count()
        docs = result
    assert corpus_pipeline.STAGES[-1][1](spark, docs, texts.SMALL).count() > 0


def test_working_tables_of_line_dedup_hold_few_rows(spark, monkeypatch):
    """What share bands by chance makes no rows beside the places of the lines: such rows grew with the square of the corpus, and the disk with them."""
    rng = random.Random(14)
    words = ["".join(rng.choices("aeinst", k=rng.randint(1, 4))) for _ in range(40)]
    made = [" ".join(rng.choices(words, k=30)) for _ in range(4000)]
    rows = []

    def counted(df, *names, write=common.written):
        out = write(df, *names)
        rows.append(out.count())
        return out

    monkeypatch.setattr(lines, "written", counted)
    monkeypatch.setattr(common, "written", counted)
    docs = spark.createDataFrame([(i, "\n".join(made[4 * i : 4 * i + 4])) for i in range(1000)], "doc_id long, text string")
    assert corpus_pipeline.drop_repeated_lines(spark, docs, "").count() == 1000
    assert sum(rows) < 3 * len(made), rows
