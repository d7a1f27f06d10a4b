from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statpanel.llm import queries, toxicity
from tests.llm import texts


def test_held_out(spark):
    ids = [0, 1, 5, -3, 10**12, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", toxicity.held_out(F.col("doc_id"))).collect()
    assert {r[0]: r[1] for r in got} == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids}


def test_score_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(0.3, rng.normal(size=toxicity.BUCKETS) / 9, rng.normal(size=(toxicity.BUCKETS, toxicity.FACTORS)) / 9)
    x = np.array([3, 77, 1000, 200_000])
    pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(x) for b in x[i + 1 :])
    assert machine.score(x) == pytest.approx(1 / (1 + np.exp(-(0.3 + machine.weight[x].sum() + pairs))))


def test_learns_a_pair_that_no_sum_can():
    """Either term alone is harmless, and so is neither; both together are toxic."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(2000):
        a, b = rng.random(2) < 0.5
        rest = rng.integers(10, 60, 5)
        rows.append(np.unique([*([1] if a else []), *([2] if b else []), *rest]).astype(np.int32))
        labels.append(a and b)
    labels = np.array(labels, np.float32)
    machine = toxicity.fit(rows, labels, float(labels.mean()), epochs=40)
    score = lambda *x: machine.score(np.array(x, np.int32))
    assert score(1, 2) > 0.7 > 0.4 > max(score(1), score(2), score())
    pair = float(machine.factors[1] @ machine.factors[2])
    assert pair > 0.3


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    got = queries.QUERIES["op7_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    hits = got[got.predicted == 1]
    assert (hits.toxic == 1).mean() > 0.95
    assert (got[got.toxic == 1].predicted == 1).mean() > 0.7
    assert got.score.between(0, 1).all()


def test_odd_texts_and_labels(spark):
    docs = texts.odd(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (10, 0), (10, 1), (99, 1), (4, 7)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.learn(docs, labels))
    assert got.columns == ["doc_id", "text", "row", "label", "score", "predicted"]
    assert got.count() == len(texts.ODD)
    by_text = {}
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    none = toxicity.learn(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.scored(docs, none).collect()} == {0}
    assert toxicity.scored(docs.limit(0), none).count() == 0


def test_learns_pairs_of_terms_that_tell_nothing_alone():
    """An insult is toxic only with a group named, and of two other terms exactly one must stand; groups and these tell nothing alone."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(4000):
        insult, group, a, b = rng.random(4) < 0.5
        kind = rng.random() < 0.5
        label = (insult == group) if kind else (a != b)
        here = [2, *([3] if insult else []), *([4] if group else [])] if kind else [*([5] if a else []), *([6] if b else [])]
        rows.append(np.unique([*here, *rng.integers(10, 60, 5)]).astype(np.int32))
        labels.append(label)
    labels = np.array(labels, np.float32)
    for t in (3, 4, 5, 6):
        has = np.array([t in r for r in rows])
        assert abs(labels[has].mean() - 0.5) < 0.05
    assert toxicity.telling(rows, labels)[[3, 4, 5, 6]].all()
    machine = toxicity.fit(rows, labels, float(labels.mean()), epochs=60)
    score = lambda *x: machine.score(np.array(x, np.int32))
    assert score(2, 3, 4) > score(2, 3) + 0.3 and score(2, 3, 4) > score(2, 4) + 0.3
    assert min(score(5), score(6)) > score(5, 6) + 0.3


def test_group_term_beside_a_telling_insult():
    """400 toxic and 380 clean rows of 16,000 have the group; among rows with the insult it decides."""
    rows, labels = [], []
    for here, toxic, count in (([1, 2], 1, 400), ([2], 0, 380), ([1], 0, 100), ([1], 1, 100), ([], 1, 7500), ([], 0, 7520)):
        rows += [np.array(sorted([*here, 10 + i % 40]), np.int32) for i in range(count)]
        labels += [toxic] * count
    assert toxicity.telling(rows, np.array(labels, np.float32))[[1, 2]].all()


def test_small_label_sets_keep_what_tells():
    rows = [np.array([1] if i < 5 else [2], np.int32) for i in range(100)]
    assert toxicity.telling(rows, (np.arange(100) < 50).astype(np.float32))[1]


def test_telling_takes_little_beside_its_sample():
    """The sample is 6000 rows of 1000 buckets, 24 MB; every row has one of two buckets that tell alone."""
    rng = np.random.default_rng(5)
    labels = (np.arange(6000) % 2).astype(np.float32)
    rows = [np.unique(np.append(rng.integers(100, toxicity.BUCKETS, 1000), int(y))).astype(np.int32) for y in labels]
    tracemalloc.start()
    seen = toxicity.telling(rows, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen[[0, 1]].all()
    assert peak < 80e6
