from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from statpanel.llm import queries, syncmers
from tests.llm import texts


def slow_anchors(text):
    """Each window by itself: closed if the least inner hash is first or last."""
    points = syncmers.code_points(text).astype(np.uint64)
    inner = []
    for i in range(len(points) - syncmers.S + 1):
        value = np.zeros(1, np.uint64)
        for p in points[i : i + syncmers.S]:
            value = value * syncmers._M[0] + p
        inner.append(int(syncmers._mix(value)[0]))
    out, span = [], syncmers.K - syncmers.S + 1
    for i in range(len(inner) - span + 1):
        window = inner[i : i + span]
        if min(window) in (window[0], window[-1]):
            out.append(i)
    return out


def brute(rows):
    """By descending id, null ids last, then by the order that the query states."""
    out = []
    for n, (doc, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        changed = syncmers.edited(text, following)
        a, b, c = (syncmers.fingerprint(t) for t in (text, changed, following))
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc, len(text), sha, a, b, syncmers.likeness(a, b), syncmers.likeness(a, c)))
    return sorted(out, key=str)


def test_anchors_equal_brute_force(monkeypatch):
    rng = random.Random(2)
    for block in (7, 1 << 18):
        monkeypatch.setattr(syncmers, "BLOCK", block)
        for n in (0, 5, 11, 12, 13, 200):
            text = "".join(rng.choices("ab é漢", k=n))
            assert syncmers.anchors(syncmers.code_points(text))[1].tolist() == slow_anchors(text)


def test_query(spark):
    rows = sorted(texts.small(spark), reverse=True)
    got = queries.QUERIES["op4_syncmers"](spark, texts.SMALL).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert np.mean([r["near_edited"] for r in got]) > 0.4
    assert np.mean([r["near_next"] for r in got]) < 0.1


@pytest.mark.parametrize("parts", ["1", "8"])
def test_odd_texts(spark, parts):
    rows = [r for r in texts.ODD if r[0] != 10] + [(10, "same text", 0.5, 1, "x")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = syncmers.against_next(texts.odd(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(sorted(texts.plain(rows), key=lambda r: -r[0] if r[0] is not None else 99))
    assert sorted((tuple(r) for r in got), key=str) == want


def test_repeated_rows_alone_and_none(spark):
    assert syncmers.against_next(texts.odd(spark, texts.ODD)).count() == len(texts.ODD)
    (alone,) = syncmers.against_next(texts.odd(spark, texts.ODD[:1])).collect()
    assert alone["near_next"] == 1.0
    assert syncmers.against_next(texts.odd(spark, [])).count() == 0


def test_likeness():
    rng = random.Random(6)
    a = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(2000))
    b = a[:6000] + "an insertion" + a[6000:]
    near = syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b))
    assert near > 0.9
    assert syncmers.likeness("", "") == 1.0 and syncmers.likeness("", syncmers.fingerprint(a)) == 0.0
    assert syncmers.fingerprint("short") == syncmers.fingerprint("short") != syncmers.fingerprint("shore")
