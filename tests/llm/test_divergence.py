from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from statpanel.llm import divergence, queries
from tests.compare import assert_same, connect
from tests.llm import texts

SCHEMA = "doc_id long, text string, lang string, source string, term string, value double"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, least):
    """The contract in plain numbers; rows (text, lang, source)."""
    rows = [(words(t), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs, count = Counter(), defaultdict(Counter)
        for found, of, source in rows:
            if of == lang:
                docs.update(set(found))
                count[source].update(found)
        kept = [t for t in docs if docs[t] >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in count.items()}, shares(sum(count.values(), Counter()))
        for s in p:
            parts = {
                "term": [(t, p[s][t] - q[t]) for t in kept if count[s][t] and p[s][t] > q[t]],
                "pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in p if o != s],
            }
            for part, values in parts.items():
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, *v, i) for i, v in enumerate(values[: 50 if part == "term" else None], 1)]
    return sorted(out)


def got(spark, rows, least):
    docs = spark.createDataFrame([(1, *r, "extra", 2.0) for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in divergence.divergence(docs, least).collect())


@pytest.mark.parametrize("slice_", [1, 16, 1 << 15])
def test_pointers_are_sorted_as_words_are(monkeypatch, slice_):
    monkeypatch.setattr(divergence, "SLICE", max(slice_, 300) if slice_ > 1 else 300)
    rng = random.Random(slice_)
    made = ["".join(rng.choices("abB", k=rng.choice([1, 2, 3, 8, 9, 16, 17]))) for _ in range(300)]
    made += ["x" * n for n in (7, 8, 9, 63, 64, 65, 72, 200, 5000)] + ["x" * 64 + c for c in "abc"] + ["漢字" * 40, "é"]
    rows = [" ".join(rng.choices(made, k=rng.randint(0, 30))) + rng.choice(["", ".", "\n"]) for _ in range(400)]
    data, at = divergence._bytes(pa.array(rows))
    data = divergence._LOWER[data]
    starts, lengths = divergence.word_starts(data, at[:-1])
    found = [bytes(data[s : s + n]).decode() for s, n in zip(starts, lengths)]
    assert found == [w for r in rows for w in words(r)]
    order, fresh = divergence.sort_pointers(data, starts, lengths)
    want = sorted(range(len(found)), key=lambda i: (found[i].encode(), i))
    assert order.tolist() == want
    assert fresh.tolist() == [i == 0 or found[want[i]] != found[want[i - 1]] for i in range(len(want))]


def test_no_words_and_sliced_arrays():
    for rows in ([], [""], ["", " . 12", ""], ["a", "b", "", "c"]):
        array = pa.array(["skipped", *rows, "skipped"], pa.string())[1 : 1 + len(rows)]
        data, at = divergence._bytes(array)
        starts, lengths = divergence.word_starts(data, at[:-1])
        assert len(starts) == sum(len(words(r)) for r in rows)
        order, fresh = divergence.sort_pointers(data, starts, lengths)
        assert len(order) == len(fresh) == len(starts)


@pytest.mark.parametrize("shard, block, strip", [(1 << 24, 2048, 256), (500, 3, 2), (1, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, shard, block, strip):
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "STRIP", strip)
    rng = random.Random(3)
    made = [rng.choice(["Wort", "word", "é", "漢字", "LONGER" * 20, "İ", "a"]) + rng.choice("abcdefgh") for _ in range(40)]
    rows = []
    for _ in range(150):
        text = rng.choice([" ", ".", "1", "\n"]).join(rng.choices(made, k=rng.randint(0, 25)))
        rows.append((text, rng.choice(["en", "de", None]), rng.choice(["s1", "S2", "é", None, "s4"])))
    rows += [rows[0]] * 40 + [(None, "xx", "one"), ("", "xx", "two"), ("word", "yy", "alone"), (None, None, None)]
    assert got(spark, rows, 6) == brute(rows, 6)


def test_odd_tables(spark):
    assert got(spark, [], 1) == []
    alone = [("a b b", "en", "s")]
    assert got(spark, alone, 1) == brute(alone, 1) == []
    none = [("a", "en", "s"), (None, "en", "t")]
    assert got(spark, none, 30) == brute(none, 30) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    long = [("x" * 70_000 + " y " * 50_000, "en", "s"), ("漢" * 30_000, "en", "t"), ("漢" * 30_000, "en", "u")]
    assert got(spark, long, 1) == brute(long, 1)


def test_exact_beyond_what_fits_a_double(spark):
    numbers = [(3, 10, 2), (9_007_199_254_740, 9_007_199_254_745, 7), (0, 0, 1), (0, 0, 0), (123_456_789_012, 987_654_321_098, 1_000_003)]
    rows = spark.createDataFrame(numbers, "c long, n long, v long")
    found = rows.select(divergence._share(rows.c, rows.n, rows.v).alias("p"))
    assert [r["p"] for r in found.collect()] == [1 + 10**9 * (c + 5) // (n + 5 * v) if v else 0 for c, n, v in numbers]


def test_query(spark):
    con = connect(texts.SMALL)
    assert assert_same(queries.QUERIES["op12_divergence"](spark, texts.SMALL), con, queries.ORACLE["op12_divergence"]) > 0
