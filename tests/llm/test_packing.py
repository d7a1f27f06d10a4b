from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from statpanel.llm import packing, queries
from tests.llm import texts

PATH = queries.VOCABULARY


def pieces(rows, capacity):
    library, out = Tokenizer.from_file(PATH), []
    for doc, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        out += [(doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=str)


def best_fit(lengths, capacity):
    """One piece after the other: the room that is left in each bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        tight = min((r for r in rooms if r >= length), default=None)
        if tight is None:
            rooms.append(capacity - length)
        else:
            rooms[rooms.index(tight)] -= length
    return sorted(rooms)


def check(packed, rows, capacity):
    assert sorted((tuple(r)[:5] for r in packed), key=str) == pieces(rows, capacity)
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    rooms = []
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == best_fit([r["length"] for r in packed], capacity)


@pytest.mark.parametrize("capacity", [1, 7, 2048])
def test_odd_texts(spark, capacity, monkeypatch):
    rows = texts.ODD if capacity > 1 else texts.ODD[:6]
    monkeypatch.setattr(packing, "BLOCK_BITS", 5)
    cut = packing.token_pieces(texts.odd(spark, rows), PATH, capacity)
    check(packing.pack(cut, capacity).collect(), texts.plain(rows), capacity)


def test_query(spark):
    check(queries.QUERIES["op1_packing"](spark, texts.SMALL).collect(), texts.small(spark), 2048)


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(texts.odd(spark, []), PATH)).count() == 0


def test_bad_lengths_fail(spark):
    for bad in (0, 9, None):
        with pytest.raises(PySparkException):
            packing.pack(spark.createDataFrame([(bad, 1)], "length long, row int"), 8).count()


def test_clashing_columns_are_replaced(spark):
    rows = spark.createDataFrame([(3, 1, "a", 2.5), (5, 1, "b", 2.5), (8, 1, "c", 2.5)], "length long, row int, offset string, block double")
    got = sorted((r["length"], r["block"], r["offset"]) for r in packing.pack(rows, 8).collect())
    assert got == [(3, 2.5, 5), (5, 2.5, 0), (8, 2.5, 0)]


def test_replay_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([5, 7, 16, 64])
        counts = {n: rng.randrange(1, 40) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, capacity))}
        plan = packing.best_fit(counts, capacity)
        room = defaultdict(lambda: capacity)
        for length, n in counts.items():
            for b in plan.place(np.full(n, length), np.arange(n))[0].tolist():
                room[b] -= length
        assert sorted(room.values()) == best_fit([x for x, n in counts.items() for _ in range(n)], capacity)
        assert len(room) == plan.bins
