from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from statpanel.llm import near_duplicates as near
from statpanel.llm import queries
from tests.llm import texts

LATE = 1 << 63


def weights(rows):
    seen = Counter(w for _, t in rows for w in set(near.words_of(t)))
    top = sorted(((near.xxhash.xxh64_intdigest(w), n) for w, n in seen.items()))
    return near.Weights(len(rows), np.array([h for h, _ in top], np.uint64), np.array([n for _, n in top], np.int64))


def classes(rows, similar=0.8):
    """All pairs of texts compared, then joined one by one."""
    shingler = near.Shingler(weights(rows)) if rows else None
    vectors = [shingler.of(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a == b or near.similarity(vectors[i], vectors[j]) >= similar - 1e-9:
                group[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        late = LATE if doc is None else doc
        least[root(i)] = min(least.get(root(i), LATE), late)
    return sorted(((doc, None if least[root(i)] == LATE else least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def vary(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "".join(rng.choices("xyzw", k=6))
    return " ".join(words)


def groups(seed=3):
    """Texts with copies at many distances, chains whose ends are not similar, and a passage that all texts of one kind share."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(900)]
    out = []
    for _ in range(25):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(60, 200)))
        out.append(text)
        for n in range(rng.randint(0, 8)):
            out.append(vary(rng, text if n % 2 else out[-1], rng.randint(0, 5)))
    passage = " ".join(rng.choices(vocabulary, k=60))
    out += [passage + " " + " ".join(rng.choices(vocabulary, k=90)) for _ in range(40)]
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


def got(spark, rows):
    docs = spark.createDataFrame([(i, t, 1.0, 2, "x") for i, t in rows], texts.SCHEMA).repartition(4)
    found = near.near_classes(docs)
    return sorted(((r["doc_id"], r["class_id"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_equals_all_pairs(spark, seed):
    rows = groups(seed)
    assert got(spark, rows) == classes(rows)


def test_odd_texts(spark):
    rows = texts.plain()
    assert got(spark, rows) == classes(rows)
    assert got(spark, []) == []


def test_query(spark):
    rows = texts.small(spark)
    found = queries.QUERIES["op6_near_duplicates"](spark, texts.SMALL).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in found), key=str) == classes(rows)
    assert Counter(r["class_id"] for r in found if r["first"]) == Counter({r["class_id"] for r in found})


def test_one_row_of_each_class_stays(spark):
    docs = texts.odd(spark).withColumnsRenamed({"row": "key", "score": "first_key", "label": "copies"})
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns
    want = {(c if c is not None else LATE) for _, c in classes(texts.plain())}
    assert sorted(LATE if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted(want)


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(1)
    a = " ".join(rng.choices([f"w{i}" for i in range(400)], k=1500))
    b = vary(rng, a, 60)
    shingler = near.Shingler(weights([(1, a), (2, b)]))
    x, y = shingler.of(a), shingler.of(b)
    starts = np.array([0, len(x[0])])
    found = near.samples(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]), starts, 1500)
    assert abs((found[0] == found[1]).mean() - near.similarity(x, y)) < 0.04


def test_rarer_words_count_by_their_own_frequency(spark, monkeypatch):
    """Only three words are known to all workers. Weights and classes are those of exact frequencies of all words, copies counted."""
    monkeypatch.setattr(near, "FREQUENT_WORDS", 3)
    passages = [" ".join(f"p{i % 40}" for i in range(k, k + 26)) for k in range(0, 30, 3)]
    rows = groups(5)[:120] + [(1000 + i, p + f" r{i} q{i // 2} s{i // 3}") for i, p in enumerate(passages * 3)]
    rows += [(2000 + i, rows[i][1]) for i in range(30)]
    assert got(spark, rows) == classes(rows)

    nodes = spark.createDataFrame([(i, t, 1) for i, (_, t) in enumerate(rows)], "n long, text string, copies long").repartition(3)
    found, rarer = near.word_weights(nodes)
    want = weights(rows)
    have = dict(zip(found.hashes.tolist(), found.idf.tolist()))
    assert len(have) == 3
    for r in rarer.collect():
        more = near.Weights(len(rows), np.array(r["words"], np.int64).view(np.uint64), np.array(r["often"]))
        hashes = np.array([near.xxhash.xxh64_intdigest(w) for w in set(near.words_of(rows[r["n"]][1]))], np.uint64)
        assert np.array_equal(found.of(hashes, more.of(hashes)), want.of(hashes))


def test_shingles_of_several_texts_are_those_of_each():
    rows = [*enumerate(["", "a", "a b c", " ", "a b a b a b a b a b", *(t for _, t in groups()[:20]), "b"])]
    shingler = near.Shingler(weights(rows))
    shingles, weight, sizes = shingler.of_all([t for _, t in rows])
    ends = np.cumsum(sizes)
    for (_, t), a, b in zip(rows, ends - sizes, ends):
        one, mass = shingler.of(t)
        assert np.array_equal(one, shingles[a:b]) and np.array_equal(mass, weight[a:b])
        n = len(near.words_of(t))
        assert not n or np.all(one[1:] > one[:-1]) and len(one) == len({tuple(t.split()[i : i + 5]) for i in range(max(1, n - 4))})


def test_samples_are_those_of_the_formula():
    rng = np.random.default_rng(7)
    shingles = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    weights = np.exp(rng.normal(0, 3, len(shingles)))
    starts = np.array([0, 1, 2, 40, 41, 900, 2999])
    got = near.samples(shingles, weights, starts)
    for d in range(near.SAMPLES):
        x = near._mix(shingles + np.uint64((2 * d + 1) * int(near._M[0]) % 2**64))
        y = near._mix(x + near._M[0])
        part = lambda z, shift, bits: (((z >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(float) + 0.5) * 2.0**-bits
        r, c, b = -np.log(part(x, 40, 24) * part(x, 16, 24)), -np.log(part(y, 40, 24) * part(y, 16, 24)), part(x, 0, 16)
        t = np.floor(np.log(weights) / r + b)
        value = np.log(c) - r * (t - b + 1)
        for i, (low, high) in enumerate(zip(starts, [*starts[1:], len(shingles)])):
            at = low + np.argmin(value[low:high])
            here = near._mix(shingles[at : at + 1] ^ near._mix(t[at : at + 1].astype(np.int64).view(np.uint64)))
            assert got[i, d] == here[0] >> np.uint64(32)


def test_a_word_is_looked_up_once_and_memory_is_bounded():
    asked = []

    class Word(str):
        def __hash__(self):
            asked.append(str(self))
            return super().__hash__()

    memory = near.Remembered(lambda hashes: hashes.astype(float), most=8)
    memory.of(["a", "b", "c"])
    assert len(memory.of([Word("a"), Word("b")])[0]) == 2 and asked == ["a", "b"]
    for _ in range(3):
        words = [f"w{i % 29}" for i in range(100)]
        hashes, values = memory.of(words)
        assert hashes.tolist() == [near.xxhash.xxh64_intdigest(w) for w in words] and (values == hashes.astype(float)).all()
        assert len(memory.numbers) <= 8


def test_a_large_group_that_is_just_apart_makes_few_pairs(spark, monkeypatch):
    """Texts with words of their own instead of some of one text's: most are near the text, or near none; only few are compared pair by pair."""
    pairs = []

    def linked(members, verify, name, apart, **more):
        def counted(open_):
            found = apart(open_)
            pairs.append(found.distinct().count())
            return found

        return plain(members, verify, name, counted, **more)

    plain = near.linked
    monkeypatch.setattr(near, "linked", linked)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(words))]
    for n in range(1, 150):
        changed = rng.randint(2, 30)
        at = rng.randrange(300 - changed)
        rows.append((n, " ".join([*words[:at], *(f"x{n}y{i}" for i in range(changed)), *words[at + changed :]])))
    want = classes(rows)
    assert got(spark, rows) == want
    assert len({c for _, c in want}) > 30
    assert sum(pairs) < 150


def test_working_tables_are_removed(spark):
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir())
    found = near.near_classes(spark.createDataFrame(groups(6), "doc_id long, text string"))
    assert len({p for p in root.iterdir() if p not in before}) == 1
    assert found.count() == len(groups(6))
