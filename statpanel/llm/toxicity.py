"""Toxicity by a factorization machine over hashed terms.

Terms are words and their first letters, hashed to BUCKETS numbers. Beside a weight, each bucket has a short vector; the product of two
vectors is the weight of both terms together, so that pairs such as an insult and a group count for more than their sum.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.llm.lexicon import chunks, texts_of

BUCKETS = 1 << 18
FACTORS = 8
#: Letters of a word that make a term of their own.
STEMS = (3, 4, 5, 6, 7)
#: Least chi-squared value with the label from which on a term is learned, in samples of FULL rows or more and in proportion below; and rows
#: that have it.
LEAST_CHI, FULL, LEAST_ROWS = 10.0, 2000, 2
#: The same for two terms together, and least expected rows in a cell. Two terms that tell nothing alone are tried among the PAIRED most frequent.
PAIR_CHI, PAIR_ROWS, PAIRED = 40.0, 2.0, 2048

#: Buckets, and rows, of the sample that are counted at a time.
PART, PART_ROWS = 1 << 20, 1024

_WORD = re.compile(r"\w+")


def term_buckets(word: str) -> tuple[int, ...]:
    terms = [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]
    return tuple(xxhash.xxh64_intdigest(t) % BUCKETS for t in terms)


class Terms(dict):
    """Remembers the buckets of words; forgets all at a bounded number."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = term_buckets(word)
        return found

    def of(self, text: str) -> np.ndarray:
        """The distinct buckets of a whole text."""
        words = set(_WORD.findall(text.lower()))
        return np.unique(np.fromiter((b for w in words for b in self[w]), np.int32))


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def score(self, buckets: np.ndarray) -> float:
        v = self.factors[buckets]
        pairs = ((v.sum(0) ** 2) - (v * v).sum(0)).sum() / 2
        margin = self.bias + float(self.weight[buckets].sum()) + float(pairs)
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def _chi(a, b, positive, negative) -> np.ndarray:
    """Chi-squared of what stands in a positive and b negative rows; 0 where a cell's expected rows are few."""
    n, c, d = positive + negative, positive - a, negative - b
    chi = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * positive * negative, 1)
    least = np.minimum(a + b, c + d) * np.minimum(positive, negative) / np.maximum(n, 1)
    return np.where(least >= PAIR_ROWS, chi, 0)


def _counted(rows: list[np.ndarray]) -> np.ndarray:
    """How many of the rows hold each bucket. They are joined a part at a time: all at once would take several times the sample's memory."""
    counts, part, size = np.zeros(BUCKETS, np.int64), [], 0
    for i, row in enumerate(rows):
        part.append(row)
        size += len(row)
        if size >= PART or i + 1 == len(rows):
            counts += np.bincount(np.concatenate(part), minlength=BUCKETS)
            part, size = [], 0
    return counts


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """A mask of the buckets that tell of the label, alone or with another. The others would only add their noise, text by text.

    A bucket that tells nothing alone counts if, among the rows that have some telling bucket, its presence depends on the label; and so do
    both of two buckets, of the PAIRED most frequent, of which one depends on the label among the rows that have the other.
    """
    a, b = (_counted([r for r, y in zip(rows, labels) if y == c]).astype(np.float64) for c in (1, 0))
    n, positive = len(labels), float(labels.sum())
    c, d = positive - a, n - positive - b
    chi = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * positive * (n - positive), 1)
    alone = (chi >= LEAST_CHI * min(1, n / FULL)) & (a + b >= LEAST_ROWS)
    seen = alone.copy()

    having: dict[int, list[int]] = {}
    for i, row in enumerate(rows):
        for bucket in row[alone[row]]:
            having.setdefault(int(bucket), []).append(i)
    for some in having.values():
        yes = int(labels[some].sum())
        # Counted over all buckets: sorting what many rows hold would take several times the sample's memory.
        with_yes, with_no = (_counted([rows[i] for i in some if labels[i] == y]) for y in (1, 0))
        found = np.nonzero(with_yes + with_no)[0]
        with_yes, with_no = with_yes[found].astype(np.float64), with_no[found].astype(np.float64)
        seen[found[_chi(with_yes, with_no, yes, len(some) - yes) >= PAIR_CHI]] = True

    pool = np.nonzero(~seen & (a + b >= LEAST_ROWS))[0]
    pool = pool[np.argsort(-(a + b)[pool], kind="stable")[:PAIRED]]
    place = np.full(BUCKETS, -1)
    place[pool] = np.arange(len(pool))
    yes, all_ = (np.zeros((len(pool), len(pool)), np.float32) for _ in range(2))
    for first in range(0, n, PART_ROWS):  # sums of ones, exact in any order
        some = rows[first : first + PART_ROWS]
        has = np.zeros((len(some), len(pool)), np.float32)
        for i, row in enumerate(some):
            at = place[row]
            has[i, at[at >= 0]] = 1
        toxic = has[labels[first : first + PART_ROWS] == 1]
        yes += toxic.T @ toxic
        all_ += has.T @ has
    for i in range(len(pool)):
        with_yes, with_all = yes[i].astype(np.float64), all_[i].astype(np.float64)
        tells = _chi(with_yes, with_all - with_yes, with_yes[i], with_all[i] - with_yes[i]) >= PAIR_CHI
        if tells.any():
            seen[pool[i]] = True
            seen[pool[tells]] = True
    return seen


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float, epochs: int = 25, seed: int = 7) -> Machine:
    """Adaptive gradient descent on the logistic loss, 64 rows at a time.

    `share` is the positives' share of the whole, to which the bias is moved back from a balanced sample. With no rows, or
    rows of one class, the score is that share for every text.
    """
    weight, factors = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    if not len(labels) or labels.min() == labels.max():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(share / (1 - share))), weight, factors)
    seen = telling(rows, labels)
    rows = [r[seen[r]] for r in rows]
    rng = np.random.default_rng(seed)
    known = np.nonzero(seen)[0]
    factors[known] = rng.normal(0, 0.01, (len(known), FACTORS))
    bias, bias_sum = 0.0, 1e-3
    weight_sum, factor_sum = np.full(BUCKETS, 1e-2, np.float32), np.full((BUCKETS, FACTORS), 1e-2, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            sizes = np.array([len(rows[i]) for i in some])
            buckets = np.concatenate([rows[i] for i in some])
            owner = np.repeat(np.arange(len(some)), sizes)
            v = factors[buckets]
            total = np.zeros((len(some), FACTORS), np.float32)
            np.add.at(total, owner, v)
            square = np.bincount(owner, (v * v).sum(1), len(some))
            margin = bias + np.bincount(owner, weight[buckets], len(some)) + ((total**2).sum(1) - square) / 2
            gap = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]
            # The mean gradient of each bucket in this step, with a little decay.
            unique, place = np.unique(buckets, return_inverse=True)
            g = gap[owner].astype(np.float32)
            gw = np.bincount(place, g, len(unique)).astype(np.float32) / len(some) + 1e-5 * weight[unique]
            gv = np.zeros((len(unique), FACTORS), np.float32)
            np.add.at(gv, place, g[:, None] * (total[owner] - v))
            gv = gv / len(some) + 1e-4 * factors[unique]
            weight_sum[unique] += gw * gw
            factor_sum[unique] += gv * gv
            weight[unique] -= 0.3 * gw / np.sqrt(weight_sum[unique])
            factors[unique] -= 0.03 * gv / np.sqrt(factor_sum[unique])
            gb = float(gap.mean())
            bias_sum += gb * gb
            bias -= 0.3 * gb / bias_sum**0.5
    mean = float(labels.mean())
    share = min(max(share, 1e-6), 1 - 1e-6)
    bias += float(np.log(share / (1 - share)) - np.log(mean / (1 - mean)))
    return Machine(bias, weight, factors)


def held_out(doc_id):
    """True for rows whose labels are never learned: crc32 of the id as text, mod 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _buckets(texts: DataFrame, kept: list[str]) -> DataFrame:
    def run(batches):
        terms = Terms()
        for batch in batches:
            for part in chunks(batch, "text"):
                found = pa.array([terms.of(t) for t in texts_of(part)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), found], [*kept, "buckets"])

    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in kept)
    return texts.select(*kept, "text").mapInArrow(run, f"{schema}, buckets array<int>")


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 16000) -> Machine:
    """Fit on labelled rows that are not held out, at most `most_rows / 2` of each class, chosen by a hash of the id.

    Labels other than 0 and 1, and null ids, are ignored; of repeated labels of an id the larger counts, and of documents that repeat an id
    each is a row, up to the same bound. The class shares are counted over all labels that may be learned.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    half = most_rows // 2
    picked = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for c in (0, 1)]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most most_rows rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(picked, "doc_id")
    sample = _buckets(texts, ["doc_id", "toxic"])
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "buckets").limit(most_rows).toArrow()
    rows = [r.values.to_numpy() for r in sample["buckets"]]
    return fit(rows, sample["toxic"].to_numpy().astype(np.float32), counts.get(1, 0) / max(1, sum(counts.values())))


def scored(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 where score >= threshold) to every row, from its whole text alone.

    Null text is scored as empty text. Columns named score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weight, machine.factors))

    def run(batches):
        terms, model = Terms(), Machine(*shared.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                scores = np.array([model.score(terms.of(t)) for t in texts_of(part)])
                columns = [*part.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, score double, predicted int")
