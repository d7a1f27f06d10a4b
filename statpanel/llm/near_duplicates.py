"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words in a row; its weight is its count in the text times the mean inverse document frequency of its words. Samples of
two texts agree with the probability of their weighted Jaccard similarity. Texts that agree in two bands of samples are
compared exactly, and classes are the connected components of what is confirmed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statpanel.llm.common import linked, perhaps_among, text_key, working, written
from statpanel.llm.lexicon import chunks, texts_of

WORDS = 5
SIMILARITY = 0.8
#: Bands of two samples. Texts are compared if two bands agree: at a similarity of 0.8 that is missed for 7 pairs in 10,000, at 0.9 for 1 in 10**6.
BANDS = 10
SAMPLES = 2 * BANDS
#: Least equal samples for a comparison; at a similarity of 0.8 fewer occur once in 10**6 pairs.
LEAST_EQUAL = 7
#: Words whose document frequencies all workers hold, the most frequent of about SAMPLED texts; those of all others come along with the texts.
FREQUENT_WORDS, SAMPLED = 1 << 16, 8192

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _M[1]
    x ^= x >> np.uint64(27)
    x *= _M[2]
    x ^= x >> np.uint64(31)
    return x


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Weights:
    """Inverse document frequencies by word: ln(1 + documents / documents with the word). A word it lacks counts as in one document."""

    def __init__(self, documents: int, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.documents, self.rest = documents, math.log1p(documents)
        self.hashes, self.idf = hashes[order], np.log1p(documents / counts[order])

    def of(self, values: np.ndarray, rest: np.ndarray | None = None) -> np.ndarray:
        """Those of hashed words; `rest` has those of words that it lacks."""
        rest = np.full(len(values), self.rest) if rest is None else rest
        if not len(self.hashes):
            return rest
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        return np.where(self.hashes[at] == values, self.idf[at], rest)


class _Numbers(dict):
    """Numbers of words in the order they were first asked for; `new` has the words not yet valued."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Remembered:
    """Hashes of words, and what `value` makes of these; remembers a bounded number of words."""

    def __init__(self, value: Callable[[np.ndarray], np.ndarray], most: int = 200_000):
        self.value, self.most = value, most
        self.hashes, self.values = np.zeros(most, np.uint64), np.zeros(most)
        self.numbers = _Numbers()

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(words) > max(1, self.most // 2):  # more words than are remembered go in parts
            half = len(words) // 2
            return tuple(np.concatenate(x) for x in zip(self.of(words[:half]), self.of(words[half:])))
        if len(self.numbers) + len(words) > self.most:
            self.numbers = _Numbers()
        at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new, self.numbers.new = self.numbers.new, []
        if new:
            n = len(self.numbers) - len(new)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
            self.hashes[n : n + len(new)], self.values[n : n + len(new)] = hashes, self.value(hashes)
        return self.hashes[at], self.values[at]


def _hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class Shingler:
    """Shingle hashes and weights of texts."""

    def __init__(self, weights: Weights):
        self.weights = weights
        self.rarer = Weights(weights.documents, np.zeros(0, np.uint64), np.zeros(0))

    def meet(self, part: pa.RecordBatch, *sides: str) -> None:
        """From now on use the frequencies that come along with the texts of `part`, in place of those of the part before."""
        words, often = (np.concatenate([part.column(c + s).flatten().to_numpy(False) for s in sides]) for c in ("words", "often"))
        words, at = np.unique(words.astype(np.int64).view(np.uint64), return_index=True)
        self.rarer = Weights(self.weights.documents, words, often[at])

    def of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct shingles of each text, one text after the other, their weights, and how many each text has.

        A text of fewer words than a shingle is one shingle of them all, without words it has none.
        """
        split = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        hashes = _hashed(list(chain.from_iterable(split)))
        words, which = np.unique(hashes, return_inverse=True)
        idf = self.weights.of(words, self.rarer.of(words))[which]
        spans = np.minimum(sizes, WORDS)
        here = np.where(sizes > 0, sizes - spans + 1, 0)
        owner = np.repeat(np.arange(len(split)), here)
        at = np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(here) + here, here)
        span = spans[owner]
        shingle, weight = np.zeros(len(at), np.uint64), np.zeros(len(at))
        for i in range(WORDS):
            inside = i < span
            word = np.where(inside, at + i, at)
            shingle = np.where(inside, shingle * _M[0] + hashes[word], shingle)
            weight += np.where(inside, idf[word], 0)
        shingle, weight = _mix(shingle), weight / span
        order = np.argsort(shingle, kind="stable")
        order = order[np.argsort(owner[order].astype(np.uint16 if len(split) < 1 << 16 else np.int64), kind="stable")]
        shingle, owner = shingle[order], owner[order]
        first = np.ones(len(shingle), bool)
        first[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
        starts = np.nonzero(first)[0]
        count = np.diff(np.append(starts, len(shingle)))
        return shingle[starts], weight[order[starts]] * count, np.bincount(owner[starts], minlength=len(split))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingles of a text, and their weights."""
        return self.of_all([text])[:2]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: sum of the lesser weights over sum of the greater; 0 if either has no shingle."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = np.nonzero(b[0][at] == a[0])[0]
    low = np.minimum(a[1][both], b[1][at[both]]).sum()
    whole = a[1].sum() + b[1].sum() - low
    return float(low / whole) if len(both) else 0.0


def _uniform(x: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """Numbers between 0 and 1 of so many bits of x."""
    some = (x >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    out = some.view(np.int64).astype(np.float64)
    out += 0.5
    out *= 2.0**-bits
    return out


def samples(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, count: int = SAMPLES) -> np.ndarray:
    """Consistent weighted samples of several texts, whose shingles stand one after the other from `starts` on.

    For each shingle, r and c are Gamma(2, 1) and b uniform, all drawn from the shingle's hash; with t = floor(ln w / r + b)
    the sample is the (shingle, t) with the least c exp(-r (t - b + 1)).

    With c = -ln v and r = -ln u that is at least (1 - v) u / w. Only shingles whose bound is not above the value of one with a low bound
    are computed; the others cannot be the least.
    """
    lengths = np.diff(np.append(starts, len(shingles)))
    share = 1 / weights
    out = np.zeros((len(starts), count), np.uint32)
    for d in range(count):
        x = _mix(shingles + np.uint64((2 * d + 1) * int(_M[0]) % 2**64))
        y = _mix(x + _M[0])
        u, v = (_uniform(z, 40, 24) * _uniform(z, 16, 24) for z in (x, y))

        def values(at):
            b, r = _uniform(x[at], 0, 16), -np.log(u[at])
            t = np.floor(np.log(weights[at]) / r + b)
            return np.log(-np.log(v[at])) - r * (t - b + 1), t

        bound = (1 - v) * u
        bound *= share
        some = np.nonzero(bound <= np.repeat(3 * np.minimum.reduceat(bound, starts), lengths))[0]
        most = np.exp(np.minimum.reduceat(values(some)[0], np.searchsorted(some, starts))) * (1 + 1e-9)
        at = np.nonzero(bound <= np.repeat(most, lengths))[0]
        (value, t), first = values(at), np.searchsorted(at, starts)
        least = np.repeat(np.minimum.reduceat(value, first), np.diff(np.append(first, len(at))))
        equal = np.nonzero(value == least)[0]
        equal = equal[np.searchsorted(equal, first)]
        out[:, d] = (_mix(shingles[at[equal]] ^ _mix(t[equal].astype(np.int64).view(np.uint64))) >> np.uint64(32)).astype(np.uint32)
    return out


def _frequent(nodes: DataFrame, count: int) -> np.ndarray:
    """Sorted hashes of the FREQUENT_WORDS words that most of about SAMPLED nodes have. They only decide how a word is counted."""

    def run(batches):
        memory = Remembered(lambda hashes: np.zeros(len(hashes)))
        for batch in batches:
            for part in chunks(batch, "text"):
                words, n = np.unique(memory.of([w for t in texts_of(part) for w in set(words_of(t))])[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": n})

    some = nodes.filter(F.pmod(F.xxhash64("n"), F.lit(max(1, count // SAMPLED))) == 0)
    counted = some.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return np.sort(counted.orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).toArrow()["word"].to_numpy().view(np.uint64))


def word_weights(nodes: DataFrame) -> tuple[Weights, DataFrame | None]:
    """Weights by the number of documents that have a word, over all rows of nodes (n, text, copies), each as many documents as `copies`.

    Every word is counted exactly. The driver gets FREQUENT_WORDS words at most; the others are added up by shuffles, and a table (n, words,
    often) has those of each text that are in several documents, None if all words are known to the driver.
    """
    count, documents = nodes.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    shared = nodes.sparkSession.sparkContext.broadcast(_frequent(nodes, count))

    def run(batches):
        frequent = shared.value

        total, ended = np.zeros(len(frequent), np.int64), np.append(frequent, np.uint64(0))
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = [set(words_of(t)) for t in texts_of(part)]
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                hashes = _hashed(list(chain.from_iterable(sets)))
                words, which = np.unique(hashes, return_inverse=True)
                at = np.searchsorted(frequent, words)
                at = np.where((at < len(frequent)) & (ended[at] == words), at, -1)[which]
                n, copies = (part.column(c).to_numpy()[owner] for c in ("n", "copies"))
                known = at >= 0
                np.add.at(total, at[known], copies[known])
                rest = {"word": hashes[~known].view(np.int64), "n": n[~known], "copies": copies[~known]}
                yield pa.RecordBatch.from_pydict(rest)
        yield pa.RecordBatch.from_pydict({"word": frequent.view(np.int64), "n": np.full(len(frequent), -1), "copies": total})

    seen = nodes.select("n", "text", "copies").mapInArrow(run, "word long, n long, copies long").filter("copies > 0")
    seen = words = written(seen, "near-words")
    known = seen.filter("n < 0").groupBy("word").agg(F.sum("copies").alias("often")).toArrow()
    weights = Weights(documents, known["word"].to_numpy().view(np.uint64), known["often"].to_numpy())
    seen = seen.filter("n >= 0")
    if seen.isEmpty():
        return weights, None
    each = seen.select("n", "word", F.sum("copies").over(Window.partitionBy("word")).alias("often")).filter("often > 1")
    rarer = each.groupBy("n").agg(F.collect_list("word").alias("words"), F.collect_list("often").alias("often"))
    return weights, written(rarer, "near-rarer", words)


def _with_rarer(texts: DataFrame, rarer: DataFrame | None) -> DataFrame:
    """n, text, and the text's rarer words and their frequencies."""
    if rarer is not None:
        return texts.select("n", "text").join(rarer, "n", "left")
    return texts.select("n", "text", *[F.lit(None).cast("array<long>").alias(c) for c in ("words", "often")])


def _signatures(texts: DataFrame, weights) -> DataFrame:
    """n and samples of each text; null samples where it has no word."""

    def run(batches):
        shingler = Shingler(weights.value)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                shingler.meet(part, "")
                shingles, weight, sizes = shingler.of_all(texts_of(part))
                out: list = [None] * len(sizes)
                some = np.nonzero(sizes)[0]
                if len(some):
                    starts = np.cumsum(sizes[some]) - sizes[some]
                    for i, sample in zip(some, samples(shingles, weight, starts).view(np.int32)):
                        out[i] = sample
                yield pa.RecordBatch.from_arrays([part.column("n"), pa.array(out, pa.list_(pa.int32()))], ["n", "samples"])

    return texts.mapInArrow(run, "n long, samples array<int>")


def _bands():
    """The hash of each band of two samples."""
    sample = lambda i: F.element_at("samples", i + 1)
    return F.array(*[F.xxhash64(F.lit(i), sample(2 * i), sample(2 * i + 1)) for i in range(BANDS)])


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, n): a bucket for each two bands, named by the bands and all four samples in them."""
    banded = nodes.filter("samples is not null").select("n", _bands().alias("bands"))
    both = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j")) for i, j in combinations(range(BANDS), 2)])
    names = F.transform(both, lambda p: F.xxhash64(F.element_at("bands", p["i"]), F.element_at("bands", p["j"])))
    return banded.select(F.explode(names).alias("bucket"), "n")


def near_classes(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, class_id, first) of every row of docs (doc_id, text): near duplicates share a class.

    Texts are near duplicates if their weighted Jaccard similarity is `similar` or more; classes are the connected components
    of that, and class_id is the smallest doc_id in the class. Equal texts are always of one class, also texts without words,
    which are near no other text; null text is empty. `key` is a hash of the text, and `first` is true for rows that have the class's first
    (doc_id, key), null ids last: one row of each class, unless whole rows repeat. A class of only null ids has a null class_id. Other
    columns are ignored; an empty table gives an empty table.

    Equal texts are one node from the start, so groups of copies are signed once and cost one comparison. Texts are read again for
    comparisons, and only those of nodes that share a bucket are shuffled then.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("key", text_key(F.col("text")))
    with working(docs.sparkSession) as kept:
        classed = kept(_classed(texts, similar))
    firsts = classed.groupBy("c").agg(F.min(F.struct("late", "doc_id", "key")).alias("m"))
    named = classed.join(firsts, "c").select("key", F.col("m.doc_id").alias("class_id"), F.col("m.key").alias("first_key"))
    out = texts.select("doc_id", "key").join(named, "key")
    first = (F.col("key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return out.select("doc_id", "key", "class_id", first.alias("first"))


def _classed(texts: DataFrame, similar: float) -> DataFrame:
    """(key, late, doc_id, c) of every distinct text of rows (doc_id, text, key): its least doc_id, and a number of its class."""
    late = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    least = F.min(F.struct(late.alias("late"), "doc_id")).alias("m")
    whole = texts.groupBy("key").agg(least, F.count("*").alias("copies"), F.first("text").alias("text"))
    whole = whole.select("key", "m.late", "m.doc_id", "copies", "text", F.monotonically_increasing_id().alias("n"))
    whole = written(whole, "near-nodes")
    frequencies, rarer = word_weights(whole)
    weights = texts.sparkSession.sparkContext.broadcast(frequencies)
    nodes = written(_signatures(_with_rarer(whole, rarer), weights), "near-signed")

    found = {}

    def verify(pairs: DataFrame) -> DataFrame:
        if not found:  # the first pairs name all nodes that can ever be compared
            involved = written(pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct(), "near-involved")
            again = perhaps_among(whole.select("n", "text"), "n", involved).join(involved, "n")
            found["texts"] = written(_with_rarer(again, rarer), "near-texts", involved, *([] if rarer is None else [rarer]))
        side = lambda s: nodes.select(F.col("n").alias(s), F.col("samples").alias(f"samples_{s}"))
        equal = F.size(F.filter(F.zip_with("samples_a", "samples_b", lambda x, y: x == y), lambda e: e))
        pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter(equal >= LEAST_EQUAL).select("a", "b")
        text = lambda s: found["texts"].select(F.col("n").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("text", "words", "often")])
        pairs = pairs.join(text("b"), "b").join(text("a"), "a")

        def compare(batches):
            shingler = Shingler(weights.value)
            last: dict[int, tuple] = {}
            held = 0

            for batch in batches:
                # A few texts at a time become Python strings; a pair's two texts are of like length, as their samples agree.
                for part in chunks(batch, "text_a", 1 << 18):
                    shingler.meet(part, "_a", "_b")
                    a, b = (part.column(c).to_pylist() for c in "ab")
                    if held > 1 << 24:
                        last.clear()
                        held = 0
                    new = {n: (side, i) for side, ns in (("text_a", a), ("text_b", b)) for i, n in enumerate(ns) if n not in last}
                    shingles, weight, sizes = shingler.of_all([part.column(side)[i].as_py() for side, i in new.values()])
                    ends = np.cumsum(sizes)
                    last.update((n, (shingles[x:y], weight[x:y])) for n, x, y in zip(new, ends - sizes, ends))
                    held += 16 * len(shingles)
                    keep = [similarity(last[x], last[y]) >= similar - 1e-9 for x, y in zip(a, b)]
                    yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return pairs.mapInArrow(compare, "a long, b long")

    def measured(rows: DataFrame) -> DataFrame:
        """Adds to rows with n: `mass`, the weight of all the text's shingles, `common`, that of those that another text of `rows` has, and the
        `share` of those that none has. Texts of which too little is common to be similar to any are left out.

        Of two texts no more can be in both than is common, and of x and y that is similar / (1 + similar) of both masses at least.
        """

        def run(batches):
            shingler = Shingler(weights.value)
            for batch in batches:
                for part in chunks(batch, "text", 1 << 18):
                    shingler.meet(part, "")
                    shingles, weight, sizes = shingler.of_all(texts_of(part))
                    n = np.repeat(part.column("n").to_numpy(), sizes)
                    yield pa.RecordBatch.from_pydict({"s": shingles.view(np.int64), "n": n, "w": weight})

        ns = written(rows.select("n").distinct(), "near-open")
        own = perhaps_among(found["texts"], "n", ns).join(ns, "n")
        held = written(own.mapInArrow(run, "s long, n long, w double"), "near-shingles", ns)
        mass = held.groupBy("n").agg(F.sum("w").alias("mass"))
        once = held.groupBy("s").agg(F.count("*").alias("k"), F.first("n").alias("n"), F.first("w").alias("w")).filter("k = 1")
        lone = once.groupBy("n").agg(F.sum("w").alias("lone"))
        each = mass.join(lone, "n", "left").withColumn("common", F.col("mass") - F.coalesce("lone", F.lit(0.0)))
        each = each.withColumn("share", 1 - F.col("common") / F.col("mass")).filter(F.col("share") <= 1 - similar + 1e-6)
        each = written(each.select("n", "mass", "common", "share"), "near-measured", held)
        return rows.join(each, "n").select(*rows.columns, "mass", "common", "share")

    def apart(open_: DataFrame) -> DataFrame:
        """Pairs of a bucket across classes with enough equal samples and enough in common, each only in the bucket of its first two equal bands."""
        signed = open_.join(nodes.select("n", "samples", _bands().alias("bands")), "n")
        one, two = signed.alias("one"), signed.alias("two")
        same = F.filter(F.zip_with("one.bands", "two.bands", lambda x, y: F.when(x == y, x)), lambda b: b.isNotNull())
        where = (
            (F.col("one.bucket") == F.col("two.bucket"))
            & (F.col("one.c") < F.col("two.c"))
            & (F.least("one.common", "two.common") >= (F.col("one.mass") + F.col("two.mass")) * F.lit(similar / (1 + similar) - 1e-6))
            & (F.xxhash64(F.get(same, F.lit(0)), F.get(same, F.lit(1))) == F.col("one.bucket"))
            & (F.size(F.filter(F.zip_with("one.samples", "two.samples", lambda x, y: x == y), lambda e: e)) >= LEAST_EQUAL)
        )
        return one.join(two, where).select(F.col("one.n").alias("x"), F.col("two.n").alias("y"))

    labels = linked(_buckets(nodes), verify, "near-links", apart, sparing=True, measured=measured)
    classed = whole.join(labels, F.col("n") == F.col("id"), "left")
    return written(classed.select("key", "late", "doc_id", F.coalesce("component", "n").alias("c")), "near-classes")


def deduplicated(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """The rows of docs, one of each class of near duplicates: that with the smallest doc_id. All columns are kept,
    except any named _id, _key or _copies."""
    first = near_classes(docs, similar).filter("first").groupBy("doc_id", "key").agg(F.count("*").alias("_copies"))
    first = written(first.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_copies"), "near-first")
    key = text_key(F.col("text"))
    names = [c for c in docs.columns if c not in ("_id", "_key", "_copies")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key"))
    once = docs.join(first.filter("_copies = 1"), same, "left_semi")
    repeated = docs.join(first.filter("_copies > 1"), same, "left_semi")
    repeated = repeated.withColumn("_key", key).dropDuplicates(["doc_id", "_key"]).drop("_key")
    return once.unionByName(repeated)
