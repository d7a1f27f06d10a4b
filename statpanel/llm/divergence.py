"""How far the sources of a language differ in their words.

Each task lays the texts it reads together to shards, finds the byte at which every word starts, and sorts these pointers by the words they
point at with a multikey quicksort that takes eight bytes for a character. Equal runs of pointers give a word's occurrences and
documents per source. Spark adds the shards up, smooths and compares: words of a group with its language's in one window of bounded
rank, sources with each other by tiles of blocks of words and strips of sources.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statpanel.llm.common import written

#: Bytes of text that are sorted together, pointers that are sorted at once, bytes of a word from which on the rest is compared as a whole.
SHARD, SLICE, WHOLE = 16 << 20, 1 << 15, 64
LEAST_DOCS, SMOOTH, SCALE = 30, 5, 1_000_000_000
#: Words and sources of a tile.
BLOCK, STRIP = 2048, 256

_byte = np.arange(256)
_LETTER = (_byte >= 0x80) | ((_byte | 0x20) >= ord("a")) & ((_byte | 0x20) <= ord("z"))
_LOWER = np.where((_byte >= ord("A")) & (_byte <= ord("Z")), _byte + 32, _byte).astype(np.uint8)
#: By the bytes that a word still has: which of the eight bytes read at a pointer belong to it.
_MASK = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], np.uint64)
_COUNTS = "lang string, source string, term string, occurrences long, docs long"


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in the bytes of texts laid end to end at `offsets`, and how long they are. A text's end ends a word."""
    letter = np.concatenate([_LETTER[data], [False]])
    fresh = letter[:-1].copy()
    fresh[1:] &= ~letter[:-2]
    inner = offsets[offsets < len(data)]
    fresh[inner] = letter[inner]
    # A word ends where no letter follows, or where the next text begins.
    last = letter[:-1] & ~letter[1:]
    before = inner[inner > 0] - 1
    last[before] = letter[before]
    starts = np.flatnonzero(fresh)
    return starts, np.flatnonzero(last) + 1 - starts


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words at `starts`, equal ones in the order given, and whether each is another than the one before it.

    A slice of pointers is split by eight bytes at one depth into less, equal and greater; the equal ones go on eight bytes deeper unless
    their words have ended. Slices that are small are left, and then sorted all together, one depth after the other. Nothing is
    compared twice, and words that differ early are never read to their ends.
    """
    n = len(starts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))

    def keys_of(part: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(lengths[part] - depth, 0, 8)
        return eight[np.minimum(starts[part] + depth, len(data))].astype(np.uint64) & _MASK[left]

    order, fresh = np.arange(n), np.zeros(n, bool)
    slices, small = [(0, n, 0)] if n else [], {}
    while slices:
        low, high, depth = slices.pop()
        fresh[low] = True
        if high - low <= SLICE:
            small.setdefault(depth, []).append((low, high))
            continue
        part = order[low:high]
        keys = keys_of(part, depth)
        pivot = np.partition(keys[:: len(keys) // 255], 127)[127]
        sides = [part[keys < pivot], part[keys == pivot], part[keys > pivot]]
        order[low:high] = np.concatenate(sides)
        for side, deeper in zip(sides, (False, True, False)):
            if deeper and len(side) and not int(pivot) & 0xFF:
                fresh[low] = True  # these words have ended: they are all equal
            elif len(side):
                slices.append((low, low + len(side), depth + 8 * deeper))
            low += len(side)
    while small:
        depth = min(small)
        lows, highs = np.array(small.pop(depth)).T
        if depth >= WHOLE:
            for low, high in zip(lows.tolist(), highs.tolist()):
                rest = sorted((padded[starts[i] + depth : starts[i] + lengths[i]].tobytes(), i) for i in order[low:high].tolist())
                order[low:high] = [i for _, i in rest]
                fresh[low + 1 : high] = [a[0] != b[0] for a, b in zip(rest, rest[1:])]
            continue
        sizes = highs - lows
        number = np.repeat(np.arange(len(lows)), sizes)
        spots = np.arange(len(number)) + np.repeat(lows - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        part = order[spots]
        keys = keys_of(part, depth)
        by = np.lexsort((keys, number))
        order[spots], keys = part[by], keys[by]
        cut = np.concatenate([[True], (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])])
        fresh[spots[cut]] = True
        first = np.flatnonzero(cut)
        end = np.append(first[1:], len(keys))
        more = (end - first > 1) & (keys[first] & np.uint64(0xFF) != 0)
        if more.any():
            deeper = zip(spots[first[more]].tolist(), (spots[end[more] - 1] + 1).tolist())
            small.setdefault(depth + 8, []).extend(deeper)
    return order, fresh


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, as they lie in its Arrow buffer, and where each text begins, with the end of the last."""
    _, offsets, data = text.buffers()
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    at = np.frombuffer(offsets, wide)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def shard_counts(batch: pa.Table) -> pa.RecordBatch:
    """(lang, source, term, occurrences, docs) of the rows (lang, source, text) of one shard."""
    lang, source = (batch.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    parts = [_bytes(chunk) for chunk in batch.column("text").chunks]
    data = _LOWER[np.concatenate([d for d, _ in parts])]
    sizes = np.concatenate([np.diff(at) for _, at in parts])
    ends = np.cumsum(sizes)
    starts, lengths = word_starts(data, ends - sizes)
    order, fresh = sort_pointers(data, starts, lengths)
    doc = np.searchsorted(ends, starts[order], "right")
    # A document's occurrences of a word stand together, as equal words keep the order of the text.
    new = fresh.copy()
    new[1:] |= doc[1:] != doc[:-1]
    heads = np.flatnonzero(new)
    often = np.diff(np.append(heads, len(order)))
    width = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
    run = np.cumsum(fresh)[heads] - 1
    code = run * (len(lang.dictionary) * width) + group[doc[heads]]
    by = np.argsort(code, kind="stable")
    code, often = code[by], often[by]
    edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    run, group = np.divmod(code[edge], len(lang.dictionary) * width or 1)
    point = order[fresh]
    words = pa.array([data[s : s + n].tobytes() for s, n in zip(starts[point].tolist(), lengths[point].tolist())], pa.binary())
    columns = [
        lang.dictionary.take(pa.array(group // max(width, 1))),
        source.dictionary.take(pa.array(group % max(width, 1))),
        words.view(pa.string()).take(pa.array(run)),
        pa.array(np.add.reduceat(often, edge) if len(edge) else [], pa.int64()),
        pa.array(np.diff(np.append(edge, len(code))), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "occurrences", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, occurrences, docs), several rows per term: one for each shard of some SHARD bytes that a task sorted."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            bytes_, at = _bytes(batch.column("text"))
            cut = 0
            while cut < batch.num_rows:
                end = max(int(np.searchsorted(at, at[cut] + SHARD - size, "right")) - 1, cut + 1)
                end = min(end, batch.num_rows)
                held.append(batch.slice(cut, end - cut))
                size += int(at[end] - at[cut])
                cut = end
                if size >= SHARD or cut < batch.num_rows:
                    yield shard_counts(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield shard_counts(pa.Table.from_batches(held))

    return _rows(docs).mapInArrow(run, _COUNTS)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), 0 without terms.

    Long division in two steps of whole numbers: exact up to 9 * 10**13 words of a language, an error beyond.
    """
    div = lambda a, b: F.call_function("div", a, b)
    top, bottom = count + F.lit(SMOOTH), total + SMOOTH * terms
    step = 100_000
    high = div(top * step, bottom)
    low = div((top * step - high * bottom) * (SCALE // step), bottom)
    return F.when(terms > 0, 1 + high * (SCALE // step) + low).otherwise(F.lit(0)).cast("long")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, occurrences, total, head) of the terms in at least `least_docs` documents of their language.

    total is the term's occurrences in the language, head marks one row per (lang, term).
    """
    counts = term_counts(docs).groupBy("lang", "source", "term")
    counts = counts.agg(F.sum("occurrences").alias("occurrences"), F.sum("docs").alias("docs"))
    word = Window.partitionBy("lang", "term")  # as many rows as the language has sources
    counts = counts.withColumns(
        {"n": F.sum("docs").over(word), "total": F.sum("occurrences").over(word), "head": F.min("source").over(word) == F.col("source")}
    )
    return counts.filter(F.col("n") >= least_docs).select("lang", "source", "term", "occurrences", "total", "head")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, words, lang_words, terms, strip, strips) of every group that occurs, also of one without terms."""
    words = kept.groupBy("lang", "source").agg(F.sum("occurrences").alias("words"), F.sum(F.col("head").cast("long")).alias("heads"))
    groups = _rows(docs).select("lang", "source").distinct().join(words, ["lang", "source"], "left").fillna(0, ["words", "heads"])
    lang = Window.partitionBy("lang")  # as many rows as the language has sources
    number = F.row_number().over(lang.orderBy("source")) - 1
    return groups.select(
        "lang",
        "source",
        "words",
        F.sum("words").over(lang).alias("lang_words"),
        F.sum("heads").over(lang).alias("terms"),
        (number / STRIP).cast("int").alias("strip"),
        F.ceil(F.count("*").over(lang) / STRIP).cast("int").alias("strips"),
    )


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    """Of all pairs of a source of strip i with one of strip j: the sum of their differences over the words of one block."""
    lang, _, i, j = (k.as_py() for k in key)
    names, terms = rows["source"].combine_chunks().dictionary_encode(), rows["term"].combine_chunks().dictionary_encode()
    share, strip = rows["share"].to_numpy(), rows["strip"].to_numpy()
    source, is_base = names.indices.to_numpy(), terms.is_null().to_numpy(zero_copy_only=False)
    table = np.zeros((len(names.dictionary), max(len(terms.dictionary), 1)), np.int64)
    strip_of = np.zeros(len(table), np.int64)
    strip_of[source[is_base]] = strip[is_base]
    if len(terms.dictionary):
        table[source[is_base]] = share[is_base][:, None]
        table[source[~is_base], terms.indices.filter(terms.is_valid()).to_numpy()] = share[~is_base]
    # In the order of their names, so that a pair stands the same way round in every block.
    named = np.argsort(np.array(names.dictionary.to_pylist(), object), kind="stable")
    left, right = named[strip_of[named] == i], named[strip_of[named] == j]
    out = [[], [], []]
    for n, a in enumerate(left):
        others = right[n + 1 :] if i == j else right
        out[0].append(np.full(len(others), a))
        out[1].append(others)
        out[2].append(np.abs(table[others] - table[a]).sum(axis=1))
    a, b, value = (np.concatenate([np.zeros(0, np.int64), *o]) for o in out)
    columns = [pa.array([lang] * len(a), pa.string()), names.dictionary.take(pa.array(a)), names.dictionary.take(pa.array(b)), pa.array(value)]
    return pa.table(columns, ["lang", "a", "b", "value"])


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each source with each other of its language.

    Blocks of some BLOCK words by hash times pairs of strips of STRIP sources are tiles, which any task can do. A row that carries no term
    gives each tile what a source shares out to words it does not have.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).cast("int")
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "strip", "strips", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "term",
        _share(F.col("occurrences"), F.col("words"), F.col("terms")).alias("share"),
    )
    base = groups.select(
        "lang", "source", "strip", "strips", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(None).cast("string").alias("term"),
        _share(F.lit(0), F.col("words"), F.col("terms")).alias("share"),
    )
    dealt = cells.unionByName(base).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    dealt = dealt.withColumns({"i": F.least("strip", "other"), "j": F.greatest("strip", "other")})
    tiles = dealt.select("lang", "block", "i", "j", "source", "strip", "term", "share").groupBy("lang", "block", "i", "j")
    sums = tiles.applyInArrow(_tile, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", F.inline(both), "value")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, best: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others and from the language as a whole.

    Terms are runs of ASCII letters and of characters beyond ASCII, with A to Z in lower case; those in at least `least_docs` rows of their
    language count. With the count of a term in a group of rows that agree in lang and source, or in a language, its share is
    1 + floor(10**9 * (count + 5) / (words + 5 * terms)), words being all occurrences of terms there. Part `pair` gives the sum over all terms of the
    absolute difference to each other source of the language (0 without terms), part `term` the `best` terms of the group with most
    over the language's share. Ranks count from 1, larger values first, ties by the item's UTF-8 bytes.

    Null text, lang and source count as empty; every group that occurs takes part, also one without terms. Rows that repeat count
    each. Words of any length are kept whole. Other columns are ignored; an empty table gives an empty one. A hot group or word is
    added up inside each shard before anything is shuffled.
    """
    kept = written(kept_terms(docs, least_docs), "divergence-terms")
    groups = written(_groups(docs, kept), "divergence-groups")
    own = _share(F.col("occurrences"), F.col("words"), F.col("terms"))
    over = own - _share(F.col("total"), F.col("lang_words"), F.col("terms"))
    more = kept.join(groups, ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))
    pairs = _pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    most = more.filter("value > 0").select("*", rank).filter(F.col("rank") <= best)
    return most.unionByName(pairs.select("*", rank))
