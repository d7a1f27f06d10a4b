"""Best-fit decreasing packing of token sequences, for any number of documents.

Best-fit decreasing sees only lengths, and lengths are whole numbers up to the capacity. So its whole run is known from the
number of pieces per length: a table of at most `capacity` rows. The driver replays the run on that table, taking at each step all
bins with equal room at once, and notes which ranks of a length go to which bins. Tasks then look up the place of each piece by
its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statpanel.llm.common import one_thread, written
from statpanel.llm.lexicon import WORD_PATTERN, Vocabulary, chunks, texts_of, unusual

#: Pieces that are ranked together in one task.
BLOCK_BITS = 17

_TOKENIZERS: dict[str, tuple] = {}


def _tokenizers(path: str) -> tuple:
    """The `tokenizers` library's tokenizer, and the same vocabulary for the faster merge of usual texts."""
    if path not in _TOKENIZERS:
        one_thread()
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        exact.no_padding()
        exact.no_truncation()
        words = Vocabulary(path)
        ranks = {t: i for i, t in words.bytes_of.items() if i not in words.added.values()}
        fast = None
        # The faster library takes ids as ranks of merges; where a file's ids differ, the first one does all.
        if sorted(ranks.values()) == [*range(len(ranks))] and all(new == 256 + r for r, new in enumerate(words.merged)):
            fast = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=words.added)
        _TOKENIZERS[path] = exact, fast
    return _TOKENIZERS[path]


def token_ids(text: str, path: str) -> np.ndarray:
    exact, fast = _tokenizers(path)
    if fast is None or unusual(text):
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode(text, allowed_special="all"), "<u4")


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): the tokens of each document, then `end_id`, in pieces of at most `capacity`.

    A document of more tokens is cut into pieces of exactly `capacity`, only the first of which may be shorter. Null text is empty: one
    piece with the end id. Repeated rows are separate documents; a null doc_id stays; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), texts_of(part)):
                    ids = np.append(token_ids(text, vocabulary), np.uint32(end_id)).astype("<u4")
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class RoomTree:
    """A segment tree over remaining room 0..capacity; each leaf holds runs of bins (first id, number) with that room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        at, some = room + self.size, bool(self.runs[room])
        while at and self.some[at] != some:
            self.some[at] = some
            at //= 2
            some = self.some[2 * at] or self.some[2 * at + 1] if at else some

    def push(self, room: int, first: int, number: int) -> None:
        self.runs[room].append((first, number))
        self._mark(room)

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, need: int) -> int | None:
        """The least room of at least `need` that an open bin has."""
        at = need + self.size
        while not self.some[at]:
            while at & 1:  # a right child, or the root: go up
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.size


@dataclass
class Plan:
    """Ranks from `rank` on of pieces of `length` go to bins from `bin` on, `each` per bin, the first at `offset`."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.searchsorted((self.length << 44) + self.rank, (length << 44) + rank, "right") - 1
        over = rank - self.rank[step]
        return self.bin[step] + over // self.each[step], self.offset[step] + over % self.each[step] * length


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over `counts` pieces per length. Equal to placing one piece after the other.

    The tightest bin for a length stays the tightest until it has no room for that length, so it takes as many as fit. Steps, and
    so the plan, are bounded by the capacity alone, not by the number of pieces.
    """
    tree, bins, steps = RoomTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, run = capacity, (bins, -(-left // (capacity // length)))
                bins += run[1]
            else:
                run = tree.pop(room)
            first, number = run
            each = room // length
            taken = min(left, each * number)
            steps.append((length, rank, first, each, capacity - room))
            full, rest = divmod(taken, each)
            if full and room - each * length:
                tree.push(room - each * length, first, full)
            if rest:
                tree.push(room - rest * length, first + full, 1)
            if number > full + bool(rest):
                tree.push(room, first + full + bool(rest), number - full - bool(rest))
            rank, left = rank + taken, left - taken
    columns = np.array(sorted(steps), np.int64).reshape(-1, 5).T
    return Plan(*columns, bins)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to pieces, whose `length` is 1 to `capacity`: best-fit decreasing over all of them.

    Every sequence is filled without gaps from 0. Pieces of equal length are interchangeable; they are ranked in the order in which
    the tasks wrote them. Null lengths, and lengths out of range, fail. Columns named sequence_id or offset are replaced, as are `_row` and `_block`.
    An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("_row", "_block", "sequence_id", "offset")
    good = F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    checked = F.when(good, F.col("length")).otherwise(F.raise_error(F.lit("length out of range")).cast("long"))
    rows = written(pieces.withColumns({"length": checked, "_row": F.monotonically_increasing_id()}), "pieces")
    block = F.shiftright("_row", BLOCK_BITS).alias("_block")
    counts = written(rows.groupBy("length", block).agg(F.count("*").alias("n")), "piece-counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(best_fit({r["length"]: r["n"] for r in totals}, capacity))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def place(mine: pa.Table, starts: pa.Table) -> pa.Table:
        mine = mine.sort_by("_row")
        first = np.zeros(capacity + 1, np.int64)
        first[starts["length"].to_numpy()] = starts["before"].to_numpy()
        length = mine["length"].to_numpy()
        rank = first[length] + pd.Series(length).groupby(length).cumcount().to_numpy()
        sequence, offset = plan.value.place(length, rank)
        out = mine.drop_columns(["_row", "_block"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_row")
    left = rows.withColumn("_block", block).groupBy("_block")
    return left.cogroup(starts.groupBy("_block")).applyInArrow(place, schema + ", sequence_id long, offset long")
