"""Byte-level BPE over a memory-mapped lexicon.

The frequent words of a corpus are compiled, with their token ids, into a minimal acyclic transducer: words share prefixes and
suffixes, and the numbers along a word's path add up to the place of its ids. The file is written to the shared folder, handed to
executors by Spark, and mapped there, so that all workers of a host share one copy. Words that it lacks are merged exactly.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statpanel.llm.common import one_thread
from statpanel.sources.scratch import scratch_path

#: Fixed values of byte-level BPE: the word pattern, and code points that all versions of Unicode classify alike.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
USUAL = "\x00-՗‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣"

_WORDS = regex.compile(WORD_PATTERN)
_UNUSUAL = re.compile(f"[^{USUAL}]")
#: A space that does not stand between two other characters, and white space that is rare.
_ODD_SPACE = re.compile(r"\A | \Z|\s\s")
#: Marks that are a word of their own behind letters.
_MARKS = frozenset(".,;:!?)")
_RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]

#: Longest word in the lexicon, in bytes; characters that a worker tokenizes at a time.
LONGEST = 32
CHUNK = 1_000_000
#: Bytes of parts and ids that a worker remembers, with what Python needs for each; longer parts are not remembered.
REMEMBERED, EACH, LONG_PART = 112 << 20, 170, 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def unusual(text: str) -> bool:
    """Whether a text has code points that versions of Unicode may classify differently."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")  # faster than the search, and enough for many texts
        return False
    except UnicodeEncodeError:
        return _UNUSUAL.search(text) is not None


def _odd_spaces(text: str) -> bool:
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return True
    return any(c in text for c in _RARE_SPACES) and _ODD_SPACE.search(text) is not None


class Vocabulary:
    """Tokens, merges and added tokens of a `tokenizers` file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or splitter.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        added = spec.get("added_tokens", [])
        if spec.get("normalizer") or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: normalizers and stripping tokens are not supported")
        letters = byte_letters()
        ids = model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in added}
        self.added = {t["content"]: t["id"] for t in added}
        self.byte_id = [0] * 256
        for letter, byte in letters.items():
            self.byte_id[byte] = ids[letter]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        found = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.ranks = {a << 32 | b: rank for rank, (a, b, _) in enumerate(found)}
        self.merged = [new for _, _, new in found]
        table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self._flat = np.frombuffer(b"".join(table), np.uint8)
        self._sizes = np.array([*map(len, table), 0])  # the last one stands for ids without a token
        self._starts = np.cumsum([0, *self._sizes[:-1]])

    def merge(self, word: bytes) -> list[int]:
        """Apply the best-ranked merge, leftmost first, until none applies."""
        parts = [self.byte_id[b] for b in word]
        if len(parts) > 48:
            return self._merge_long(parts)
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [self.merged[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 32 | parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] << 32 | parts[at + 1], none)
        return parts

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all(ids, np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Several texts, whose ids stand one after the other, and begin and end at `ends`."""
        ids = np.where((ids < 0) | (ids >= len(self._sizes)), len(self._sizes) - 1, ids)
        sizes = self._sizes[ids]
        to = np.cumsum(sizes)
        places = np.arange(to[-1] if len(to) else 0) + np.repeat(self._starts[ids] - to + sizes, sizes)
        data = self._flat[places].tobytes()
        cuts = np.append(0, to)[ends].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over a linked list: long words cost n log n."""
        n = len(parts)
        left, right = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (found := self.ranks.get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (found, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = self.merged[rank], -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of the words, built from the sorted words, and their ids in that order."""
    words = sorted(entries)
    states: dict[tuple, int] = {}
    counts: list[int] = []  # words that end at or below a state
    edges: list[tuple[int, int, int, int]] = []

    def close(node: list) -> int:
        """The number of the state equal to this finished node: an older one, or a new one."""
        final, below = node
        key = (final, tuple(below))
        if key not in states:
            states[key] = state = len(counts)
            skip = int(final)
            for label, target in below:
                edges.append((state, label, target, skip))
                skip += counts[target]
            counts.append(skip)
        return states[key]

    path: list[list] = [[False, []]]
    before = b""
    for word in words:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        while len(path) > same + 1:
            done = path.pop()
            path[-1][1].append((before[len(path) - 1], close(done)))
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        before = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((before[len(path) - 1], close(done)))
    root = close(path[0])
    finals = np.zeros(len(counts), np.int32)
    for (final, _), state in states.items():
        finals[state] = final
    table = np.array(sorted(edges), np.int64).reshape(-1, 4)
    starts = np.cumsum([0, *(len(entries[w]) for w in words)], dtype=np.int32)
    ids = np.fromiter(chain.from_iterable(entries[w] for w in words), np.int32)
    keys = table[:, 0] * 256 + table[:, 1]
    sizes = np.array([root, len(keys), len(finals), len(starts), len(ids)], np.int64)
    rest = [table[:, 2].astype(np.int32), table[:, 3].astype(np.int32), finals, starts, ids]
    return b"".join(x.tobytes() for x in (sizes, keys, *rest))


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        self.root, edges, states, words, ids = (int(x) for x in data[:40].view(np.int64))
        at = 40 + 8 * edges
        self.keys = data[40:at].view(np.int64)
        out = []
        for n in (edges, edges, states, words, ids):
            out.append(data[at : at + 4 * n].view(np.int32))
            at += 4 * n
        self.targets, self.skips, self.finals, self.starts, self.ids = out
        self.bytes = memoryview(self.ids.view(np.uint8))

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as 32-bit numbers, None for words that the lexicon lacks; all words take a step at a time."""
        if not words or not len(self.keys):
            return [None] * len(words)
        lengths = np.array([len(w) for w in words])
        longest = min(int(lengths.max()), LONGEST)
        letters = np.zeros((len(words), longest), np.uint8)
        padded = b"".join(w[:longest].ljust(longest, b"\0") for w in words)
        letters[:] = np.frombuffer(padded, np.uint8).reshape(len(words), longest)
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        alive = lengths <= longest
        rows = np.nonzero(alive)[0]
        for i in range(longest):
            rows = rows[lengths[rows] > i]
            key = state[rows] * 256 + letters[rows, i]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            alive[rows[~hit]] = False
            rows, edge = rows[hit], edge[hit]
            state[rows] = self.targets[edge]
            number[rows] += self.skips[edge]
        alive &= self.finals[state] == 1
        number = np.where(alive, number, 0)
        found = zip(alive.tolist(), (4 * self.starts[number]).tolist(), (4 * self.starts[number + 1]).tolist())
        return [self.bytes[a:b] if ok else None for ok, a, b in found]


class Encoder:
    """Encodes and decodes as the `tokenizers` library does, with add_special_tokens=False.

    A text is cut at its spaces. As no word reaches over a space between other characters, the ids of a part stand by themselves, and
    are remembered.
    """

    def __init__(self, vocabulary: str, lexicon: str | None = None):
        self.vocabulary = Vocabulary(vocabulary)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.known: dict[str, bytes] = {}  # ids of parts at the start of a text, and of words
        self.spaced: dict[str, bytes] = {}  # ids of parts behind a space, by the part without it
        self.held = 0
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def parts(self, text: str) -> tuple[list[str], list[str]]:
        """First words that stand by themselves, then parts that each follow a space. Added tokens have a NUL and a letter ahead, as no word has."""
        if self._added is not None and self._added.search(text):
            split = self._added.split(text)
            return [w for i, p in enumerate(split) for w in ([f"\0a{p}"] if i % 2 else self._words(p))], []
        if _odd_spaces(text) or unusual(text):
            return self._words(text), []
        first, *rest = text.split(" ")
        return [first] if first else [], rest

    def _words(self, text: str) -> list[str]:
        if unusual(text):
            # The library's own splitter decides where versions of Unicode differ.
            from tokenizers.pre_tokenizers import ByteLevel

            return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        return _WORDS.findall(text)

    def words(self, part: str, ahead: str = "") -> list[str]:
        """The words of a part with a space `ahead` or none; an added token, or a word that the library's splitter found, is one."""
        if part.isalpha():
            return [ahead + part]
        if part[-1:] in _MARKS and part[:-1].isalpha():
            return [ahead + part[:-1], part[-1]]
        part = ahead + part
        return [part] if part.startswith("\0a") or unusual(part) else _WORDS.findall(part)

    def _ids(self, parts: list[str], ahead: str = "") -> list[bytes]:
        split = [[ahead + p] if p.isalpha() else self.words(p, ahead) for p in parts]
        words = list(set(chain.from_iterable(split)).difference(self.known))
        plain = words if ahead else [w for w in words if not w.startswith("\0a")]
        plain.sort()  # neighbours take like ways through the lexicon
        raw = list(map(str.encode, plain))
        ids = self.lexicon.find(raw) if self.lexicon else [None] * len(raw)
        merge = self.vocabulary.merge
        found = [array("i", merge(data)).tobytes() if known is None else known for data, known in zip(raw, ids)]
        new: dict[str, bytes] = dict(zip(plain, found))
        if len(plain) < len(words):
            new |= {w: array("i", [self.vocabulary.added[w[2:]]]).tobytes() for w in words if w.startswith("\0a")}
        # Most parts are one word.
        known = self.known
        return [
            (new.get(s[0]) or known[s[0]]) if len(s) == 1 else b"".join([new.get(w) or known[w] for w in s]) for s in split
        ]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin and end."""
        if self.held > REMEMBERED:
            self.known.clear()
            self.spaced.clear()
            self.held = 0
        collects = gc.isenabled()
        gc.disable()  # the many short lists hold no cycles; searching them for some takes a tenth of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.parts(t) for t in texts]
        long = self._remember(self.known, {w for first, _ in split for w in first}, "")
        long_spaced = self._remember(self.spaced, set(chain.from_iterable(rest for _, rest in split)), " ")
        known, spaced = self.known.__getitem__, self.spaced.__getitem__
        data = [b"".join(map(known, first)) + b"".join(map(spaced, rest)) for first, rest in split]
        for table, parts in ((self.known, long), (self.spaced, long_spaced)):
            for part in parts:
                del table[part]
        ends = np.cumsum([0, *map(len, data)]) // 4
        return np.frombuffer(b"".join(data), np.int32), ends

    def _remember(self, table: dict[str, bytes], parts: set[str], ahead: str) -> list[str]:
        """Add the ids of the parts that `table` lacks, and return those that are too long to stay in it."""
        missing = list(parts.difference(table))
        ids = self._ids(missing, ahead)
        table.update(zip(missing, ids))
        long = [i for i, w in enumerate(missing) if len(w) > LONG_PART]
        self.held += 4 * sum(map(len, missing)) + sum(map(len, ids)) + EACH * len(missing)
        self.held -= sum(4 * len(missing[i]) + len(ids[i]) + EACH for i in long)
        return [missing[i] for i in long]

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode(ids, skip_special_tokens=False); ids without a token are skipped."""
        return self.vocabulary.decode(ids)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        return self.vocabulary.decode_all(ids, ends)


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts reach `size` bytes; a longer text is a chunk of its own."""
    lengths = np.cumsum([0, *(len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column))])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(lengths, lengths[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def word_counts(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(word, n) over all texts, of words of at most LONGEST bytes, each taken with the space before it.

    Spark counts the parts between spaces; only distinct parts are cut into words.
    """

    def cut(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            seen: Counter = Counter()
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in encoder.words(part, " "):
                    if len(word.encode()) <= LONGEST:
                        seen[word] += n
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    parts = texts.select(F.explode(F.split("text", " ")).alias("part")).filter("part <> ''").groupBy("part").count()
    counted = parts.mapInArrow(cut, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(texts: DataFrame, vocabulary: str, words: int = 1 << 18) -> str:
    """Compile the `words` most frequent words of all texts; returns the name to give to `encode`.

    Counts cover every text. Ties at the end of the list go to the smaller word. The driver sees only that list, whose size
    `words` and LONGEST bound, and the compiled file of a few MB. Null texts have no words; with no words the lexicon is empty.
    """
    spark = texts.sparkSession
    top = word_counts(texts, vocabulary).orderBy(F.desc("n"), "word").limit(words)
    merged = Vocabulary(vocabulary)
    entries = {raw: merged.merge(raw) for raw in (r["word"].encode() for r in top.toLocalIterator())}
    return share(spark, compile_lexicon(entries), "lexicon")


def share(spark: SparkSession, data: bytes, name: str) -> str:
    """Write a small file to the shared folder and have Spark hand it to all executors, also to later ones."""
    jvm, sc = spark._jvm, spark.sparkContext
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex}"
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


_LOADED: dict[tuple, Encoder] = {}


def _encoder(vocabulary: str, lexicon: str | None) -> Encoder:
    """One encoder per worker process, with what it remembers, for as long as the lexicon stays the same."""
    key = (vocabulary, lexicon)
    if key not in _LOADED:
        one_thread()
        _LOADED.clear()
        _LOADED[key] = Encoder(vocabulary, SparkFiles.get(lexicon) if lexicon else None)
    return _LOADED[key]


def round_trip(docs: DataFrame, vocabulary: str, lexicon: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the token ids of each whole text, and the text that they decode to.

    Ids are those of the `tokenizers` library for the same file with add_special_tokens=False: strings of added tokens in a text
    become their ids. Null text counts as empty and has no ids. Repeated rows and keys each give a row; other columns are
    ignored. A text is one row, however long; workers tokenize CHUNK bytes at a time, or one longer text.
    """
    kind = docs.schema[key].dataType

    def run(batches):
        encoder = _encoder(vocabulary, lexicon)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, ends = encoder.encode(texts_of(part))
                decoded = encoder.decode_all(ids, ends)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(decoded, pa.string())], [key, "ids", "decoded"])

    schema = f"{key} {kind.simpleString()}, ids array<int>, decoded string"
    return docs.select(key, "text").mapInArrow(run, schema)
