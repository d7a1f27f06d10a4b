"""Shingles and MinHash signatures of lines in numpy, for tasks over Arrow batches.

The bands of a signature move between tasks as blocks of packed records, not as rows: the shuffle of a row for each band of each line took
several times the CPU of all that is done with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.llm.lexicon import chunks, texts_of

WIDTH = 5
PLACES = 24
#: 64-bit words of a packed signature, which holds 16 bits of each place.
WORDS = PLACES // 4
#: Lines are compared if one band of three hashes agrees: at a similarity of 0.8 that is missed for 3 pairs in 1,000, at 0.9 for 3 in 10**5.
BANDS, ROWS = 8, 3
#: Of the places of a signature at least so many must agree: fewer do for 2 in 10**4 pairs with a similarity of 0.8.
AGREE = 12
#: A line in a band: the band's number and three places, Spark's hash of the line, and four bits of each place, which agree where the places do.
RECORD = np.dtype([("key", "<u8"), ("n", "<u8"), ("one", "<u8"), ("two", "<u4")])
#: Records that a task holds before it deals them out.
FLUSH = 1 << 19
#: Lines of a band's bucket that are compared with each other by these bits. In larger buckets lines must also agree in one of seven triples of
#: the other places: at a similarity of 0.8 none agrees for 7 pairs in 1,000, but most pairs share several buckets.
LARGE = 1 << 10
#: Lines that are compared with each other if any links connect them.
FEW = 64
#: Characters that are hashed at a time; longer lines are cut, with an overlap. Lines that a task remembers, so as not to sign them again.
PIECE, REMEMBERED = 1 << 16, 1 << 18
#: Slots in which shingles are counted: 8 MB at the driver and in each worker.
SLOTS = 1 << 20
#: Stands behind lines of fewer characters than a shingle has; no character of a text.
PAD = "\ud800"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: One odd factor per place of the signature, drawn once.
_FACTORS = np.random.default_rng(24).integers(0, 1 << 63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(text: str) -> np.ndarray:
    """A hash of the WIDTH characters from each character on."""
    units = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(units) - WIDTH + 1
    x = units[:n].copy()
    for i in range(1, WIDTH):
        x *= _FACTOR
        x += units[i : i + n]
    for m in _MIX:
        x ^= x >> np.uint64(31)
        x *= m
    x ^= x >> np.uint64(29)
    return x


def shingle_hashes(line: str) -> np.ndarray:
    """The sorted hashes of a line's shingles: WIDTH characters from every character on, or the whole of a shorter line."""
    return _distinct(_hashes(line.ljust(WIDTH, PAD)))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.empty(len(x), bool)
    new[:1] = True
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def share_at_least(a: np.ndarray, b: np.ndarray, similar: float) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of `similar` or more."""
    if min(len(a), len(b)) < similar * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= similar * (len(both) - common)


def _minima(pieces: list[str], out: np.ndarray) -> None:
    """The least hash of each piece for each place."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    # Every other stretch is what reaches over the end of a piece.
    bounds = np.stack([ends - lengths, ends - (WIDTH - 1)], axis=1).reshape(-1)[:-1]
    x = _hashes("".join(pieces))
    y = np.empty_like(x)
    for place, factor in zip(out, _FACTORS):
        place[:] = np.minimum.reduceat(np.multiply(x, factor, out=y), bounds)[::2]


def signatures(lines: list[str]) -> np.ndarray:
    """A row of WORDS 64-bit words for each line: 16 bits of the least hash of its shingles, for each of PLACES hashes of them."""
    pieces, firsts = [], []
    for line in lines:
        firsts.append(len(pieces))
        if len(line) < WIDTH:
            line = line.ljust(WIDTH, PAD)
        for at in range(0, len(line) - WIDTH + 1, PIECE):
            pieces.append(line[at : at + PIECE + WIDTH - 1])
    least = np.empty((PLACES, len(pieces)), np.uint64)
    first = size = 0
    for i, piece in enumerate(pieces):
        size += len(piece)
        if size >= PIECE or i + 1 == len(pieces):
            _minima(pieces[first : i + 1], least[:, first : i + 1])
            first, size = i + 1, 0
    if len(pieces) > len(lines):
        least = np.minimum.reduceat(least, firsts, axis=1)
    # The upper bits of a minimum are mostly zero; those below tell hashes apart.
    places = (least >> np.uint64(24)).astype(np.uint16)
    return np.ascontiguousarray(places.T).view(np.int64)


def _records(places: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The RECORDs of lines, one for each band, of the 16 bits of each place of their signatures."""
    wide = places.astype(np.uint64)
    bits = (wide & np.uint64(15)) << (np.arange(PLACES, dtype=np.uint64) % np.uint64(16) * np.uint64(4))
    out = np.empty((BANDS, len(places)), RECORD)
    out["n"] = numbers
    out["one"] = bits[:, :16].sum(axis=1, dtype=np.uint64)
    out["two"] = bits[:, 16:].sum(axis=1, dtype=np.uint64)
    for b in range(BANDS):
        out["key"][b] = np.uint64(b) << np.uint64(48)
        for at, i in enumerate(range(b, PLACES, BANDS)):
            out["key"][b] |= wide[:, i] << np.uint64(16 * at)
    return out.reshape(-1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _FACTOR
    x ^= x >> np.uint64(31)
    return x * _MIX[0] >> np.uint64(20)


def _dealt(records: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, records): the records of each part in one block."""
    part = (_mixed(records["key"]) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, blocks = part[order], records[order].view(np.uint8)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    ends = (np.r_[first, len(part)] * RECORD.itemsize).astype(np.int32)
    held = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(blocks)])
    return pa.RecordBatch.from_arrays([pa.array(part[first]), held], ["part", "records"])


def signed(docs: DataFrame, white: str, parts: int) -> DataFrame:
    """(part, records) of the lines of `text` that are not blank, without `white` at their ends: the RECORDs of each line's bands, by Spark's hash
    of the line. Those of one band's bucket are of one of `parts` parts.

    Each line at least once; one that several tasks meet comes from each of them.
    """

    def run(batches):
        seen: set[int] = set()
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                if len(seen) > REMEMBERED:
                    seen.clear()
                new: dict[int, str] = {}
                for text in texts_of(part):
                    for line in text.split("\n"):
                        line = line.strip(white)
                        if line:
                            n = xxhash.xxh64_intdigest(line.encode(), 42)  # as F.xxhash64 has it
                            if n not in seen:
                                seen.add(n)
                                new[n] = line
                if new:
                    places = signatures(list(new.values())).view(np.uint16)
                    held.append(_records(places, np.fromiter(new, np.uint64, len(new))))
                    size += len(held[-1])
                if size > FLUSH:
                    yield _dealt(np.concatenate(held), parts)
                    held, size = [], 0
        if size:
            yield _dealt(np.concatenate(held), parts)

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "part int, records binary")


def _near(one_a: np.ndarray, two_a: np.ndarray, one_b: np.ndarray, two_b: np.ndarray) -> np.ndarray:
    """Whether the bits of at least AGREE places agree."""
    x, y = one_a ^ one_b, two_a ^ two_b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    y |= y >> np.uint32(1)
    y |= y >> np.uint32(2)
    x &= np.uint64(0x1111111111111111)
    y &= np.uint32(0x11111111)
    return np.bitwise_count(x) + np.bitwise_count(y) <= PLACES - AGREE


def _stars(one: np.ndarray, two: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j), j > i, whose bits agree, but for those both of which agree with one earlier row that many do.

    Of the rows that agree with such a row each is compared only with those that do not, so copies cost little, however many they are.
    """
    rows = np.arange(len(one))
    out, outside, nearest, among = [], [rows], np.zeros(len(one), np.int64), np.zeros(len(one), np.uint64)
    for i in rows[:-1]:
        rest = outside[nearest[i]]
        rest = rest[np.searchsorted(rest, i, "right") :]
        rest = rest[among[rest] & among[i] == 0]
        rest = rest[_near(one[i], two[i], one[rest], two[rest])]
        if len(rest):
            out.append((np.full(len(rest), i), rest))
        if len(rest) > FEW and len(outside) <= 64:
            bit = np.uint64(1 << (len(outside) - 1))
            among[i] |= bit
            among[rest] |= bit
            outside.append(rows[among & bit == 0])
            held = rows[among & bit != 0]
            held = held[np.array([len(x) for x in outside])[nearest[held]] > len(outside[-1])]
            nearest[held] = len(outside) - 1
    return out


def _links(key: np.ndarray, one: np.ndarray, two: np.ndarray, many: int, bands: np.ndarray | None) -> list[np.ndarray]:
    """Rows (i, j), i < j, with one key that agree in enough places, then stars (i, j), i < j: rows to compare with i, and with each other.

    With the rows' `bands`, more than LARGE rows are only compared within those that share a triple of the other places. Without, so many
    make stars.
    """
    order = np.argsort(key, kind="stable")
    key, one, two = key[order], one[order], two[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[first, len(key)])
    behind = np.repeat(first + sizes, sizes) - np.arange(len(key)) - 1
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    links, stars = [none], [none]
    rows = np.flatnonzero(np.repeat(sizes <= many, sizes))
    for step in range(1, many):
        rows = rows[behind[rows] >= step]
        if not len(rows):
            break
        i = rows[_near(one[rows], two[rows], one[rows + step], two[rows + step])]
        links.append((i, i + step))
    for at, size in zip(first[sizes > many], sizes[sizes > many]):
        end = at + size
        if size <= LARGE:
            for low in range(at, end, 128):
                some = slice(low, min(low + 128, end))
                i, j = np.nonzero(_near(one[some, None], two[some, None], one[None, low:end], two[None, low:end]))
                links.append((i[i < j] + low, j[i < j] + low))
        elif bands is None:
            stars.extend((i + at, j + at) for i, j in _stars(one[at:end], two[at:end]))
        else:
            band = bands[order[at]]
            rest = [i for i in range(PLACES) if i % BANDS != band]
            bits = [(one[at:end] >> np.uint64(4 * i) if i < 16 else two[at:end] >> np.uint32(4 * (i - 16))).astype(np.uint64) & np.uint64(15) for i in rest]
            for t in range(0, len(rest), ROWS):
                triple = bits[t] | bits[t + 1] << np.uint64(4) | bits[t + 2] << np.uint64(8)
                i, j, centre, beam = _links(triple, one[at:end], two[at:end], many, None)
                links.append((i + at, j + at))
                stars.append((centre + at, beam + at))
    return [order[np.concatenate(x)] for x in (*zip(*links), *zip(*stars))]


def _covered(i: np.ndarray, j: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Of links (i, j), i < j, those that make stars in which both ends of each link meet: all but links between two beams of one star."""
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    new = np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])][: len(i)]
    i, j = i[new], j[new]
    starts = np.searchsorted(i, np.arange(rows + 1))
    met, beam = np.zeros(len(i), bool), np.zeros(rows, bool)
    for centre in np.unique(i):
        at, end = starts[centre], starts[centre + 1]
        beams = j[at:end][~met[at:end]]
        if len(beams) > 1:
            beam[beams] = True
            for x in beams:
                met[starts[x] : starts[x + 1]] |= beam[j[starts[x] : starts[x + 1]]]
            beam[beams] = False
    return i[~met], j[~met]


def _least(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` rows the first row that links (i, j) connect it with."""
    out = np.arange(size)
    while True:
        low = np.minimum(out[i], out[j])
        new = out.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == out).all():
            return out
        out = new


def buckets(packed: DataFrame, many: int) -> DataFrame:
    """(bucket, n): lines to compare with each other, those of a band that agree in enough places.

    Lines that are connected are one bucket, if they are few or most agree with most; else each line is with those that it agrees with, so
    that chance agreements in a large corpus do not connect all. A bucket goes by the least number in it: what several bands find
    of one class then mostly meets, and its text moves once.
    """

    def run(table: pa.Table) -> pa.Table:
        records = np.frombuffer(b"".join(table["records"].to_pylist()), RECORD)
        key = records["key"].copy()
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        records = records[order[np.r_[same, False] | np.r_[False, same]]]  # without those alone
        records = records[np.lexsort((records["n"], records["key"]))]
        key, n = records["key"].copy(), records["n"].copy()
        new = np.r_[True, (key[1:] != key[:-1]) | (n[1:] != n[:-1])][: len(key)]
        key, n, one, two = key[new], n[new], records["one"][new], records["two"][new]
        i, j, centre, beam = _links(key, one, two, many, key >> np.uint64(48))
        least = _least(i, j, len(key))
        nodes, links = (np.bincount(x, minlength=len(key)) for x in (least, least[i]))
        sparse = (nodes > FEW) & (8 * links < nodes * nodes)
        rows = np.flatnonzero((nodes[least] > 1) & ~sparse[least])
        some = sparse[least[i]]
        one, two = _covered(i[some], j[some], len(key))
        low, high = np.concatenate([least[rows], one, centre]), np.concatenate([rows, two, beam])
        pairs = np.unique(np.stack([n[np.r_[low, low]], n[np.r_[low, high]]]), axis=1) if len(low) else np.zeros((2, 0), np.uint64)
        return pa.table([pa.array(c) for c in pairs.view(np.int64)], ["bucket", "n"])

    return packed.groupBy("part").applyInArrow(run, "bucket long, n long").distinct()


def _sets(lines: list[str]) -> list[np.ndarray]:
    """The shingles of each line as `shingle_hashes` has them."""
    lines = [line.ljust(WIDTH, PAD) for line in lines]
    x, ends = _hashes("".join(lines)), np.cumsum([len(line) for line in lines])
    return [_distinct(x[end - len(line) : end - (WIDTH - 1)]) for line, end in zip(lines, ends.tolist())]


def _alike(sets: list[np.ndarray], similar: float) -> list[tuple[int, int]]:
    """Stars (i, j) of the classes of sets that have a Jaccard similarity of `similar` or more, directly or through others."""
    if len(sets) == 2:
        return [(0, 1)] if share_at_least(*sets, similar) else []
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every = every[order]
    ids = np.zeros(len(every), np.int64)
    ids[order[1:]] = np.cumsum(every[1:] != every[:-1])
    group, held = np.arange(len(sets)), np.zeros(len(every), np.int32)
    for i in range(len(sets) - 1):
        comparable = np.minimum(sizes[i + 1 :], sizes[i]) >= similar * np.maximum(sizes[i + 1 :], sizes[i])
        others = np.flatnonzero(comparable & (group[i + 1 :] != group[i])) + i + 1
        if not len(others):
            continue
        held[ids[starts[i] : ends[i]]] = 1
        if 2 * sizes[others].sum() < ends[-1] - ends[i]:
            some = np.concatenate([ids[starts[j] : ends[j]] for j in others])
            common = np.add.reduceat(held[some], np.cumsum(sizes[others]) - sizes[others])
        else:
            common = np.add.reduceat(held[ids[ends[i] :]], starts[i + 1 :] - ends[i])[others - i - 1]
        held[ids[starts[i] : ends[i]]] = 0
        found = others[common >= similar * (sizes[i] + sizes[others] - common)]
        if len(found):
            joined = np.arange(len(sets))
            joined[group[found]] = joined[group[i]] = min(group[i], group[found].min())
            group = joined[group]
    return [(int(i), j) for j, i in enumerate(group) if i != j]


def similar_in_buckets(rows: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) that connect the lines of each bucket that have a Jaccard similarity of `similar` or more, of rows (bucket, n, line)."""

    def run(batches):
        last, n, lines, firsts, chars = None, [], [], [], 0

        def found() -> pa.RecordBatch:
            pairs = []
            sets = _sets(lines)
            for at, end in zip(firsts, [*firsts[1:], len(n)]):
                if end > at + 1:
                    pairs.extend((n[at + i], n[at + j]) for i, j in _alike(sets[at:end], similar))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(2)], ["a", "b"])

        for batch in batches:
            for bucket, number, line in zip(*(column.to_pylist() for column in batch.columns)):
                if bucket != last:
                    if chars > PIECE:
                        yield found()
                        n, lines, firsts, chars = [], [], [], 0
                    firsts.append(len(n))
                    last = bucket
                n.append(number)
                lines.append(line)
                chars += len(line)
        if n:
            yield found()

    return rows.select("bucket", "n", "line").repartition("bucket").sortWithinPartitions("bucket", "n").mapInArrow(run, "a long, b long")


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) % SLOTS


def shingle_counts(lines: DataFrame) -> np.ndarray:
    """In how many lines, added up over the shingles whose hashes share one of SLOTS slots, a shingle stands. Any corpus gives SLOTS numbers."""

    def run(batches):
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in chunks(batch, "line"):
                for line in texts_of(part, "line"):
                    np.add.at(counts, _slots(shingle_hashes(line)), 1)
        held = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_pydict({"slot": held, "often": counts[held]})

    counted = lines.select("line").mapInArrow(run, "slot long, often long")
    total = counted.groupBy("slot").agg(F.sum("often").alias("often")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[total["slot"].to_numpy()] = total["often"].to_numpy()
    return out


def first_shingles(lines: DataFrame, often, similar: float) -> DataFrame:
    """(n, c, m, left, s) of rows (n, c, line): of a line's m shingles the first m - ceil(similar * m) + 1 in the order of their broadcast
    counts, then hashes; `left` counts that one and those behind it."""

    def run(batches):
        counts = often.value
        for batch in batches:
            for part in chunks(batch, "line", 1 << 18):
                rows = []
                for n, c, line in zip(*(column.to_pylist() for column in part.columns)):
                    shingles = shingle_hashes(line)
                    m = len(shingles)
                    first = m - int(np.ceil(m * similar - 1e-9)) + 1
                    chosen = shingles[np.lexsort((shingles, counts[_slots(shingles)]))[:first]]
                    rows.append((np.full(first, n), np.full(first, c), np.full(first, m), m - np.arange(first), chosen.view(np.int64)))
                columns = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["n", "c", "m", "left", "s"])

    return lines.select("n", "c", "line").mapInArrow(run, "n long, c long, m long, left long, s long")


def similar_pairs(pairs: DataFrame, similar: float) -> DataFrame:
    """The (a, b) of rows (a, line_a, b, line_b) whose lines have a Jaccard similarity of `similar` or more."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        size = 0

        def of(n: int, line: str) -> np.ndarray:
            nonlocal size
            if n not in held:
                if size > 1 << 21:
                    held.clear()
                    size = 0
                held[n] = shingle_hashes(line)
                size += len(held[n])
            return held[n]

        for batch in batches:
            for part in chunks(batch, "line_a", 1 << 18):
                keep = [share_at_least(of(a, x), of(b, y), similar) for a, x, b, y in zip(*(c.to_pylist() for c in part.columns))]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "line_a", "b", "line_b").mapInArrow(run, "a long, b long")
