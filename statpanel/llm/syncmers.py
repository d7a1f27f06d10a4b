"""Document fingerprints from closed syncmers.

A window of K characters is a closed syncmer if the least hash of its inner strings of S characters lies at one of its two edges. That
depends on the window alone, so an edit moves only the anchors that it touches. A fingerprint keeps the anchors with the smallest
hashes and their places; two fingerprints are compared by anchors that both hold at places consistent with one shift.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, S = 12, 5
#: Anchors kept per fingerprint, characters per step of place, characters hashed at a time.
KEPT, PLACE, BLOCK = 64, 16, 1 << 18
#: Odd multipliers for hashing; any would do.
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[1]
    x = (x ^ (x >> np.uint64(29))) * _M[2]
    return x ^ (x >> np.uint64(32))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of all closed syncmers, block by block: blocks overlap by a window, and need no other context."""
    hashes, places = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for at in range(0, max(len(points) - K + 1, 0), BLOCK):
        part = points[at : at + BLOCK + K - 1].astype(np.uint64)
        n = len(part) - S + 1
        inner = part[:n].copy()
        for i in range(1, S):
            inner *= _M[0]
            inner += part[i : i + n]
        inner = _mix(inner)
        span = K - S + 1
        least, width = inner, 1
        while 2 * width <= span:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < span:
            least = np.minimum(least[: n - span + 1], least[span - width :])
        found = np.nonzero((least == inner[: n - span + 1]) | (least == inner[span - 1 :]))[0]
        whole = inner[found] * _M[3] + inner[found + S] * _M[4] + inner[found + K - S]
        hashes.append((_mix(whole) >> np.uint64(32)).astype(np.uint32))
        places.append(found + at)
    return np.concatenate(hashes), np.concatenate(places)


def fingerprint(text: str) -> str:
    """The KEPT smallest distinct anchor hashes, 8 hex digits each, with 6 hex digits of the first place in steps of PLACE characters.

    A text shorter than K characters is one anchor, the empty text has none and gives the empty string.
    """
    points = code_points(text)
    if 0 < len(points) < K:
        padded = np.append(points, np.full(K - len(points), 0x110000, "<u4"))
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for p in padded:
                value = _mix(np.array([value * _M[0] + np.uint64(p)]))[0]
        hashes, places = np.array([value >> np.uint64(32)], np.uint32), np.zeros(1, np.int64)
    else:
        hashes, places = anchors(points)
    if len(hashes) > 4 * KEPT:
        few = hashes <= np.partition(hashes, 4 * KEPT)[4 * KEPT]
        if len(np.unique(hashes[few])) >= KEPT:
            hashes, places = hashes[few], places[few]
    hashes, first = np.unique(hashes, return_index=True)  # the first place of each
    places = np.minimum(places[first] // PLACE, 0xFFFFFF)
    return "".join(f"{h:08x}{p:06x}" for h, p in zip(hashes[:KEPT].tolist(), places[:KEPT].tolist()))


def _read(fp: str) -> dict[int, int]:
    return {int(fp[i : i + 8], 16): int(fp[i + 8 : i + 14], 16) for i in range(0, len(fp), 14)}


def likeness(a: str, b: str) -> float:
    """0 to 1: of the smallest anchors of both together, the share that both hold at places that fit one shift.

    Estimates the Jaccard similarity of the texts' anchors. Equal fingerprints give 1, also two empty ones; an empty and another give 0.
    """
    if a == b:
        return 1.0
    a, b = _read(a), _read(b)
    if not a or not b:
        return 0.0
    least = sorted(a.keys() | b.keys())[: KEPT]
    shared = [h for h in least if h in a and h in b]
    if not shared:
        return 0.0
    shifts = sorted(a[h] - b[h] for h in shared)
    middle = shifts[len(shifts) // 2]
    slack = 16 + max(*a.values(), *b.values()) // 10
    return sum(abs(a[h] - b[h] - middle) <= slack for h in shared) / len(least)


def edited(text: str, following: str) -> str:
    """The last third of the text, rounded down, replaced by as many characters from the start of the next one, or all."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint of each row; null text counts as empty. Other columns are ignored."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = pa.array([fingerprint(t) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), out], ["doc_id", "text", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, text string, fingerprint string")


def _following(docs: DataFrame) -> DataFrame:
    """(part, ahead, late, back, h, doc_id, text): rows cut into parts by descending doc_id, and to each part the row that follows it.

    The parts are quantiles of the ids, four for each partition of Spark's shuffle, so that hashing them deals them evenly. The first row of every part also goes, as `ahead`, to the part before, the
    first of all to the last one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(
        {"late": F.col("doc_id").isNull(), "back": F.bitwise_not(F.coalesce("doc_id", F.lit(0))), "h": F.xxhash64("text")}
    )
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = rows.filter("not late").select(F.col("back").cast("double").alias("at"))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(number.approxQuantile("at", shares, 0.1 / wanted))) if shares else []
    if cuts:
        cutter = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="part")
        rows = cutter.transform(rows.withColumn("at", F.col("back").cast("double"))).drop("at")
        rows = rows.withColumn("part", F.when(F.col("late"), float(len(cuts))).otherwise(F.col("part")))
    else:
        rows = rows.withColumn("part", F.lit(0.0))
    # One row per part.
    heads = rows.groupBy("part").agg(F.min(F.struct("late", "back", "h")).alias("head"))
    heads = sorted((r["part"], tuple(r["head"])) for r in heads.collect())
    before = [(heads[i - 1][0], *head) for i, (_, head) in enumerate(heads)]
    before = F.broadcast(spark.createDataFrame(before, "before double, late boolean, back long, h long"))
    ahead = rows.drop("part").join(before, ["late", "back", "h"]).withColumnRenamed("before", "part")
    return rows.withColumn("ahead", F.lit(False)).unionByName(ahead.withColumn("ahead", F.lit(True)))


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc, text: str, fp: str, following: str, next_fp: str) -> tuple:
    changed = edited(text, following)
    changed_fp = fp if changed == text else fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc, len(text), digest, fp, changed_fp, likeness(fp, changed_fp), likeness(fp, next_fp)


def against_next(docs: DataFrame) -> DataFrame:
    """Fingerprints each text and its edited text, and compares it with both the edited text's and the next document's.

    Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The next document is the next in descending
    doc_id, after the last the first; equal doc_ids are ordered by a hash of their text, a null doc_id comes last. A document
    alone is its own next one. Texts are shuffled once, into sorted parts that each also hold the row that follows them, and a
    task holds one row until it sees the next. Null text is empty; repeated rows each follow another; an empty table gives an
    empty table; other columns are ignored.
    """
    rows = _following(docs)
    rows = rows.repartition("part").sortWithinPartitions("part", "ahead", "late", "back", "h").select("part", "ahead", "doc_id", "text")

    def run(batches):
        held = at = None
        for batch in batches:
            for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out = []
                for part, ahead, doc, text in zip(*(c.to_pylist() for c in some.columns)):
                    if part != at:
                        at, held = part, None
                    fp = fingerprint(text)
                    if held is not None:
                        out.append(_compared(*held, text, fp))
                    held = None if ahead else (doc, text, fp)
                yield _batch(out)

    return rows.mapInArrow(run, _ROW)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in _ROW.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
