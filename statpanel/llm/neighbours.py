"""Nearest neighbours by cosine: a block matrix join over int8 tiles with error bounds."""

from __future__ import annotations

import heapq
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statpanel.llm.common import written

FOUND = "q long, query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding, dim) that take part: no nulls, no non-finite component, not zero. Floats stay floats, all else is taken as doubles."""
    kept = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    embedding = F.col("embedding") if kept else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.filter("vec_id is not null and embedding is not null and size(embedding) > 0")
    rows = rows.filter(F.forall("embedding", finite)).filter(F.exists("embedding", lambda x: x != 0))
    return rows.withColumn("dim", F.size("embedding"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return (np.concatenate(flat) if flat else np.zeros(0, np.float32)).reshape(-1, dim)


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows in double over their largest component, so that squares of tiny or huge ones stay in range."""
    m = m.astype(np.float64)
    return m / np.abs(m).max(axis=1, keepdims=True)


def _quantised(m: np.ndarray):
    """Unit rows as int8 steps: scale, steps, length of the steps' row, length of the error."""
    unit = _scaled(m)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    steps = np.rint(unit / scale[:, None]).astype(np.int8)
    near = steps * scale[:, None]
    return scale, steps, np.sqrt((near * near).sum(axis=1)), np.sqrt(((unit - near) ** 2).sum(axis=1)), unit


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision; equal rows give equal values."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _tile(candidates: pa.Table, queries: pa.Table, k: int, step: int = 512) -> pa.Table:
    """The k best candidates of this tile for each of its queries.

    cos(q, c) differs from the product of the int8 rows by at most |q'| |c - c'| + |q - q'| |c| (primes: quantised), so a candidate whose
    upper bound lies below the k-th best lower bound cannot be among the k best. The rest is computed again in double.
    """
    out: list[tuple] = []
    if candidates.num_rows and queries.num_rows:
        dim = candidates["dim"][0].as_py()
        ids, m = candidates["vec_id"].to_numpy(), _matrix(candidates["embedding"], dim)
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        scale, steps, length, error, _ = _quantised(m)
        numbers, qids = queries["q"].to_numpy(), queries["vec_id"].to_numpy()
        q = _matrix(queries["embedding"], dim)
        qscale, qsteps, qlength, qerror, _ = _quantised(q)
        # Products of int8 rows are whole numbers below 2**24 up to 1,040 components, and so exact in float32.
        exact = np.float32 if dim <= 1040 else np.float64
        steps = steps.astype(exact).T.copy()
        for at in range(0, len(qids), step):
            part = slice(at, at + step)
            near = (qsteps[part].astype(exact) @ steps) * (qscale[part, None] * scale[None, :])
            slack = qlength[part, None] * error[None, :] + qerror[part, None] + 1e-9
            own = qids[part, None] == ids[None, :]
            low = np.where(own, -np.inf, near - slack)
            if low.shape[1] > k:
                floor = np.partition(low, -k, axis=1)[:, -k]
            else:
                floor = np.full(len(low), -np.inf)
            rows, cols = np.nonzero(~own & (near + slack >= floor[:, None]))
            score = np.empty(len(rows))
            for s in range(0, len(rows), 65536):
                some = slice(s, s + 65536)
                score[some] = cosine(q[part][rows[some]], m[cols[some]])
            best = np.lexsort((ids[cols], -score, rows))
            rows, cols, score = rows[best], cols[best], score[best]
            first = np.searchsorted(rows, rows, side="left")
            keep = np.arange(len(rows)) - first < k
            out.append((numbers[part][rows[keep]], qids[part][rows[keep]], ids[cols[keep]], score[keep]))
    joined = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
    return pa.table(dict(zip(("q", "query_id", "vec_id", "score"), joined)))


def _merged(found: pa.Table, k: int) -> pa.Table:
    """Merge the tiles' short lists of each query by a heap."""
    lists: dict[tuple[int, int], dict[int, list]] = {}
    for q, query, tile, vec, score in zip(*(found[c].to_pylist() for c in ("q", "query_id", "tile", "vec_id", "score"))):
        lists.setdefault((q, query), {}).setdefault(tile, []).append((-score, vec))
    out = []
    for (_, query), tiles in lists.items():
        best = islice(heapq.merge(*(sorted(x) for x in tiles.values())), k)
        out += [(query, rank, vec, -minus) for rank, (minus, vec) in enumerate(best, 1)]
    names = [("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())]
    return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out) if out else [[]] * 4, names)], [n for n, _ in names])


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, tile_rows: int = 16384, tile_queries: int = 4096, merge_rows: int = 1 << 18
) -> DataFrame:
    """The k rows of `vectors` with the largest cosine to each row of `queries` (both vec_id, embedding).

    Candidates are cut into strips of about `tile_rows` rows and queries into strips of about `tile_queries`; each pair of strips meets in
    one task as a tile, which holds no more than that, and keeps k rows per query; a group of queries whose lists are merged holds about
    `merge_rows` of these. Exact: int8 products only rule out
    what their error bound proves to be farther. Nearest first, ties to the smaller vec_id, rank from 1, all candidates if fewer than k.

    Rows with a null id, null, empty or zero vectors or null or non-finite components take no part, on either side.
    Vectors of different lengths do not meet. A candidate with the query's vec_id is the query itself; otherwise rows that repeat
    an id are separate candidates, and separate queries. Other columns are ignored. Empty tables give an empty result.
    """
    rows = written(usable(vectors), "nn-rows")
    asked = written(usable(queries).withColumn("q", F.monotonically_increasing_id()), "nn-queries")
    strips = max(1, -(-rows.count() // tile_rows))
    questions = asked.count()
    columns = max(1, -(-questions // tile_queries))
    number = F.monotonically_increasing_id()
    left = rows.select("*", F.pmod(number, F.lit(strips)).alias("r"))
    left = left.select("*", F.explode(_numbers(columns)).alias("c"))
    right = asked.select("*", F.pmod(number, F.lit(columns)).alias("c"))
    right = right.select("*", F.explode(_numbers(strips)).alias("r"))
    keys = ["dim", "r", "c"]

    def tile(key, a: pa.Table, b: pa.Table) -> pa.Table:
        found = _tile(a, b, k)
        return found.append_column("tile", pa.array(np.full(found.num_rows, key[1].as_py(), np.int64)))

    tiles = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, FOUND + ", tile long")
    # A query has a list of k rows from each strip, so the groups grow in number with the strips, and not in size.
    groups = max(8, -(-questions * strips * k // merge_rows))
    merged = tiles.groupBy(F.pmod(F.xxhash64("q"), F.lit(groups)).alias("g"))
    return merged.applyInArrow(
        lambda t: _merged(t, k), "query_id long, rank int, vec_id long, score double"
    )
