"""Nearest neighbours by collision counting over single-projection sorted arrays.

Vectors are scaled to length 1 and projected on random lines. In each block of vectors
every line has its own sorted array of projections. A query opens a window around its
own projection on each line; while it widens (virtual rehashing: the window of a larger
radius contains that of a smaller one, so only new ends are read while they are short), vectors collect
collisions, and one that collides on enough lines is verified by its true cosine. A
query stops when its k-th verified distance is within the radius, or at the distance
that a bounded sample shows to be enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lines, window width per radius, and standard deviations that the threshold of collisions
# stands below the count expected of a vector at the radius.
LINES = 48
WIDTH = 2.72
SLACK = 3.0
# Share of a vector's lines that collide at the radius: P(|N(0, 1)| <= WIDTH / 2).
HIT = 0.826
STEPS = (0.35, 0.5, 0.7, 0.85, 1.0)
# New ends are read while they hold less than this part of a block's places.
READ = 16
# Vectors in a block, queries that meet a block in one task, vectors that bound the radius.
BLOCK = 8192
QUERIES_AT_ONCE = 1024
SAMPLE = 4096


@lru_cache(maxsize=8)
def lines(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, LINES))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``q``, added up in one order for every row."""
    return np.einsum("ij,j->i", x, q) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * sqrt(float(np.einsum("i,i->", q, q))))


def repeats(ids: np.ndarray) -> bool:
    return len(np.unique(ids)) < len(ids)


def per_id(ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The largest value of each id."""
    order = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.r_[True, ids[order][1:] != ids[order][:-1]])
    return np.maximum.reduceat(values[order], firsts)


def best(ids: np.ndarray, x: np.ndarray, rough: np.ndarray, q: np.ndarray, k: int, repeated: bool, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest ids of ``rows`` by their nearest row, ties to the smaller id: exact for all
    that could be among them. ``repeated`` tells whether rows may share an id."""
    tops = per_id(ids[rows], rough[rows]) if repeated else rough[rows]
    if len(tops) > k:
        rows = rows[rough[rows] >= np.partition(tops, -k)[-k] - 1e-9]
    ids, score = ids[rows], cosines(x[rows], q)
    order = np.lexsort((ids, -score))
    if repeated:
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
    order = order[:k]
    return ids[order], score[order]


def search_block(k: int):
    """Function of a block's vectors and its queries, giving ``query_id, vec_id, score``."""
    least = ceil(LINES * HIT - SLACK * sqrt(LINES * HIT * (1 - HIT)))

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(vectors) and len(queries):
            ids = vectors.vec_id.to_numpy()
            repeated = repeats(ids)
            x = np.array(vectors.embedding.tolist(), np.float64)
            u = unit(x)
            n, a = len(u), lines(x.shape[1])
            projected = u @ a
            order = np.argsort(projected, axis=0, kind="stable").T.copy()
            block = Arrays(np.sort(projected, axis=0).T.copy(), order)
            q = np.array(queries.vector.tolist(), np.float64)
            uq, radius = unit(q), queries.radius.to_numpy()
            left, right = block.windows(uq @ a, np.where(np.isfinite(radius), radius, 0.0))
            for i, query_id in enumerate(queries.query_id):
                rough = u @ uq[i]
                if np.isfinite(radius[i]):
                    seen = collected(block, left[:, i], right[:, i], rough, radius[i], least, k, ids if repeated else None)
                else:
                    seen = np.arange(n)
                seen = seen[ids[seen] != query_id]
                if len(seen):
                    found, score = best(ids, x, rough, q[i], k, repeated, seen)
                    out.extend((query_id, j, s) for j, s in zip(found.tolist(), score.tolist()))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


class Arrays:
    """Sorted array of each line, with the vector at each place and the place of each vector."""

    def __init__(self, values: np.ndarray, order: np.ndarray):
        self.values, self.order, self.n = values, order, values.shape[1]
        self.places = np.empty(order.shape, np.uint16 if self.n < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(self.n, dtype=self.places.dtype)[None], axis=1)

    def windows(self, center: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of every window (step, query, line)."""
        half = WIDTH / 2 * radius * np.array(STEPS)[:, None]
        left, right = np.empty((2, *half.shape, LINES), np.int64)
        for i, values in enumerate(self.values):
            left[:, :, i] = np.searchsorted(values, center[:, i] - half, "left")
            right[:, :, i] = np.searchsorted(values, center[:, i] + half, "right")
        return left, right

    def collisions(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Lines on which each vector is in the window, by its places."""
        kind = self.places.dtype
        inside = self.places - left.astype(kind)[:, None] < (right - left).astype(kind)[:, None]
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64)


def candidates(arrays, order, center, uq, u, radius, least, k, ids=None) -> np.ndarray:
    """``collected`` for one query, by its projections ``center``."""
    block = Arrays(arrays, order)
    left, right = block.windows(center[None], np.array([radius]))
    return collected(block, left[:, 0], right[:, 0], u @ uq, radius, least, k, ids)


def collected(block: Arrays, left, right, rough, radius, least, k, ids=None) -> np.ndarray:
    """Verified vectors: those with ``least`` collisions by the radius at which the query stops.
    ``left`` and ``right`` are the query's windows (step, line). Short new ends of a window are
    read from the arrays; where they hold much of the block, the places of all vectors are
    compared. With ``ids``, rows of an id count once for the stop, by the nearest."""
    counts = np.zeros(block.n, np.int64)
    lo = hi = None
    for step, l, r in zip(STEPS, left, right):
        new = int((r - l).sum()) if lo is None else int((lo - l + r - hi).sum())
        if new * READ > LINES * block.n:
            counts = block.collisions(l, r)
        elif new:
            ends = zip(block.order, l, r, r, r) if lo is None else zip(block.order, l, lo, hi, r)
            counts += np.bincount(np.concatenate([part for order, a, b, c, d in ends for part in (order[a:b], order[c:d])]), minlength=block.n)
        lo, hi = l, r
        seen = np.flatnonzero(counts >= least)
        if len(seen) > k:
            # Enough verified vectors (the query itself may be one) within the radius so far.
            tops = rough[seen]
            if ids is not None:
                tops = per_id(ids[seen], tops)
            if len(tops) > k and np.partition(2 - 2 * tops, k)[k] <= (radius * step) ** 2:
                break
    return seen


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose id is given and whose vector is given, finite and not zero."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where("vec_id is not null").where(F.forall("embedding", good) & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row of ``queries``.

    Both tables have ``vec_id, embedding``. Vectors that are null, empty, zero or hold
    null or non-finite components take no part; vectors of another length than the
    query's are no candidates. A query is no candidate of itself: rows of its id are left
    out. Rows that share an id are one candidate, by their nearest vector, and one query,
    by their least vector. Ties go to the smaller id; with fewer than k candidates all
    are returned.

    Every query meets every block (a stated query set, in blocks); blocks and groups of
    queries are bounded. Each block returns k ids a query, and so does the sample of at
    most ``SAMPLE`` vectors that bounds the radius.
    """
    rows = usable(vectors)
    asked = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("vector")).withColumnRenamed("vec_id", "query_id")
    total, n_queries = rows.count(), asked.count()
    share = min(1.0, SAMPLE * 0.9 / max(1, total))
    drawn = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(3), "vec_id", "embedding"), 12) < int(share * (1 << 52))).limit(SAMPLE).collect()
    by_dim: dict[int, tuple] = {}
    for dim in {len(r.embedding) for r in drawn}:
        own = [r for r in drawn if len(r.embedding) == dim]
        by_dim[dim] = (np.array([r.vec_id for r in own]), np.array([r.embedding for r in own]))
    schema = pa.schema([("query_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("radius", pa.float64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])

    def bound(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {d: unit(x) for d, (_, x) in by_dim.items()}
        repeated = {d: repeats(ids) for d, (ids, _) in by_dim.items()}
        for part in parts:
            out = []
            for query_id, vector in zip(*[c.to_pylist() for c in part.columns]):
                q = np.array(vector)
                ids, x = by_dim.get(len(q), (np.empty(0, np.int64), np.empty((0, len(q)))))
                other = ids != query_id
                found, score = np.empty(0, np.int64), np.empty(0)
                if other.any():
                    found, score = best(ids, x, units[len(q)] @ unit(q[None])[0], q, k, repeated[len(q)], np.flatnonzero(other))
                radius = sqrt(max(0.0, 2 - 2 * score[-1])) + 1e-6 if len(found) == k else float("inf")
                out.append((query_id, vector, radius, found, score))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    bounded = asked.mapInArrow(bound, "query_id long, vector array<double>, radius double, ids array<long>, scores array<double>")
    blocks, chunks = ceil(max(1, total) / BLOCK), ceil(max(1, n_queries) / QUERIES_AT_ONCE)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = rows.withColumn("block", (F.monotonically_increasing_id() % blocks).cast("int")).withColumn("dim", F.size("embedding")).withColumn("chunk", every(chunks))
    sent = bounded.select("query_id", "vector", "radius", F.pmod(F.hash("query_id"), F.lit(chunks)).alias("qchunk"), F.size("vector").alias("qdim"), every(blocks).alias("qblock"))
    met = placed.groupBy("block", "chunk", "dim").cogroup(sent.groupBy("qblock", "qchunk", "qdim"))
    found = met.applyInPandas(search_block(k), "query_id long, vec_id long, score double")
    sample = bounded.select("query_id", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    pairs = found.unionByName(sample).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
