"""Approximate nearest neighbours by collision counting (largest inner product).

Inner products become distances: with M the largest norm, a vector x gets one
more coordinate, sqrt(M^2 - |x|^2), and a query, scaled to norm M, a zero, so
the nearest vector is the one with the largest inner product.

Vectors are dealt by a hash into blocks; queries are a stated set and meet
every block, a block of queries at a time.  In a cell (vectors x queries):

1. every projection on a line (the axes of random rotations) gives one sorted
   array of the block's vectors;
2. a query opens a window around its own place in each array.  Virtual
   rehashing widens all windows step by step, and each step only counts the
   vectors that have just come in;
3. a vector whose collisions (windows that hold it) reach ``THRESHOLD`` of the
   projections is a candidate; widening ends with ``VERIFY_TOP * top`` plus a
   ``VERIFY`` share of the block as candidates, or when the windows hold all;
4. candidates are verified: their exact inner product in double precision on
   the original vectors.

A block's best ``top`` of each query go on, and the best of those are ranked.
Every row is indexed.  Blocks bound a task's memory; equal vectors have
different ids and spread over all blocks.

Nulls and the like: vectors that are null, zero or hold a null or non-finite
component take no part, nor do rows with a null id.  Vectors meet only vectors
of their own dimension.  A repeated row is a candidate each time; a query is
asked once for each of its rows that differ and never meets its own id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VECTOR_BLOCK = 16_384
QUERY_BLOCK = 1024
PROJECTIONS = 64           # at least; whole rotations of low-dimensional vectors
THRESHOLD = 0.7            # share of the windows that must hold a candidate
VERIFY_TOP, VERIFY = 25, 0.07   # candidates that end the widening: so many times ``top``, and a share of the block
FIRST, STEP = 0.9, 0.08   # half-width of the windows, in deviations of the projections

ANSWER = "query_id bigint, vec_id bigint, score double"


def rotation(dim: int) -> np.ndarray:
    """At least ``PROJECTIONS`` unit vectors: the axes of random rotations."""
    draw = np.random.default_rng(dim)
    axes = [np.linalg.qr(draw.standard_normal((dim, dim)))[0] for _ in range(-(-PROJECTIONS // dim))]
    return np.concatenate(axes, axis=0)[:max(PROJECTIONS, min(dim, 4 * PROJECTIONS))]


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        lift = np.sqrt(np.maximum(largest ** 2 - (vectors ** 2).sum(axis=1), 0))
        self.axes = rotation(vectors.shape[1] + 1)
        placed = np.column_stack([vectors, lift]) @ self.axes.T
        self.order = np.argsort(placed, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(placed.T, self.order, axis=1)
        self.unit = float(placed.std()) or 1.0
        self.need = int(np.ceil(THRESHOLD * len(self.axes)))

    def windows(self, centre: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of each query's window in each sorted array."""
        reach = width * self.unit
        lo = [row.searchsorted(c - reach, "left") for row, c in zip(self.sorted, centre.T)]
        hi = [row.searchsorted(c + reach, "right") for row, c in zip(self.sorted, centre.T)]
        return np.stack(lo, axis=1), np.stack(hi, axis=1)

    def candidates(self, queries: np.ndarray, top: int):
        """(query, places of the vectors that collide often enough with it)."""
        n, m = len(self.ids), len(self.axes)
        enough, width = min(n, VERIFY_TOP * top + int(VERIFY * n)), FIRST
        centre = queries * (self.largest / np.sqrt((queries ** 2).sum(axis=1)))[:, None] @ self.axes[:, :-1].T
        active = np.arange(len(queries))
        counts: dict[int, np.ndarray] = {}
        lo = hi = np.zeros((len(queries), m), np.int64)
        while len(active):
            a, b = self.windows(centre[active], width)
            open_ = []
            for i, (q, x, y) in enumerate(zip(active.tolist(), a, b)):
                if q in counts:   # what has come in on either side
                    pieces = [(o, f, t) for o, f, t in zip(self.order, x.tolist(), lo[i].tolist())] + [(o, f, t) for o, f, t in zip(self.order, hi[i].tolist(), y.tolist())]
                else:
                    pieces = zip(self.order, x.tolist(), y.tolist())
                now = np.bincount(np.concatenate([o[f:t] for o, f, t in pieces]), minlength=n).astype(np.uint16)
                counts[q] = now = now + counts.pop(q) if q in counts else now
                found = np.flatnonzero(now >= self.need)
                if len(found) >= enough or int((y - x).sum()) == n * m:
                    del counts[q]
                    yield q, found
                else:
                    open_.append(i)
            active, lo, hi = active[open_], a[open_], b[open_]
            width += STEP

    def best(self, query_ids: np.ndarray, queries: np.ndarray, top: int):
        """(query, ids, inner products) of the verified candidates that rank first."""
        for q, found in self.candidates(queries, top):
            query = queries[q]
            found = found[self.ids[found] != query_ids[q]]
            rough = self.vectors[found] @ query
            if len(found) > top:     # the matrix product may round equal rows differently
                least = np.partition(rough, len(found) - top)[len(found) - top]
                found = found[rough >= least - 1e-9 * max(1.0, float(np.abs(rough).max()))]
            exact = (self.vectors[found] * query).sum(axis=1)
            order = np.lexsort((self.ids[found], -exact))[:top]
            yield q, self.ids[found][order], exact[order]


def _matrix(column, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, vector, dim and norm of the rows that take part."""
    v = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")).filter("vec_id IS NOT NULL")
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return (v.filter(finite & F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))
            .withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))))


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each row of
    ``queries`` among all rows of ``vectors``."""
    base, asked = valid_vectors(vectors, vec_id, embedding), valid_vectors(queries, vec_id, embedding).distinct()
    sizes = base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("largest"))
    blocks = F.ceil(F.col("n") / VECTOR_BLOCK)
    asked_sizes = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks"))
    sizes = sizes.join(asked_sizes, "dim").select("dim", "largest", blocks.alias("vector_blocks"), "query_blocks").checkpoint()
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    left = (base.join(sizes, "dim").withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.col("vector_blocks")))
            .select("dim", "largest", "vb", every("query_blocks").alias("qb"), "vec_id", "vector"))
    right = (asked.join(sizes, "dim").withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("query_blocks")))
             .select("dim", every("vector_blocks").alias("vb"), "qb", F.col("vec_id").alias("query_id"), "vector"))

    def search(vectors, queries):
        import pyarrow as pa

        if not vectors.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dim = vectors.column("dim")[0].as_py()
        block = Block(vectors.column("vec_id").to_numpy(), _matrix(vectors.column("vector"), dim), vectors.column("largest")[0].as_py())
        asked = queries.column("query_id").to_numpy()
        got = list(block.best(asked, _matrix(queries.column("vector"), dim), top))
        return pa.table({"query_id": np.repeat(asked[[g[0] for g in got]], [len(g[1]) for g in got]),
                         "vec_id": np.concatenate([g[1] for g in got]), "score": np.concatenate([g[2] for g in got])})

    key = ["dim", "vb", "qb"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, ANSWER)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
