"""Exact top-k search by inner product with vector-approximation files.

A component x counts as floor(64 x).  A shard's approximation file, built and
written once with the shard, holds, for every vector, the cell (of ``CELLS`` equal ones per dimension) each component
lies in.  A scan of the cells bounds every score from both sides; vectors
whose upper bound is below the k-th best lower bound are never read.  The
others are read exactly in the order of their bounds, a few at a time, until
the k-th best exact score is above every bound that is left (ties are read,
as the smaller id wins).  Shards' results are merged by one top-k a query.

Cases: see ``vectors``; a query with fewer candidates than k gets them all;
zero vectors take part; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .vectors import Shard, blocks, ranked, search, shards, usable

K = 20
SCALE = 64.0
CELLS = 16
SHARD = 4096
QUERIES = 2048
STRIP = 128


class VAFile:
    """Cells of the rows of ``x`` (as written: a byte each, after the least
    value and the width of every dimension)."""

    def __init__(self, x: np.ndarray, file: bytes):
        self.x, dim = x, x.shape[1]
        self.low, self.width = np.frombuffer(file, np.float64, 2 * dim).reshape(2, dim)
        self.cell = np.frombuffer(file, np.uint8, offset=16 * dim).reshape(x.shape)

    @staticmethod
    def build(x: np.ndarray, cells: int = CELLS) -> bytes:
        low = x.min(0)
        width = np.maximum((x.max(0) - low + 1) / cells, 1e-12)
        cell = np.minimum((x - low) // width, cells - 1).astype(np.uint8)
        return low.tobytes() + width.tobytes() + cell.tobytes()

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of every query's score with every vector, from cells alone."""
        middle = self.low + (self.cell + 0.5) * self.width
        reach = (np.abs(q) @ (self.width / 2))[:, None] * (1 + 1e-9) + 1e-6
        at = q @ middle.T
        return at - reach, at + reach

    def top(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of each query's k best, -1 where there are fewer;
        ``own``: place of the query itself among the vectors, or -1."""
        n = len(self.x)
        lower, upper = self.bounds(q)
        rows = np.arange(len(q))
        lower[rows[own >= 0], own[own >= 0]] = upper[rows[own >= 0], own[own >= 0]] = -np.inf
        sure = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
        most = int((upper >= sure[:, None]).sum(1).max())
        order = np.argpartition(-upper, most - 1, axis=1)[:, :most] if most < n else np.tile(np.arange(n), (len(q), 1))
        bound = np.take_along_axis(upper, order, 1)
        by = np.argsort(-bound, axis=1, kind="stable")
        order, bound = np.take_along_axis(order, by, 1), np.take_along_axis(bound, by, 1)
        best, score = np.full((len(q), k), n), np.full((len(q), k), -np.inf)
        open_, at = rows, 0
        while len(open_) and at < most:
            read = order[open_, at:at + k]
            exact = np.einsum("ij,ikj->ik", q[open_], self.x[read])
            exact[bound[open_, at:at + k] == -np.inf] = -np.inf
            s, p = np.hstack([score[open_], exact]), np.hstack([best[open_], read])
            p[s == -np.inf] = n
            take = np.lexsort((p, -s), axis=1)[:, :k]
            score[open_], best[open_] = np.take_along_axis(s, take, 1), np.take_along_axis(p, take, 1)
            at += k
            if at < most:
                open_ = open_[score[open_, -1] <= bound[open_, at]]
        return np.where(score > -np.inf, best, -1), score


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): ``vectors`` as from ``usable``, ``queries`` some of them."""

    def best(s: Shard) -> tuple[np.ndarray, np.ndarray]:
        file, q = VAFile(np.floor(SCALE * s.x), s.index), np.floor(SCALE * s.q)
        parts = [file.top(q[i:i + STRIP], s.own[i:i + STRIP], min(k, len(s.x))) for i in range(0, len(q), STRIP)]
        place, score = (np.concatenate(p) for p in zip(*parts))
        return place, np.where(place >= 0, score, 0)

    coded = shards(vectors, shard, lambda x: VAFile.build(np.floor(SCALE * x)))
    return ranked(search(coded, blocks(queries, block), best, "long"), queries, F.col("score").desc(), k)


def op4_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(C.read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


ORACLE = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.row AS query, q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.row <> c.row AND len(q.vec) = len(c.vec)
    WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
"""
