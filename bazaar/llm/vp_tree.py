"""Approximate nearest neighbours with a vantage-point tree per shard.

A node holds a vantage point and the median distance from it; the nearer half
goes inside, the rest outside.  With r the k-th best distance so far, a query
at distance d from the vantage point leaves out the outside if d + r < median
and the inside if d - r > median.  The search relaxes this by a ``factor``: r
/ factor takes the place of r.  Factor 1 is the exact search; a larger one
prunes more and may miss.  A shard's tree is built and written once, with the
shard.  Shards' results are merged by one top-k a query.

Cases: see ``vectors``; zero vectors take no part; a query with fewer
candidates than k gets all that are found; ties go to the smaller id; an
empty table gives an empty one.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .vectors import Shard, blocks, ranked, search, shards, usable

K = 10
FACTOR = 6.0
LEAF = 64
SHARD = 2048
QUERIES = 2048


class VPTree:
    """Over the rows of ``x``; ``root``: the nodes, where they are built already."""

    def __init__(self, x: np.ndarray, root=None, leaf: int = LEAF):
        self.x, self.leaf = x, leaf
        self.square = np.einsum("ij,ij->i", x, x)
        self.root = self._build(np.arange(len(x))) if root is None else root

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        point, rest = at[0], at[1:]
        d = np.sqrt(((self.x[rest] - self.x[point]) ** 2).sum(1))
        median = float(np.median(d))
        near = d <= median
        if near.all():  # many equal distances: halves of equal standing
            near = np.arange(len(rest)) < len(rest) // 2
            low, high = float(d.min()), float(d.max())
        else:
            low, high = float(d[~near].min()), median
        return point, low, high, self._build(rest[near]), self._build(rest[~near])

    def search(self, own: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of each query's k nearest found but its ``own``
        place; ties go to the lesser place."""
        self.q, self.own, self.factor = q, own, factor
        self.q_square = np.einsum("ij,ij->i", q, q)
        self.best = np.full((len(q), k), np.iinfo(np.int64).max)
        self.dist = np.full((len(q), k), np.inf)
        self._visit(self.root, np.arange(len(q)))
        return self.best, self.dist

    def _meet(self, at: np.ndarray, rows: np.ndarray) -> None:
        """Let queries ``rows`` see the vectors ``at``: exact distances for those within reach."""
        reach = self.dist[rows, -1] ** 2
        square = self.q_square[rows][:, None] + self.square[at] - 2 * (self.q[rows] @ self.x[at].T)
        slack = 1e-9 * (self.q_square[rows][:, None] + self.square[at])
        near = (square <= reach[:, None] + slack) & (at != self.own[rows][:, None])
        some = near.any(1)
        rows, near = rows[some], near[some]
        i, j = np.nonzero(near)
        exact = np.full(near.shape, np.inf)
        exact[i, j] = np.sqrt(((self.q[rows[i]] - self.x[at[j]]) ** 2).sum(1))
        d = np.hstack([self.dist[rows], exact])
        p = np.hstack([self.best[rows], np.broadcast_to(at, near.shape)])
        take = np.lexsort((p, d), axis=1)[:, :self.dist.shape[1]]
        self.dist[rows], self.best[rows] = np.take_along_axis(d, take, 1), np.take_along_axis(p, take, 1)

    def _visit(self, node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._meet(node, rows)
            return
        point, low, high, inside, outside = node
        self._meet(np.array([point]), rows)
        d = np.sqrt(((self.q[rows] - self.x[point]) ** 2).sum(1))
        inner = d <= (low + high) / 2
        self._visit(inside, rows[inner])
        self._visit(outside, rows[~inner])
        # The other side, where the relaxed triangle inequality does not rule it out.
        r = self.dist[rows, -1] / self.factor * (1 + 1e-9) + 1e-12
        self._visit(outside, rows[inner & (d + r >= low)])
        self._visit(inside, rows[~inner & (d - r <= high)])


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, shard: int = SHARD,
               block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): ``vectors`` as from ``usable``, ``queries`` some of them."""

    def nearest(s: Shard) -> tuple[np.ndarray, np.ndarray]:
        place, dist = VPTree(s.x, pickle.loads(s.index)).search(s.own, s.q, k, factor)
        return np.where(np.isfinite(dist), place, -1), dist

    coded = shards(vectors, shard, lambda x: pickle.dumps(VPTree(x).root))
    return ranked(search(coded, blocks(queries, block), nearest, "double"), queries, F.col("score"), k)


def op6_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(C.read(spark, sf_dir, "embeddings"), "vec_id", "embedding", zero=False)
    return neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
