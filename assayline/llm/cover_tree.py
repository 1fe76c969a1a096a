"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt in blocks, and every block of queries meets every block of candidates in
one task. Each block is indexed by a cover tree: a node has a centre, the radius that
covers all below it, and children about half as wide. A pair of nodes is left out when even
the largest product their radii allow is below the worst kth score of all queries in the
query node. The k best of every pair of blocks are merged per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from assayline.llm.tables import pick

SCHEMA = "query_id bigint, rank int, vec_id bigint, score bigint"
PAIR_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


@dataclass(frozen=True)
class SearchSettings:
    k: int = 5
    scale: int = 256
    # Queries are the rows whose id this number divides.
    every: int = 50
    # Vectors of a block, on average.
    queries: int = 1024
    candidates: int = 8192
    leaf: int = 128


class Node:
    __slots__ = ("centre", "length", "radius", "rows", "children", "worst")

    def __init__(self, centre, radius, rows, children):
        self.centre, self.radius, self.rows, self.children = centre, radius, rows, children
        self.length = float(np.sqrt(centre @ centre))
        self.worst = -np.inf


def cover_tree(points: np.ndarray, leaf: int) -> Node | None:
    """A cover tree over the rows of `points`; its first row is the root's centre."""
    if not len(points):
        return None
    rows = np.arange(len(points))
    return _grow(points, rows, _away(points, rows, 0), leaf)


def _away(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    gap = points[rows] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _grow(points, rows, away, leaf) -> Node:
    """`away`: distances from the first row, which is the centre."""
    radius = float(away.max())
    if len(rows) <= leaf or radius == 0.0:
        return Node(points[rows[0]], radius, rows, ())
    # Children cover half the radius each; in many dimensions that may part single points,
    # so the cover shrinks more slowly where half would take too many centres.
    for shrink in (0.5, 0.7, 0.85, 0.95):
        groups = _cover(points, rows, away, radius * shrink, max(2, len(rows) // leaf))
        if groups is not None:
            break
    else:
        far = int(away.argmax())
        other = _away(points, rows, int(rows[far]))
        mine = away <= other
        mine[0], mine[far] = True, False
        turned = np.r_[far, np.setdiff1d(np.flatnonzero(~mine), [far])]
        groups = [(rows[mine], away[mine]), (rows[turned], other[turned])]
    return Node(points[rows[0]], radius, rows, [_grow(points, r, a, leaf) for r, a in groups])


def _cover(points, rows, away, width, most):
    """Greedy cover by balls of `width`, each around its first row; None beyond `most`."""
    groups, left, distance = [], np.arange(len(rows)), away
    while len(left):
        if len(groups) == most:
            return None
        inside = distance <= width
        inside[0] = True
        groups.append((rows[left[inside]], distance[inside]))
        left = left[~inside]
        if len(left):
            distance = _away(points, rows[left], int(rows[left[0]]))
    return groups if len(groups) > 1 else None


class DualSearch:
    """The k best candidates of every query; ties go to the smaller id."""

    def __init__(self, queries, query_ids, candidates, ids, k: int, leaf: int):
        order = np.argsort(ids, kind="stable")  # then a smaller row is a smaller id
        self.q, self.query_ids, self.c, self.ids = queries, query_ids, candidates[order], ids[order]
        self.k = k
        # No sum of products exceeds the product of the lengths. Up to 2 ** 53 doubles hold
        # whole numbers exactly; beyond it products are of 64-bit whole numbers.
        longest = [float((np.square(x).sum(axis=1) if len(x) else np.zeros(1)).max()) ** 0.5 for x in (self.q, self.c)]
        self.none = -np.inf
        if longest[0] * longest[1] * (1 + 1e-9) >= 2.0**53:
            self.whole = self.q.astype(np.int64), self.c.astype(np.int64)
            self.none = -(2**63 - 1)
        else:
            self.whole = self.q, self.c
        self.scores = np.full((len(queries), k), self.none, self.whole[0].dtype)
        self.rows = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.leaf = leaf
        self.compared = 0

    def run(self):
        queries, candidates = cover_tree(self.q, self.leaf), cover_tree(self.c, self.leaf)
        if queries is not None and candidates is not None:
            self._visit(queries, [candidates])
        return self

    def _visit(self, q: Node, others: list[Node]) -> None:
        """Best candidates first; below the worst kth score of the group nothing counts."""
        if not q.children:
            self._search(q, others)
            q.worst = float(self.scores[q.rows, -1].min())
            return
        # Open every candidate node wider than the query node once, then go down.
        opened = []
        for c in others:
            opened += c.children if c.children and c.radius >= q.radius else [c]
        for child in q.children:
            child.worst = max(child.worst, q.worst)
            bound = self._bounds(child, opened)
            keep = [opened[k] for k in np.argsort(-bound, kind="stable") if bound[k] >= child.worst]
            self._visit(child, keep)
        q.worst = min(child.worst for child in q.children)

    @staticmethod
    def _bounds(q: Node, others: list[Node]) -> np.ndarray:
        centres = np.stack([c.centre for c in others])
        radii = np.array([c.radius for c in others])
        lengths = np.array([c.length for c in others])
        most = centres @ q.centre + q.length * radii + lengths * q.radius + radii * q.radius
        # Products are whole numbers; the slack covers the rounding of the square roots.
        return most + 1e-9 * (1.0 + np.abs(most))

    def _search(self, q: Node, others: list[Node]) -> None:
        """A leaf of queries against candidate nodes, best bound first."""
        while others:
            bound = self._bounds(q, others)
            worst = float(self.scores[q.rows, -1].min())
            order = [k for k in np.argsort(-bound, kind="stable") if bound[k] >= worst]
            deeper = []
            for k in order:
                if bound[k] < self.scores[q.rows, -1].min():
                    break
                c = others[k]
                if c.children:
                    deeper += c.children
                else:
                    self._compare(q.rows, c.rows)
            others = deeper

    def _compare(self, q: np.ndarray, c: np.ndarray) -> None:
        self.compared += len(q) * len(c)
        score = self.whole[0][q] @ self.whole[1][c].T
        score[self.query_ids[q][:, None] == self.ids[c][None, :]] = self.none
        # Only scores that may enter a query's list; a tie may, with a smaller id.
        enters = score >= self.scores[q, -1][:, None]
        some = np.flatnonzero(enters.any(axis=1))
        if not len(some):
            return
        columns = np.flatnonzero(enters.any(axis=0))
        q, c, score = q[some], c[columns], score[np.ix_(some, columns)]
        rows = np.hstack([self.rows[q], np.broadcast_to(c, score.shape)])
        score = np.hstack([self.scores[q], score])
        best = np.lexsort((rows, -score), axis=1)[:, : self.k]
        self.scores[q] = np.take_along_axis(score, best, 1)
        self.rows[q] = np.take_along_axis(rows, best, 1)

    def frame(self) -> pd.DataFrame:
        real = self.scores > self.none
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.query_ids, real.sum(axis=1)),
                "vec_id": self.ids[self.rows[real]],
                "score": self.scores[real].astype(np.int64),
            }
        )


def _usable(vectors: DataFrame, settings: SearchSettings, vec_id: str, embedding: str) -> DataFrame:
    """Whole-number vectors of rows that take part, with their dimension."""
    rows = pick(vectors, vec_id=vec_id, v=embedding).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    )
    sound = F.forall(
        "v",
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * settings.scale).cast("double"))
    return rows.where(sound).select("vec_id", whole.alias("v"), F.size("v").alias("size"))


def top_k(
    vectors: DataFrame,
    settings: SearchSettings = SearchSettings(),
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query.

    Rows with a null id, a null vector or a null or non-finite component take no part. Only
    vectors of one length can be multiplied, so a query meets those of its own length. Rows
    with the query's id are not its candidates; other repeated rows each count. A query
    without candidates has no rows.
    """
    rows = _usable(vectors, settings, vec_id, embedding)
    total = rows.count()
    blocks = max(1, -(-total // settings.candidates))
    groups = max(1, -(-total // (settings.every * settings.queries)))
    spread = F.xxhash64("vec_id", "v")
    block, group = F.pmod(spread, F.lit(blocks)), F.pmod(spread, F.lit(groups))
    # A grid: each candidate goes to every group of queries, each query to every block.
    candidates = rows.select(
        "size", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "vec_id", "v", F.lit(False).alias("query"),
    )
    queries = rows.where(F.col("vec_id") % settings.every == 0).select(
        "size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("group"),
        "vec_id", "v", F.lit(True).alias("query"),
    )

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell["query"].to_numpy(bool)
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        points = np.array(cell["v"].tolist(), np.float64).reshape(len(cell), -1)
        ids = cell["vec_id"].to_numpy(np.int64)
        return DualSearch(
            points[asks], ids[asks], points[~asks], ids[~asks], settings.k, settings.leaf
        ).run().frame()

    pairs = (
        candidates.unionAll(queries)
        .groupBy("size", F.col("block").cast("int").alias("block"), F.col("group").cast("int").alias("group"))
        .applyInPandas(search, PAIR_SCHEMA)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best).cast("int"))
    return ranked.where(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")
