"""Approximate nearest neighbours by a few stable projections indexed in a kd-tree.

Vectors are projected onto ``PROJECTIONS`` random Gaussian directions. Of two vectors at distance d,
the squared projected distance over d squared follows a chi-square law, whatever the data. Each
block of vectors builds a kd-tree over its projections. A query takes the leaves of the tree by
their projected distance, computes the exact distances of each leaf's vectors, and stops when a
vector as near as its current last neighbour would, with probability ``CONFIDENCE``, already have
been met. Each true neighbour is found with that probability at least.

Largest inner product becomes nearest distance by one more coordinate that brings all vectors to
the same norm. Equal vectors form one entry with their smallest ids. Queries and entries are dealt
to pairs of blocks; the best of each pair of blocks are ranked again over all.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
id or vectors of another length than most. Rows that repeat an id are candidates of their own, but
never for their own id; as queries they ask together, and a candidate has its best score with any of
them. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import pick, write_once

K, PROJECTIONS, CONFIDENCE, LEAF = 20, 16, 0.95, 512
ENTRY_BLOCK, QUERY_BLOCK = 20_000, 4_000
SEED = 20


def chi_square_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """Of an even number of degrees."""
    half = np.asarray(x, float) / 2
    term = np.ones_like(half)
    total = term.copy()
    for i in range(1, degrees // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(np.array(middle), degrees) < p else (low, middle)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers by leaf: the widest direction is halved until a leaf is small enough."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        spread = points[rows].max(axis=0) - points[rows].min(axis=0)
        order = rows[np.argsort(points[rows, spread.argmax()], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return leaves


class Index:
    """Entries of one block, with a kd-tree over their projections."""

    def __init__(self, entries: np.ndarray, project: np.ndarray, norm: float, leaf: int = LEAF):
        extra = np.sqrt(np.maximum(norm * norm - (entries * entries).sum(axis=1), 0))
        projected = np.hstack([entries, extra[:, None]]) @ project
        self.leaves = kd_leaves(projected, leaf)
        self.low = np.array([projected[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([projected[rows].max(axis=0) for rows in self.leaves])
        self.entries, self.project, self.norm = entries, project, norm
        self.verified = 0

    def search(self, queries: np.ndarray, k: int, confidence: float, own: np.ndarray | None = None,
               only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and inner products of the best entries met, best first; -1 where there are fewer.

        ``only`` has each entry's first id and whether it has no other; an entry whose only id is the
        query's ``own`` is no candidate, so it is left out before the best are cut off.
        """
        reach = chi_square_quantile(confidence, self.project.shape[1])
        # a query is brought to the entries' norm; this keeps the order of its inner products
        lengths = np.linalg.norm(queries, axis=1)
        scaled = queries * (self.norm / lengths)[:, None]
        at = np.hstack([scaled, np.zeros((len(queries), 1))]) @ self.project
        nearest = np.zeros((len(queries), len(self.leaves)))
        for j, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            gap = np.maximum(np.maximum(low - at, at - high), 0)
            nearest[:, j] = (gap * gap).sum(axis=1)
        order = np.argsort(nearest, axis=1, kind="stable")
        nearest = np.take_along_axis(nearest, order, axis=1)
        best = np.full((len(queries), k), -np.inf)
        rows = np.full((len(queries), k), -1)
        active = np.arange(len(queries))
        for step in range(len(self.leaves)):
            # squared distance of the last neighbour so far, all on a sphere of radius norm
            last = 2 * self.norm * (self.norm - best[active, k - 1] / lengths[active])
            last = np.maximum(last, 0) + 1e-9 * self.norm * self.norm
            active = active[nearest[active, step] <= reach * last]
            if not len(active):
                break
            leaf_of = order[active, step]
            for leaf in np.unique(leaf_of):
                members, ids = active[leaf_of == leaf], self.leaves[leaf]
                products = queries[members] @ self.entries[ids].T
                self.verified += products.size
                if own is not None:
                    mine = (only[ids, 0][None, :] == own[members][:, None]) & (only[ids, 1] == 1)[None, :]
                    products = np.where(mine, -np.inf, products)
                scores = np.hstack([best[members], products])
                both = np.hstack([rows[members], np.broadcast_to(ids, products.shape)])
                top = np.lexsort((both, -scores), axis=1)[:, :k]  # ties to the earlier entry
                best[members] = np.take_along_axis(scores, top, axis=1)
                rows[members] = np.take_along_axis(both, top, axis=1)
        # once more in one order of summation, whatever the leaf was multiplied with
        exact = np.einsum("qd,qkd->qk", queries, self.entries[rows])
        rows = np.where(best > -np.inf, rows, -1)
        return rows, np.where(rows >= 0, exact, -np.inf)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows that take part, components as doubles."""
    clean = pick(vectors, vec_id=id_col, v=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = clean.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite
                         & F.exists("v", lambda x: x != 0))
    sizes = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    return clean.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           every: int = 20, k: int = K, confidence: float = CONFIDENCE, projections: int = PROJECTIONS,
           entry_block: int = ENTRY_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for ids divisible by ``every``, the k nearest rows found."""
    clean = write_once(usable(vectors, id_col, vector_col), "vectors")
    squared = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    facts = clean.agg(F.count(F.lit(1)).alias("n"), F.max(squared).alias("top"),
                      F.max(F.size("v")).alias("size"),
                      F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("queries")).first()
    norm, size = math.sqrt(facts["top"] or 1.0), facts["size"] or 1
    blocks = 1 + (facts["n"] - 1) // entry_block if facts["n"] else 1
    query_blocks = 1 + (facts["queries"] - 1) // query_block if facts["queries"] else 1
    project = np.random.default_rng(SEED).standard_normal((size + 1, projections))

    # equal vectors are one entry with the ids that can appear in a result: of each id k rows at most,
    # so that twice as many rows leave k whichever id the query has
    of_id, first_ids = Window.partitionBy("v", "vec_id").orderBy("vec_id"), Window.partitionBy("v").orderBy("vec_id")
    entries = (
        clean.withColumn("_n", F.row_number().over(of_id)).filter(F.col("_n") <= k)
        .withColumn("_n", F.row_number().over(first_ids)).filter(F.col("_n") <= 2 * k)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("e", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    asked = (
        clean.filter(F.col("vec_id") % every == 0)
        .withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("e", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select("vec_id", "v", "e", "q")
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        left = left.assign(first=[ids[0] for ids in left.ids]).sort_values("first")
        index = Index(np.array(left.v.tolist()), project, norm)
        ids = left.ids.tolist()
        only = np.array([[x[0], x[0] == x[-1]] for x in ids], np.int64)
        right = right.sort_values("vec_id", kind="stable")
        own_ids, asks = right.vec_id.to_numpy(), np.array(right.v.tolist())
        out: list[tuple] = []
        met: dict[tuple[int, int], float] = {}  # of the query at hand: (entry, place in it) and score

        def leave(own: int) -> None:
            mine = sorted((-mark, ids[at][place]) for (at, place), mark in met.items())
            out.extend((own, other, -mark) for mark, other in mine[:k])
            met.clear()

        for start in range(0, len(asks), 512):
            part = slice(start, start + 512)
            rows, scores = index.search(asks[part], k, confidence, own_ids[part], only)
            for n, (found, marks) in enumerate(zip(rows.tolist(), scores.tolist(), strict=True), start):
                if n and own_ids[n] != own_ids[n - 1]:
                    leave(int(own_ids[n - 1]))
                for at, mark in zip(found, marks, strict=True):
                    for place, other in enumerate(ids[at] if at >= 0 else []):
                        if other != own_ids[n]:
                            met[at, place] = max(mark, met.get((at, place), mark))
        leave(int(own_ids[-1]))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    met = entries.groupBy("e", "q").cogroup(asked.groupBy("e", "q")).applyInPandas(
        meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
