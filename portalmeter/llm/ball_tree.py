"""Exact top-k inner products by branch and bound over a ball tree per shard.

Vectors are dealt over shards of bounded size; each shard builds a ball tree. A ball with centre c and radius r
holds no inner product with q above q.c + |q| r. Every shard first looks into the leaf of the highest bound; the
best k-th score that any shard finds there is shared, and the search proper skips every ball below it, taking balls
in the order of their bounds and raising the k-th score as it goes. Queries come in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalmeter.llm.words import Scratch

TOP, EVERY, SCALE = 10, 100, 1024
SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 2048, 1024, 64


def scaled(embedding: Column) -> Column:
    """floor(1024 x) of each component; null for vectors that are null or hold null or non-finite components."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(wide, lambda x: F.floor(SCALE * x)))


class BallTree:
    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.floats = rows.astype(np.float64)
        self.nodes: list[tuple[np.ndarray, float, np.ndarray, int, int]] = []
        self._build(np.arange(len(rows)))

    def _build(self, at: np.ndarray) -> int:
        points = self.floats[at]
        centre = points.mean(axis=0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1).max()))
        me = len(self.nodes)
        self.nodes.append((centre, radius, at, -1, -1))
        if len(at) > LEAF_ROWS and radius > 0:
            # Halves along the line from one far point to another.
            a = points[((points - centre) ** 2).sum(axis=1).argmax()]
            b = points[((points - a) ** 2).sum(axis=1).argmax()]
            order = np.argsort((points - centre) @ (b - a), kind="stable")
            half = len(at) // 2
            left, right = self._build(at[order[:half]]), self._build(at[order[half:]])
            self.nodes[me] = (centre, radius, at, left, right)
        return me


class Search:
    """The k best of a tree for each of a block of queries, given a score that they need to reach."""

    def __init__(self, tree: BallTree, queries: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int):
        self.tree, self.queries, self.ids, self.k = tree, queries, ids, k
        self.floats = queries.astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(axis=1))
        self.least = floor.astype(np.float64).copy()
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        largest = (np.abs(self.floats).max(initial=0.0)) * (np.abs(tree.floats).max(initial=0.0)) * queries.shape[1]
        self.exact = largest < 2.0**53

    def bound(self, node: int, who: np.ndarray) -> np.ndarray:
        centre, radius = self.tree.nodes[node][:2]
        value = self.floats[who] @ centre + self.norms[who] * radius
        return value + 1e-9 * (np.abs(value) + self.norms[who] * (radius + np.sqrt((centre**2).sum()))) + 1e-6

    def scores(self, at: np.ndarray, who: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.floats[who] @ self.tree.floats[at].T).astype(np.int64)
        # Beyond the range that floating point holds exactly; what no long can hold ends at its limits.
        whole = self.queries[who].astype(object) @ self.tree.rows[at].astype(object).T
        return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)

    def leaf(self, node: int, who: np.ndarray) -> None:
        at = self.tree.nodes[node][2]
        scores, ids = self.scores(at, who), self.tree.ids[at]
        for row, q in zip(scores, who, strict=True):
            hit = np.flatnonzero((row >= self.least[q]) & (ids != self.ids[q]))
            if len(hit):
                merged = sorted(self.best[q] + [(-int(row[i]), int(ids[i])) for i in hit])[: self.k]
                self.best[q] = merged
                if len(merged) == self.k:
                    self.least[q] = max(self.least[q], float(-merged[-1][0]))

    def visit(self, node: int, who: np.ndarray) -> None:
        who = who[self.bound(node, who) >= self.least[who]]
        if not len(who):
            return
        left, right = self.tree.nodes[node][3:]
        if left < 0:
            self.leaf(node, who)
            return
        nearer = self.bound(left, who) >= self.bound(right, who)
        for part, order in ((who[nearer], (left, right)), (who[~nearer], (right, left))):
            for child in order if len(part) else ():
                self.visit(child, part)

    def first_leaf(self, node: int, who: np.ndarray) -> None:
        left, right = self.tree.nodes[node][3:]
        if left < 0:
            self.leaf(node, who)
            return
        nearer = self.bound(left, who) >= self.bound(right, who)
        for part, child in ((who[nearer], left), (who[~nearer], right)):
            if len(part):
                self.first_leaf(child, part)


def _searched(k: int, whole: bool):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(vectors) and len(queries):
            stack = lambda v: np.array(v.tolist(), dtype=np.int64).reshape(len(v), -1)
            search = Search(BallTree(stack(vectors.v), vectors.vec_id.to_numpy()), stack(queries.q), queries.query_id.to_numpy(), queries.least.to_numpy(float), k)
            (search.visit if whole else search.first_leaf)(0, np.arange(len(queries)))
            for q, best in zip(queries.query_id, search.best, strict=True):
                if whole:
                    out += [(q, i, -s) for s, i in best]
                elif len(best) == k:
                    out.append((q, best[-1][1], -best[-1][0]))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_inner_products(vectors: DataFrame, scratch: Scratch, k: int = TOP, every: int = EVERY, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query among all rows (vec_id, embedding, ...).

    Queries are the rows whose vec_id is divisible by ``every``; a score is the inner product of vectors scaled by
    1024 and rounded down. Ties go to the smaller vec_id. Rows without a vec_id, and vectors that are null or hold
    null or non-finite components, take no part; vectors of different lengths do not meet. A query's own id is no
    candidate; repeated rows are candidates each, and one query. Other columns are ignored.
    """
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v")).where("v is not null")
    rows = scratch.save(rows.withColumn("dim", F.size("v")), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    n = rows.agg(F.count("*"), F.sum((F.col("vec_id") % every == 0).cast("int"))).first()
    shards, blocks = max(1, -(-n[0] // shard_rows)), max(1, -(-(n[1] or 0) // block_queries))
    whole = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.select("*", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), whole(blocks).alias("block"))
    asked = asked.select("*", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block"), whole(shards).alias("shard"))
    keys = ["dim", "shard", "block"]

    def found(least: Column, queries: DataFrame, all_of_it: bool) -> DataFrame:
        # New columns, so that the two sides share none.
        queries = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), least.alias("least"), *[F.col(k).alias(f"q_{k}") for k in keys])
        sides = dealt.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{k}" for k in keys]))
        return sides.applyInPandas(_searched(k, all_of_it), "query_id long, vec_id long, score long")

    shared = found(F.lit(float("-inf")), asked, False).groupBy("query_id").agg(F.max("score").alias("shared"))
    shared = scratch.save(shared, "shared")
    known = asked.join(shared, asked["vec_id"] == shared["query_id"], "left").drop("query_id")
    best = found(F.coalesce(F.col("shared").cast("double"), F.lit(float("-inf"))), known, True)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
