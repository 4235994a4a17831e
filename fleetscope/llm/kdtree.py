"""Exact search for the k highest inner products, through one kd-tree per shard of the vectors.

Vectors are dealt into shards of about ``SHARD`` rows. Each shard gets a tree: nodes are split at the
median of the axis in which their box is widest, and every box is tight around its points. Queries are
taken in blocks of ``BLOCK``; a task streams the trees past a block and keeps, per query, the best k so
far. In each tree nodes are visited best first, by the highest product that a point of the box could
have with a query; the k-th score is carried from leaf to leaf and from tree to tree, and nodes that no
query of the block can gain from are left out. So a task holds one block and one tree, whatever the size
of the table, and each query's k rows leave one task only.

Cases: vectors that are null or hold null or non-finite components take no part, nor do rows without an
id; shorter vectors count as having zeros behind; equal scores go to the smaller id, then are taken in
any order; rows that share an id are rows of their own, and only a query's own row is not a candidate;
queries with fewer than k candidates get all; products beyond 64 bits count as the largest or least long.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.llm.tables import stored

SHARD = 8192
LEAF = 256
BLOCK = 512
_LONG = np.iinfo(np.int64)


def usable(vector: str) -> Column:
    """Whether a vector has finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, finite)


def whole_numbers(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


@dataclass
class Tree:
    points: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray  # of each node
    high: np.ndarray
    least_id: np.ndarray
    spans: list[tuple[int, int]]  # points of each node
    children: list[tuple[int, int] | None]


def matrix(vectors) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to the longest."""
    vectors = [np.asarray(v, dtype=np.int64) for v in vectors]
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def build(points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Tree:
    order = np.arange(len(points))
    spans, children, waiting = [(0, len(points))], [None], [0]
    while waiting:
        node = waiting.pop()
        a, b = spans[node]
        if b - a <= LEAF:
            continue
        own = points[order[a:b]]
        # as float: the width of a box may not fit into 64 bits
        axis = int(np.argmax(own.max(axis=0).astype(float) - own.min(axis=0))) if own.shape[1] else 0
        half = (b - a) // 2
        if own.shape[1]:
            order[a:b] = order[a:b][np.argpartition(own[:, axis], half)]
        children[node] = (len(spans), len(spans) + 1)
        waiting += children[node]
        spans += [(a, a + half), (a + half, b)]
        children += [None, None]
    points, ids, rows = points[order], ids[order], rows[order]
    low = np.array([points[a:b].min(axis=0) for a, b in spans])
    high = np.array([points[a:b].max(axis=0) for a, b in spans])
    return Tree(points, ids, rows, low, high, np.array([ids[a:b].min() for a, b in spans]), spans, children)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of a and b, exact, as long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    size = lambda m: max(abs(int(m.min())), abs(int(m.max())))
    bound = size(a) * size(b) * width
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound <= _LONG.max:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


class Best:
    """The best k rows so far of each query of a block."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, k: int):
        self.queries, self.rows = queries, rows
        self.scores = np.full((len(queries), k), _LONG.min)
        self.ids = np.full((len(queries), k), _LONG.max)
        self.found = np.zeros((len(queries), k), dtype=bool)

    def gains(self, bound: np.ndarray, least_id: int) -> np.ndarray:
        """The queries that a node with these bounds may give something better."""
        last = self.scores[:, -1]
        return np.flatnonzero(~self.found[:, -1] | (bound > last) | (bound == last) & (least_id < self.ids[:, -1]))

    def add(self, who: np.ndarray, tree: Tree, a: int, b: int) -> None:
        scores = products(self.queries[who], tree.points[a:b])
        others = self.rows[who][:, None] != tree.rows[a:b]
        scores = np.concatenate((self.scores[who], scores), axis=1)
        ids = np.concatenate((self.ids[who], np.broadcast_to(tree.ids[a:b], others.shape)), axis=1)
        found = np.concatenate((self.found[who], others), axis=1)
        # -1 - x turns the order of all longs around
        order = np.lexsort((ids, -1 - scores, ~found), axis=-1)[:, : self.scores.shape[1]]
        for held, new in ((self.scores, scores), (self.ids, ids), (self.found, found)):
            held[who] = np.take_along_axis(new, order, axis=1)

    def search(self, tree: Tree) -> None:
        width = min(self.queries.shape[1], tree.points.shape[1])
        queries = self.queries[:, :width].astype(object if self._wide(tree) else np.int64)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        low, high = tree.low[:, :width].astype(queries.dtype), tree.high[:, :width].astype(queries.dtype)
        if queries.dtype == object:
            bounds = np.clip(up @ high.T + down @ low.T, _LONG.min, _LONG.max).astype(np.int64)
        else:
            bounds = (up.astype(float) @ high.T.astype(float) + down.astype(float) @ low.T.astype(float)).astype(np.int64)
        heap = [(0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            who = self.gains(bounds[:, node], tree.least_id[node])
            if not len(who):
                continue
            below = tree.children[node]
            if below is None:
                self.add(who, tree, *tree.spans[node])
            else:
                for child in below:
                    heapq.heappush(heap, (-int(bounds[who, child].max()), child))

    def _wide(self, tree: Tree) -> bool:
        size = lambda m: max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
        return size(self.queries) * size(tree.points) * max(self.queries.shape[1], 1) >= 1 << 52


def _small(points: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that has them."""
    return points.astype(np.min_scalar_type(-max(abs(int(points.min())), abs(int(points.max()))) - 1)) if points.size else points


def top_k(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """The ``k`` highest products of each query, a row of ``vectors`` (vec_id, whole: array of long) for
    which ``queries`` holds, with all other rows: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    words.use_batches(spark)
    rows = stored(vectors.select("vec_id", "whole", queries.alias("asks")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    n_shards, n_blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // BLOCK))
    deal = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build(matrix(pdf["whole"]), pdf["vec_id"].to_numpy(), pdf["row"].to_numpy())
        tree.points = _small(tree.points)
        return pd.DataFrame({"part": pdf["part"][:1], "load": [pickle.dumps(tree)]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        load = (_small(matrix(pdf["whole"])), pdf["vec_id"].to_numpy(), pdf["row"].to_numpy())
        return pd.DataFrame({"part": pdf["part"][:1], "load": [pickle.dumps(load)]})

    kind = "part int, load binary"
    trees = rows.withColumn("part", deal(n_shards)).groupBy("part").applyInPandas(plant, kind)
    asked = rows.where("asks").withColumn("part", deal(n_blocks)).groupBy("part").applyInPandas(pack, kind)
    trees, asked = stored(trees, "trees"), stored(asked, "queries")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    sent = trees.select(every_block.alias("block"), F.lit(1).alias("kind"), "part", "load")
    sent = sent.union(asked.select(F.col("part").alias("block"), F.lit(0), F.lit(-1), "load"))

    def answer(best: Best, ids: np.ndarray) -> pa.RecordBatch:
        q, r = np.nonzero(best.found)
        columns = [ids[q], (r + 1).astype(np.int32), best.ids[q, r], best.scores[q, r]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "rank", "vec_id", "score"])

    def run(batches):
        block = best = ids = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if best is not None:
                        yield answer(best, ids)
                    points, ids, own = pickle.loads(row["load"])
                    block, best = row["block"], Best(points.astype(np.int64), own, k)
                elif best is not None and block == row["block"]:
                    tree = pickle.loads(row["load"])
                    tree.points = tree.points.astype(np.int64)
                    best.search(tree)
        if best is not None:
            yield answer(best, ids)

    ordered = sent.repartition(n_blocks, "block").sortWithinPartitions("block", "kind", "part")
    return ordered.mapInArrow(run, "query_id long, rank int, vec_id long, score long")
