"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample; every row is then sent down each tree
to its leaf.  A query walks all trees at once: one priority queue holds the
branches not taken, nearest to their splits first, until the leaves visited
cover a set share of the sample.  Queries and rows meet by leaf, in blocks, and
candidates are ranked exactly on the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.near_vectors import _matrix, usable
from plumbline.llm.tables import kept

TREES = 4
#: rows that the trees are grown on, by the smallest hashes of their ids
SAMPLE = 20_000
#: a leaf holds at most this share of the sample
LEAF_SHARE = 1 / 32
#: a query visits leaves until they hold, over all trees, this many times the sample
VISITED = 1.6
#: rows of a leaf, and queries, that one task compares
LEAF_ROWS = 8000
LEAF_QUERIES = 2000

FOUND_SCHEMA = "query_id long, vec_id long, score double"


class Tree:
    """A tree of hyperplanes; leaves count from 0 and know their share of the sample."""

    def __init__(self, sample: np.ndarray, seed: int, least: int):
        self.random = np.random.default_rng(seed)
        self.normal: list[np.ndarray] = []
        self.bound: list[float] = []
        self.sides: list[tuple[int, int]] = []
        self.share: list[float] = []
        self.total, self.least = max(1, len(sample)), least
        self.root = self._grow(sample)

    def _grow(self, rows: np.ndarray) -> int:
        """A node's number; leaves are -1 - number."""
        if len(rows) > self.least:
            # the direction between two rows of the sample, split at the median
            for _ in range(8):
                a, b = rows[self.random.choice(len(rows), 2, replace=False)]
                normal = a - b
                length = np.linalg.norm(normal)
                if not length:
                    continue
                side = rows @ (normal / length)
                bound = float(np.median(side))
                above = side > bound
                if 0.1 < above.mean() < 0.9:
                    node = len(self.bound)
                    self.normal.append(normal / length)
                    self.bound.append(bound)
                    self.sides.append((0, 0))
                    self.sides[node] = (self._grow(rows[~above]), self._grow(rows[above]))
                    return node
        self.share.append(len(rows) / self.total)
        return -len(self.share)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(rows), np.int32)
        stack = [(self.root, np.arange(len(rows)))]
        while stack:
            node, mine = stack.pop()
            if node < 0:
                out[mine] = -1 - node
            elif len(mine):
                above = rows[mine] @ self.normal[node] > self.bound[node]
                stack += [(self.sides[node][0], mine[~above]), (self.sides[node][1], mine[above])]
        return out


class Forest:
    """Trees over vectors of one length."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf_share: float = LEAF_SHARE):
        least = max(10, int(len(sample) * leaf_share))
        self.trees = [Tree(sample, seed, least) for seed in range(trees)]

    def visits(self, query: np.ndarray, amount: float = VISITED) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one shared queue, until they hold ``amount`` of the sample.

        A branch's priority is the widest margin by which the query lies on the
        other side of a split on its way.
        """
        sides = [[float(query @ n) - b for n, b in zip(t.normal, t.bound, strict=True)] for t in self.trees]
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found, held = [], 0.0
        while queue and held < amount:
            cost, k, node = heapq.heappop(queue)
            tree = self.trees[k]
            while node >= 0:
                margin = sides[k][node]
                near, far = tree.sides[node][margin > 0], tree.sides[node][margin <= 0]
                heapq.heappush(queue, (max(cost, abs(margin)), k, far))
                node = near
            found.append((k, -1 - node))
            held += tree.share[-1 - node]
        return found


def _sampled(vectors: DataFrame, size: int) -> dict[int, np.ndarray]:
    """At most ``size`` rows, by length of their vectors; the same ones wherever they lie."""
    order = F.xxhash64("vec_id", "embedding")
    rows = vectors.select("embedding", order.alias("h")).orderBy("h").limit(size).select("embedding").toArrow()["embedding"].combine_chunks()
    dims = np.array([len(v) for v in rows])
    return {int(d): _matrix(rows.take(pa.array(np.flatnonzero(dims == d))), d) for d in np.unique(dims)} if len(rows) else {}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    dims = np.array([len(v) for v in batch["embedding"]])
    for d in np.unique(dims):
        rows = batch.take(pa.array(np.flatnonzero(dims == d)))
        yield int(d), rows, _matrix(rows["embedding"], d)


def nearest(
    vectors: DataFrame, queries, k: int = 10, sample: int = SAMPLE, visited: float = VISITED, trees: int = TREES
) -> DataFrame:
    """The ``k`` nearest found for each row that the condition ``queries`` names: query_id, rank, vec_id, score.

    Nearness is Euclidean distance in double precision, ties go to the smaller
    id; a query is no neighbour of its own id.  Fewer candidates give fewer
    rows.  Vectors that are null, empty, zero, or hold null or infinite
    components take no part, nor do rows without id; vectors meet those of
    their own length only.  Of rows that repeat an id and vector one counts.  A
    table without queries gives no rows.
    """
    good = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")).where("vec_id is not null")
    # rows that repeat an id and vector are one before anything is counted or placed
    good = kept(good.groupBy("vec_id", "embedding").agg(F.count("*").alias("copies")).drop("copies"), "vectors")
    kind = good.schema["embedding"].dataType.simpleString()
    forests = {d: Forest(x, trees) for d, x in _sampled(good, sample).items()}
    shared = vectors.sparkSession.sparkContext.broadcast(forests)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _by_length(batch):
                forest = shared.value.get(d) or Forest(x[:0], trees)
                for t, tree in enumerate(forest.trees):
                    yield pa.record_batch(
                        [pa.array(np.full(len(x), d, np.int32)), pa.array(np.full(len(x), t, np.int32)), pa.array(tree.leaves(x)), rows["vec_id"], rows["embedding"]],
                        names=["dims", "tree", "leaf", "vec_id", "embedding"],
                    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _by_length(batch):
                forest = shared.value.get(d) or Forest(x[:0], trees)
                found = [(i, *v) for i, q in enumerate(x) for v in forest.visits(q, visited)]
                at, tree, leaf = (np.array(c, np.int32) for c in zip(*found, strict=True))
                mine = rows.take(pa.array(at))
                yield pa.record_batch(
                    [pa.array(np.full(len(at), d, np.int32)), pa.array(tree), pa.array(leaf), mine["vec_id"], mine["embedding"]],
                    names=["dims", "tree", "leaf", "vec_id", "embedding"],
                )

    schema = f"dims int, tree int, leaf int, vec_id long, embedding {kind}"
    where = ["dims", "tree", "leaf"]
    rows = good.mapInArrow(place, schema)
    asked = good.where(queries).mapInArrow(walk, schema)
    # a leaf with more rows or queries than a task should hold is compared in blocks
    parts = rows.groupBy(*where).agg(F.ceil(F.count("*") / LEAF_ROWS).cast("int").alias("row_parts")).join(
        asked.groupBy(*where).agg(F.ceil(F.count("*") / LEAF_QUERIES).cast("int").alias("query_parts")), where
    )
    parts = kept(parts, "leaves")
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(parts, where).withColumn("r", of("row_parts")).withColumn("q", every("query_parts")).drop("row_parts", "query_parts")
    right = asked.join(parts, where).withColumn("q", of("query_parts")).withColumn("r", every("row_parts")).drop("row_parts", "query_parts")
    block = [*where, "r", "q"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_ranked(k), FOUND_SCHEMA)
    # the same candidate may come from several trees
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked(k: int):
    """The k nearest rows of a block for each of its queries, with exact distances."""

    def meet(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if rows.num_rows and asked.num_rows:
            d = key[0].as_py()
            x, ids = _matrix(rows["embedding"].combine_chunks(), d), rows["vec_id"].to_numpy()
            q, names = _matrix(asked["embedding"].combine_chunks(), d), asked["vec_id"].to_numpy()
            # an id may have several vectors: rows lie by id, and k ids are wanted, not k rows
            by_id = np.argsort(ids, kind="stable")
            x, ids = x[by_id], ids[by_id]
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            square = (x**2).sum(1)
            for at in range(0, len(q), 256):
                some, who = q[at : at + 256], names[at : at + 256]
                rough = square[None, :] - 2 * some @ x.T
                rough[who[:, None] == ids[None, :]] = np.inf
                least = np.minimum.reduceat(rough, starts, axis=1) if len(starts) < len(ids) else rough
                for i in range(len(some)):
                    row = rough[i]
                    bound = np.partition(least[i], k)[k] if len(starts) > k else np.inf
                    near = np.flatnonzero((row <= bound + 1e-9 * (1 + abs(bound))) & (row < np.inf)) if np.isfinite(bound) else np.flatnonzero(row < np.inf)
                    exact = np.sqrt(((x[near] - some[i]) ** 2).sum(1))
                    first = np.lexsort((ids[near], exact))
                    # copies of an id count once
                    _, distinct = np.unique(ids[near][first], return_index=True)
                    first = first[np.sort(distinct)][:k]
                    out[0].append(np.full(len(first), who[i]))
                    out[1].append(ids[near][first])
                    out[2].append(exact[first])
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    return meet
