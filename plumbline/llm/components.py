"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import kept


def connected(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge: (node, root).

    ``edges`` has two bigint columns ``a`` and ``b``.  Each round joins every
    node's neighbours to its smallest one (large star), then its smaller
    neighbours to the smallest (small star); the rounds end when no edge
    changes.  Only minima and equi-joins are used, so a node with a third of
    all edges is combined before the shuffle, and its join side can be split.
    Self loops and nulls are dropped; no edges give no rows.
    """
    now = kept(_smaller_second(edges.select("a", "b")), "edges")
    seen = _digest(now)
    while seen[0]:
        now = kept(_small_star(_large_star(now)), "edges")
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    root = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return root.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _smaller_second(pairs: DataFrame) -> DataFrame:
    return (
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _smaller_second(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _smaller_second(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
