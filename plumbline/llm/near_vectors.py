"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c or more lie within a squared distance of 2 - 2c.  A
random rotation spreads that distance over blocks of few dimensions, so some
block of the pair has at most its proportional share.  Each block is a range
join under that budget: vectors fall into cells of one coordinate, as wide as
the budget's radius, and meet those of their own and the next cell.  A pair is
taken by the first block that finds it and verified on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import connected
from plumbline.llm.tables import kept

LEAST_COSINE = 0.93
BLOCK = 8
#: vectors a task compares with each other; fuller cells are dealt to pairs of their parts
CELL_ROWS = 8000
#: rounding that the budget must outlast
SLACK = 1e-9

#: classes without an id go by numbers from here on
NAMELESS = 1 << 61

FOUND_SCHEMA = "rep long, links long, other long"


@cache
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def cuts(dims: int) -> list[tuple[int, int]]:
    """Blocks of about ``BLOCK`` dimensions."""
    n = max(1, dims // BLOCK)
    at = [round(dims * k / n) for k in range(n + 1)]
    return list(zip(at, at[1:], strict=False))


def budgets(dims: int, least: float) -> np.ndarray:
    """Squared distance a block may have: its share of dimensions of the whole."""
    return np.array([(2 - 2 * least) * (b - a) / dims for a, b in cuts(dims)]) + SLACK


def _tidy(x):
    """Negative zero as zero, so that equal vectors are equal to the grouping too."""
    return F.when(x == 0, F.abs(x)).otherwise(x)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null, empty or zero and has finite components only."""
    v = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = F.coalesce(F.forall(v, finite), F.lit(False))
    return vectors.withColumn("_v", F.when(clean, v)).where(F.exists("_v", lambda x: x != 0)).drop("_v")


def classes(vectors: DataFrame) -> DataFrame:
    """Equal vectors of one label as one row: smallest id and number of copies."""
    grouped = vectors.withColumn("embedding", F.transform("embedding", _tidy)).groupBy("label", "embedding")
    nameless = F.xxhash64("label", "embedding").bitwiseAND(NAMELESS - 1) + NAMELESS
    return grouped.agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("rep", F.coalesce("rep", nameless))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(least: float):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch["embedding"]])
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                mine = batch.take(pa.array(rows))
                turned = _unit(_matrix(mine["embedding"], d)) @ rotation(int(d))
                for k, ((a, _), budget) in enumerate(zip(cuts(int(d)), budgets(int(d), least), strict=True)):
                    cell = np.floor(turned[:, a] / np.sqrt(budget)).astype(np.int64)
                    for guest in (0, 1):
                        yield pa.record_batch(
                            [
                                mine["label"], pa.array(np.full(len(rows), d, np.int32)), pa.array(np.full(len(rows), k, np.int32)),
                                pa.array(cell - guest), pa.array(np.full(len(rows), guest, np.int32)), mine["rep"], mine["copies"], mine["embedding"],
                            ],
                            names=["label", "dims", "block", "cell", "guest", "rep", "copies", "embedding"],
                        )

    return place


def _links(least: float):
    def meet(key: tuple, group: pa.Table) -> pa.Table:
        _, dims, block, _, i, j = (k.as_py() for k in key)
        x = _matrix(group["embedding"].combine_chunks(), dims)
        rep, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        guest, part = group["guest"].to_numpy(), group["part"].to_numpy()
        unit = _unit(x)
        turned = unit @ rotation(dims)
        budget, spans = budgets(dims, least), cuts(dims)
        left = np.flatnonzero((guest == 0) & ((part == i) | (part == j)))
        links, root = np.zeros(len(x), np.int64), np.arange(len(x))
        column = turned[:, spans[block][0]]
        left = left[np.argsort(column[left], kind="stable")]
        order = np.argsort(column, kind="stable")
        sorted_column = column[order]
        radius = np.sqrt(budget[block])
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            low, high = np.searchsorted(sorted_column, [column[some].min() - radius - SLACK, column[some].max() + radius + SLACK])
            others = order[low:high]
            allowed = (part[some][:, None] != part[others][None, :]) if i != j else np.ones((len(some), len(others)), bool)
            # home pairs once, by their order; guests are on the right only
            allowed &= (guest[others] == 1)[None, :] | (rep[some][:, None] < rep[others][None, :])
            a, b = spans[block]
            u, v = turned[some, a:b], turned[others, a:b]
            near = (u**2).sum(1)[:, None] + (v**2).sum(1)[None, :] - 2 * u @ v.T <= budget[block] + SLACK
            p, q = np.nonzero(allowed & near)
            p, q = some[p], others[q]
            for start in range(0, len(p), 65536):
                _take(p[start : start + 65536], q[start : start + 65536], x, unit, turned, block, budget, spans, copies, links, root)
        some = np.flatnonzero(links)
        return pa.table([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[[_root(root, k) for k in some]])], names=["rep", "links", "other"])

    def _take(p, q, x, unit, turned, block, budget, spans, copies, links, root):
        gap = (turned[p] - turned[q]) ** 2
        first = gap[:, spans[block][0] : spans[block][1]].sum(1) <= budget[block]
        for k in range(block):
            a, b = spans[k]
            first &= gap[:, a:b].sum(1) > budget[k]
        p, q = p[first], q[first]
        near = (unit[p] * unit[q]).sum(1)
        sure = near >= least + 1e-12
        doubt = np.flatnonzero(np.abs(near - least) < 1e-12)
        sure[doubt] = [cosine(x[p[k]], x[q[k]]) >= least for k in doubt]
        p, q = p[sure], q[sure]
        np.add.at(links, p, copies[q])
        np.add.at(links, q, copies[p])
        for s, t in zip(p.tolist(), q.tolist(), strict=True):
            s, t = _root(root, s), _root(root, t)
            if s != t:
                root[max(s, t)] = min(s, t)

    return meet


def _root(root: np.ndarray, k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return int(k)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Rows link only within a label that is not null.  Vectors that are null,
    empty, zero, or hold null or infinite components link with nothing, and so
    do vectors of different length.  Repeated rows and copies link with each
    other: a row's own copies count among its links.  A null id takes part but
    names no component that has another; an empty table gives no rows.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    good = usable(vectors).where("label is not null")
    reps = kept(classes(good), "vectors")
    kind = reps.schema["embedding"].dataType.simpleString()
    placed = reps.select("label", "rep", "copies", "embedding").mapInArrow(
        _cells(least), f"label int, dims int, block int, cell long, guest int, rep long, copies long, embedding {kind}"
    )
    where = ["label", "dims", "block", "cell"]
    full = placed.groupBy(*where).agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"))
    dealt = placed.join(full, where).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # parts of a full cell meet by twos: of different parts only pairs across, of one part pairs within
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    paired = paired.withColumn("i", F.least("part", "with")).withColumn("j", F.greatest("part", "with"))
    found = kept(paired.groupBy(*where, "i", "j").applyInArrow(_links(least), FOUND_SCHEMA), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    by_class = (
        reps.join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    rows = vectors.withColumn("embedding", F.transform("embedding", _tidy)).join(by_class, ["label", "embedding"], "left")
    named = F.when(F.col("component_id") < NAMELESS, F.col("component_id"))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(named)
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
