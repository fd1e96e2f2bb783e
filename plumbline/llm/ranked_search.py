"""Ranked lexical search of many queries at once, by shared partial sums.

Terms that several items ask for together are mined from the items: the pair of
symbols found in most of them becomes a new symbol, again and again, so that the
items become short sums over a graph whose inner nodes are sums as well.  A pass
over the documents keeps, of each, its length and the counts of the terms that
are asked for; a second pass weighs these and walks the graph once for a batch
of documents: every shared partial sum is made once for all items that use it.
Documents stay where they are; only the best of each task are shuffled.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.tables import kept, small_batches

BEST = 10
#: shares of a document's length in its weight, of a hundred
LENGTH_SHARE = 90
#: distinct terms of the items that are searched together; more items take further passes over the documents
TERMS_AT_ONCE = 200_000
#: cells of the table of partial sums: symbols times documents in a batch
CELLS = 2_000_000
#: symbols of an item among which pairs are looked for at a time; it bounds the mining and changes no score
MINED_TOGETHER = 64

#: every byte that is not part of a term becomes a space, and A-Z lower case
_FOLDED = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

FOUND_SCHEMA = "doc_id long, n long, terms array<int>, counts array<long>"
TOP_SCHEMA = "place int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, with repeats; none of a null one."""
    return (text or "").encode("utf-8", "replace").translate(_FOLDED).split()


# ------------------------------------------------------------------ the graph


@dataclass
class Sharing:
    """Items as sums of symbols: those below ``terms`` are terms, each later one is the sum of two earlier ones.

    ``levels`` lists the additions (left, right) in the order of the new symbols,
    grouped so that no addition needs another one of its group.
    """

    terms: int
    levels: list[np.ndarray] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)

    @property
    def symbols(self) -> int:
        return self.terms + sum(map(len, self.levels))

    @property
    def additions(self) -> int:
        return sum(map(len, self.levels)) + sum(max(0, len(i) - 1) for i in self.items)

    def scores(self, weighted: np.ndarray) -> np.ndarray:
        """(items, documents) from (terms, documents): each partial sum is made once."""
        sums = np.zeros((self.symbols, weighted.shape[1]), "i8")
        sums[: self.terms] = weighted
        made = self.terms
        for pairs in self.levels:
            np.add(sums[pairs[:, 0]], sums[pairs[:, 1]], out=sums[made : made + len(pairs)])
            made += len(pairs)
        found = np.zeros((len(self.items), weighted.shape[1]), "i8")
        for k, symbols in enumerate(self.items):
            if len(symbols):
                found[k] = sums[symbols].sum(axis=0)
        return found


def share(items: list[Iterable[int]], terms: int) -> Sharing:
    """Mine pairs of symbols that several items share until none is left.

    A round counts the pairs of all items and joins them from the most frequent
    on, a symbol of an item at most once a round; the joined pairs are the next
    level of the graph.
    """
    graph, now = Sharing(terms), [set(i) for i in items]
    made = terms
    while True:
        used = Counter(s for i in now for s in i)
        holders: defaultdict[tuple[int, int], list[int]] = defaultdict(list)
        for k, symbols in enumerate(now):
            shared = sorted((s for s in symbols if used[s] > 1), key=lambda s: (-used[s], s))
            for at in range(0, len(shared), MINED_TOGETHER):
                for pair in combinations(sorted(shared[at : at + MINED_TOGETHER]), 2):
                    holders[pair].append(k)
        queue = [(-len(h), p) for p, h in holders.items() if len(h) > 1]
        heapq.heapify(queue)
        level, fresh = [], [set() for _ in now]
        while queue:
            hoped, (a, b) = heapq.heappop(queue)
            still = [k for k in holders[a, b] if a in now[k] and b in now[k]]
            if len(still) < 2:
                continue
            if -hoped > len(still):  # others took some of its items: it waits for its true place
                holders[a, b] = still
                heapq.heappush(queue, (-len(still), (a, b)))
                continue
            for k in still:
                now[k] -= {a, b}
                fresh[k].add(made)
            level.append((a, b))
            made += 1
        if not level:
            break
        graph.levels.append(np.array(level, "i8"))
        for symbols, new in zip(now, fresh, strict=True):
            symbols |= new
    graph.items = [np.array(sorted(i), "i8") for i in now]
    return graph


# ------------------------------------------------------------------ the passes


def asked(items: DataFrame) -> DataFrame:
    """(item_id, terms): one row per item; rows that repeat an id are one item with the terms of all."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({t.decode("utf-8", "replace") for t in terms_of(x)}) for x in batch["text"].to_pylist()]
            yield pa.record_batch([batch["item_id"], pa.array(terms, pa.list_(pa.string()))], names=["item_id", "terms"])

    told = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(cut, "item_id long, terms array<string>")
    pairs = told.select("item_id", F.explode_outer("terms").alias("term")).distinct()
    return pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def found_terms(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Of every document its length in terms, and the asked terms in it by their places: ``FOUND_SCHEMA``.

    A null text has no terms.  Rows without terms are left out: they count nowhere.
    """
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, lengths, terms, counts = [], [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                met = terms_of(text.as_py())
                if not met:
                    continue
                found = Counter(filter(known.__contains__, met))
                ids.append(doc_id)
                sizes.append(len(met))
                lengths.append(len(found))
                terms.extend(map(known.__getitem__, found))
                counts.extend(found.values())
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, FOUND_SCHEMA)


class Best:
    """The best documents of every item so far: higher scores first, then smaller ids, no id last."""

    def __init__(self, items: int, size: int):
        self.size = size
        self.rows = [(np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, bool)) for _ in range(items)]
        self.least = np.ones(items, "i8")

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        for k in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)):
            new = np.flatnonzero(scores[k] >= self.least[k])
            columns = [np.concatenate(c) for c in zip(self.rows[k], (scores[k][new], ids[new], unnamed[new]), strict=True)]
            first = np.lexsort((columns[1], columns[2], -columns[0]))[: self.size]
            self.rows[k] = tuple(c[first] for c in columns)
            if len(first) == self.size:
                self.least[k] = max(1, self.rows[k][0][-1])

    def batch(self) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(self.rows)), [len(r[0]) for r in self.rows])
        scores, ids, unnamed = (np.concatenate([r[c] for r in self.rows]) for c in range(3))
        columns = [pa.array(place, pa.int32()), pa.array(ids, pa.int64(), mask=unnamed), pa.array(scores, pa.int64())]
        return pa.record_batch(columns, names=["place", "doc_id", "score"])


def _best_of_tasks(found: DataFrame, graph: Sharing, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """(place, doc_id, score): the best documents of every item in every task."""
    shared = found.sparkSession.sparkContext.broadcast((graph, weights))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = shared.value
        top = Best(len(graph.items), best)
        at_once = max(1, CELLS // max(1, graph.symbols))
        for batch in (b.slice(at, at_once) for b in batches for at in range(0, b.num_rows, at_once)):
            sizes = batch["n"].to_pylist()
            # whole numbers of any size
            length = np.array([100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms for n in sizes], "i8")
            lists, counts = batch["terms"], batch["counts"].flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            term = lists.flatten().to_numpy()
            weighted = np.zeros((graph.terms, batch.num_rows), "i8")
            weighted[term, doc] = weights[term] * (1_000_000_000 * counts // (1000 * counts + 8 * length[doc]))
            ids = batch["doc_id"]
            top.add(graph.scores(weighted), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        yield top.batch()

    return found.mapInArrow(rank, TOP_SCHEMA)


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """Per item its ``best`` documents with a score above 0: ``item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other
    columns are not read.  Equal scores go by ascending doc_id, a null id last;
    rows that repeat an id are documents of their own, and equal ones take a rank
    each.  Rows that repeat an item_id, also a null one, are one item.  Null and
    empty texts have no terms; items without terms, without documents, or over an
    empty table have no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    wanted = kept(asked(items), "items")
    size = wanted.agg(F.sum(F.greatest(F.size("terms"), F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-size // TERMS_AT_ONCE))
    parts = []
    for k in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id").collect()
        parts.append(_search_block(spark, docs, [(r["item_id"], r["terms"]) for r in block], best))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _search_block(spark: SparkSession, docs: DataFrame, block: list[tuple[int | None, list[str]]], best: int) -> DataFrame:
    vocabulary = sorted({t for _, terms in block for t in terms})
    if not vocabulary:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = {t: k for k, t in enumerate(vocabulary)}
    graph = share([[place[t] for t in terms] for _, terms in block], len(vocabulary))
    found = kept(found_terms(docs, vocabulary), "terms")
    # one number for each asked term
    df = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(vocabulary), "i8")
    for r in df:
        weights[r["term"]] = floor(1000 * log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    tops = _best_of_tasks(found, graph, weights, n_docs, n_terms or 1, best)
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    names = F.broadcast(spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "place int, item_id long"))
    return ranked.join(names, "place").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
