"""The trie of conversation prefixes, from sorted sequences and a range minimum.

Every conversation is rebuilt as a sequence of turns and named by the digests of
these, so that sequences that begin alike stand side by side when sorted.  What
neighbours share (their LCP) is looked up in a sparse table of range minima:
every prefix of every sequence searches, by halving steps, how far to the left
and to the right its members reach, each on its own and without a stack.  Sums
over that interval then give everything about the prefix.

Equal sequences are one row with a count.  The sorted rows are cut into parts of
bounded size; only prefixes that reach beyond their part (those on the way to
its first or last sequence) are put together from the sums of several parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import kept, shuffle_width

#: conversations c, c + 1, ... that begin alike, and the divisor that gives how many turns they share
GROUP, HEADS = 100, 6
#: bytes that stand for a turn
DIGEST = 16
#: ids that are written into one text before texts of a sequence meet
IDS_TOGETHER = 256
#: turns in a part of the sorted sequences, on average
TURNS_PER_PART = 250_000
#: prefixes that are searched for together
SEARCHED_TOGETHER = 200_000
#: rows of prefixes over several parts that may be broadcast
BROADCAST_ROWS = 50_000
#: characters of a text that order rows of one turn and role; beyond them its digest does
ORDERED_BY = 64

SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
PART_SCHEMA = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary"
SEQUENCE_SCHEMA = "key binary, sizes array<long>, n long, first_conv long, ends_sha256 string"
#: a prefix before the first turn
NOWHERE = -1
NO_ENDS = hashlib.sha256(b"").hexdigest()


def head(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its group."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): every conversation as the digests and lengths of its rebuilt turns.

    Turns go by ``turn``, null first; rows of one turn by role, the first
    ``ORDERED_BY`` characters of the text, and its digest.  Null roles and texts
    are empty.  Rows without ``conv_id`` are no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    row = F.struct(
        F.col("turn"), role.alias("role"), F.substring(text, 1, ORDERED_BY).alias("head"),
        F.substring(named, 1, 2 * DIGEST).alias("digest"), F.char_length(text).cast("long").alias("size"),
    )
    own = turns.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    own = own.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])).alias("turns"))
    own = kept(own, "conversations")
    first = own.where(f"conv_id % {GROUP} = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("heads"))
    joined = own.withColumn("base", F.expr(f"conv_id - conv_id % {GROUP}")).join(first, "base", "left")
    h = head(F.col("conv_id"))
    none = F.expr("cast(array() as array<struct<digest:string,size:bigint>>)")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    all_ = F.concat(F.coalesce(F.slice("heads", F.lit(1), h), none), rest)
    return joined.select("conv_id", all_.alias("t")).select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["digest"]), "")).alias("key"), F.col("t.size").alias("sizes")
    )


def distinct_sequences(members: DataFrame) -> DataFrame:
    """``SEQUENCE_SCHEMA``: every sequence once, with the number, the least and the digest of its conversations.

    The ids of a sequence are written into texts of a bounded number of ids
    first; a digest of ids in order has to see them one after the other, so these
    texts (not rows of conversations) meet in one task, which reads them as a stream.
    """
    bucket = F.expr(f"(conv_id - pmod(conv_id, {IDS_TOGETHER})) div {IDS_TOGETHER}")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    texts = members.groupBy("key", bucket.alias("bucket")).agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("first_conv"), ids.alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told, n, ends = None, None, 0, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["key"] != now:
                    if now is not None:
                        out.append({**told, "n": n, "ends_sha256": ends.hexdigest()})
                    now, told = row["key"], {c: row[c] for c in ("key", "sizes", "first_conv")}
                    n, ends = 0, hashlib.sha256()
                else:
                    ends.update(b",")
                n += row["n"]
                ends.update(row["ids"].encode())
            yield _batch(out)
        if now is not None:
            yield _batch([{**told, "n": n, "ends_sha256": ends.hexdigest()}])

    met = texts.repartition("key").sortWithinPartitions("key", "bucket")
    return met.select("key", "sizes", "n", "first_conv", "ids").mapInArrow(digest, SEQUENCE_SCHEMA)


_SEQUENCES = pa.schema([("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("first_conv", pa.int64()), ("ends_sha256", pa.string())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SEQUENCES)


# ------------------------------------------------------------------ one part


def shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns at the beginning of both; ``NOWHERE`` if there is none of one."""
    if a is None or b is None:
        return NOWHERE
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class RangeMinimum:
    """A sparse table: row k holds the minimum of 2 ** k values from each place on."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values)]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum from ``first`` to ``last``, both included, of each pair."""
        k = np.frexp((last - first + 1).astype("f8"))[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for level in np.unique(k):
            at, row = k == level, self.rows[level]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << level) + 1])
        return out

    def reach_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on whose value is below ``least``; the length if there is none."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            fits = at < len(row)
            fits[fits] = row[at[fits]] >= least[fits]
            at[fits] += 1 << k
        return at

    def reach_left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to ``start`` whose value is below ``least``; -1 if there is none."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, first = self.rows[k], at - (1 << k) + 1
            fits = first >= 0
            fits[fits] = row[first[fits]] >= least[fits]
            at[fits] -= 1 << k
        return at


class Part:
    """Some neighbouring sequences, sorted, with what the sequences before and behind them are."""

    def __init__(self, rows: pa.Table, before: bytes | None, behind: bytes | None):
        keys = rows["key"].to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        rows = rows.take(pa.array(order))
        self.keys = [keys[i] for i in order]
        self.n = rows["n"].to_numpy()
        self.first_conv = RangeMinimum(rows["first_conv"].to_numpy())
        self.ends = np.array(rows["ends_sha256"].to_pylist(), object)
        self.length = np.array([len(k) // DIGEST for k in self.keys], "i8")
        m = len(self.keys)
        ring = [before, *self.keys, behind]
        #: lcp[i] is shared by sequences i - 1 and i
        self.lcp = np.array([shared_turns(a, b) for a, b in zip(ring[:-1], ring[1:], strict=True)], "i8")
        #: between sequences of the part only: place i stands between i and i + 1
        self.inner = RangeMinimum(self.lcp[1:m]) if m > 1 else None
        #: characters of the first d turns of sequence i, at begin[i] + d
        self.begin = np.concatenate([[0], np.cumsum(self.length + 1)])
        sizes = rows["sizes"].combine_chunks()
        self.upto = np.zeros(self.begin[-1], "i8")
        place = np.repeat(self.begin[:-1] + 1, self.length) + _places(self.length)
        turns = sizes.flatten().to_numpy()
        running = np.cumsum(turns)
        passed = np.concatenate([[0], running])[np.cumsum(self.length) - self.length]
        self.upto[place] = running - np.repeat(passed, self.length)
        whole = self.upto[self.begin[1:] - 1]
        #: characters of the prefixes that are first met in sequence i
        new = whole - self.upto[self.begin[:-1] + np.maximum(self.lcp[:m], 0)]
        leaf = self.lcp[1:] < self.length
        self.of_n, self.of_all, self.of_new, self.of_leaf = (np.concatenate([[0], np.cumsum(x)]) for x in (self.n, self.n * whole, new, leaf))
        #: places of each lcp, to count those of one value in an interval
        self.level = np.sort(self.lcp[:m] * (m + 1) + np.arange(m))

    def nodes(self) -> pa.Table:
        """A row for each prefix that begins in the part or reaches into it: ``PART_SCHEMA``."""
        rows = np.arange(len(self.keys))
        blocks, at = [], 0
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(self.begin, self.begin[at] + SEARCHED_TOGETHER, "right")) - 1)
            blocks.append(self._nodes(rows[at:to]))
            at = to
        return pa.concat_tables(blocks)

    def extents(self, i: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last sequence of the part that begin with the first d turns of sequence i."""
        if self.inner is None:
            return np.zeros_like(i), np.zeros_like(i)
        return self.inner.reach_left(i - 1, d) + 1, self.inner.reach_right(i, d)

    def _nodes(self, rows: np.ndarray) -> pa.Table:
        m = len(self.keys)
        i = np.repeat(rows, self.length[rows] + 1)
        d = _places(self.length[rows] + 1)
        left, right = self.extents(i, d)
        # the prefix above it is that of the row before; the root has none
        above = [np.concatenate([[0], x[:-1]]) for x in (left, right)]
        own = left == i  # one of the members stands for all: the first
        i, d, left, right, up_left, up_right = (x[own] for x in (i, d, left, right, *above))
        open_left = (left == 0) & (self.lcp[0] >= d)
        open_right = (right == m - 1) & (self.lcp[m] >= d)
        # for an only sequence of a part both are told by its neighbours
        up = d - 1
        up_open = (d > 0) & ((up_left == 0) & (self.lcp[0] >= up) | (up_right == m - 1) & (self.lcp[m] >= up))
        shared = np.where(d > 0, self.upto[self.begin[i] + np.maximum(up, 0)], 0)
        n_convs = self.of_n[right + 1] - self.of_n[left]
        first_new = np.where(open_left, self.of_new[left + 1] - self.of_new[left], self.upto[self.begin[i + 1] - 1] - shared)
        new = self.of_new[right + 1] - self.of_new[left + 1] + first_new
        inside = np.searchsorted(self.level, d * (m + 1) + right, "right") - np.searchsorted(self.level, d * (m + 1) + left, "right")
        first_child = np.where(open_left, self.lcp[left] == d, self.length[i] > d)
        border = open_left | open_right
        known = (d > 0) & ~up_open
        parent = np.zeros(len(i), "i8")
        parent[known] = self.first_conv.least(up_left[known], up_right[known])
        ends = np.where((self.length[i] == d) & ~open_left, self.ends[i], None)
        names: dict[tuple[int, int], bytes] = {}

        def named(k: int, depth: int) -> bytes:
            if (k, depth) not in names:
                names[k, depth] = hashlib.blake2b(self.keys[k][: depth * DIGEST], digest_size=DIGEST).digest()
            return names[k, depth]

        columns = {
            "conv_id": pa.array(self.first_conv.least(left, right), pa.int64()),
            "depth": pa.array(d, pa.int64()),
            "parent_conv_id": pa.array(parent, pa.int64(), mask=~known),
            "n_convs": pa.array(n_convs, pa.int64()),
            "n_children": pa.array(inside + first_child, pa.int64()),
            "n_leaves": pa.array(self.of_leaf[right + 1] - self.of_leaf[left], pa.int64()),
            "saved_tokens": pa.array(self.of_all[right + 1] - self.of_all[left] - n_convs * shared - new, pa.int64()),
            "ends_sha256": pa.array(ends.tolist(), pa.string()),
            "node": pa.array([named(a, b) if x else None for a, b, x in zip(left.tolist(), d.tolist(), border.tolist(), strict=True)], pa.binary()),
            "parent": pa.array([named(a, b) if x else None for a, b, x in zip(up_left.tolist(), up.tolist(), up_open.tolist(), strict=True)], pa.binary()),
        }
        return pa.table(columns)


def _places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


# ------------------------------------------------------------------ all parts


def trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: ``COLUMNS``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not read.  Rows
    that repeat are turns of their own.  A conversation that is left without turns
    ends at the root, the prefix of depth 0, which has no parent.  Rows without a
    ``conv_id`` belong to no conversation; an empty table has no prefixes.
    """
    spark = turns.sparkSession
    members = kept(rebuilt(turns), "members")
    found = kept(distinct_sequences(members), "sequences")
    size = found.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    parts = max(shuffle_width(spark), -(-size // TURNS_PER_PART))
    dealt = found.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    dealt = kept(dealt, "parts")
    # two keys for each part
    edges = dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    around = {
        r["part"]: (bytes(edges[k - 1]["last"]) if k else None, bytes(edges[k + 1]["first"]) if k + 1 < len(edges) else None)
        for k, r in enumerate(edges)
    }
    shared = spark.sparkContext.broadcast(around)

    def walk(key: tuple, rows: pa.Table) -> pa.Table:
        return Part(rows, *shared.value[key[0].as_py()]).nodes()

    told = kept(dealt.groupBy("part").applyInArrow(walk, PART_SCHEMA), "prefixes")
    sums = [F.sum(c).alias(c) for c in SUMS]
    over = told.where("node is not null").groupBy("node", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256")
    )
    over = kept(over, "borders").withColumn("parent_conv_id", F.lit(None).cast("long"))
    every = told.where("node is null").select("parent", *COLUMNS).unionByName(over.select("parent", *COLUMNS))
    parents = over.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    if parents.count() <= BROADCAST_ROWS:
        parents = F.broadcast(parents)
    below = every.where("parent is not null").drop("parent_conv_id").join(parents, "parent").withColumnRenamed("above", "parent_conv_id")
    whole = every.where("parent is null").select(*COLUMNS).unionByName(below.select(*COLUMNS))
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
