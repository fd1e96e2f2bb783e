"""Exact Jaccard join of word-shingle sets: a size-aware heavy-light join.

Equal sets are one class, named by a 64-bit digest.  Classes meet through keys
taken from the rare end of their shingles: small (light) sets enumerate all
pairs of a prefix, large (heavy) sets post single shingles to inverted lists;
the boundary between them is where the two cost the same.  Both are exact
prefix filters, whatever the order of shingles; the order used is a frequency
estimated over all documents, so passages that many share come last.

Links only matter up to connection.  In each list two hubs, the members with the
fewest rarer shingles, are compared with all others; members that are still in
different components after that are compared in a second round.  A bottom
sketch screens candidates (it errs on a link with a chance below 1e-12), and
then their whole texts are compared exactly.

Sets go between tasks as packed arrays, and only one pass holds keys: a shuffle
never carries a set, and carries a text only for the pairs to be compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import connected
from plumbline.llm.tables import kept, shuffle_width

WORDS = 5
#: least similarity, as a fraction
LEAST = (75, 100)
#: hashes of a sketch, and the least share of common ones for a comparison
SKETCH = 96
SCREEN = 0.36
#: counters of the frequency table, whose size is its bound: one byte each is broadcast
COUNTERS = 1 << 25
#: slots of the table that are worked on at once in the driver
PIECE = 1 << 20
#: lists expected to be longer are dealt to several tasks
HOT_LIST = 4096
#: postings that a task gathers before it sends them, and those of a part of the key space on average
POSTINGS_TOGETHER, POSTINGS_PER_PART = 300_000, 2_000_000
#: members of a list that wait in one row for those outside its largest component
BLOCK_MEMBERS = 4096
#: bits of the filter that keeps texts of no interest where they are
FILTER_BITS = 1 << 27

SET_SCHEMA = "doc_id long, text_hash long, n_shingles long, fp long, sketch binary"
BLOB_SCHEMA = "part int, data binary"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


# ------------------------------------------------------------------ shingles


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(2 * n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.array([1] + [b] * (n - 1), np.uint64)) for b in (_BASE, _UNBASE))

    def __call__(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        if not len(data):
            return np.empty(0, np.uint64)
        space = _IS_SPACE[data]
        edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
        if not len(edges):
            return np.empty(0, np.uint64)
        starts, ends = edges[::2], edges[1::2]
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _PLACES[0])
        n = len(words)
        k = min(n, WORDS)
        mixed = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            mixed += words[j : n - k + 1 + j] * _PLACES[j]
            mixed = (mixed << np.uint64(7)) | (mixed >> np.uint64(57))
        return np.unique(_mixed(mixed))


def digest(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def least_overlap(n, m):
    """Least common shingles of linked sets of n and m: the fraction t of the union is t/(1+t) of n+m."""
    a, b = LEAST
    return -(-a * (n + m) // (a + b))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return LEAST[1] * common >= LEAST[0] * (len(a) + len(b) - common)


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among the smallest of both sketches."""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    union = len(both) - int(twice.sum())
    if union <= SKETCH:
        return (len(both) - union) / max(1, union)
    first = np.concatenate([[True], ~twice])
    end = np.flatnonzero(first)[SKETCH] if union > SKETCH else len(both)
    return float(twice[: end - 1].sum()) / SKETCH


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The different sets of a task's texts."""
    shingle, seen = Shingler(), set()
    for batch in batches:
        for text in batch["text"]:
            s = shingle(text.as_py() or "")
            if len(s) and (fp := digest(s)) not in seen:
                seen.add(fp)
                yield fp, s


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``SET_SCHEMA`` of every row: size, digest (null for no words) and sketch of its set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            size, fp, sketch = [], [], []
            for text in batch["text"]:
                s = shingle(text.as_py() or "")
                size.append(len(s))
                fp.append(digest(s) if len(s) else None)
                sketch.append((s[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes())
            columns = [batch["doc_id"], batch["text_hash"], pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(sketch, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "n_shingles", "fp", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash()).mapInArrow(rows, SET_SCHEMA)


def _text_hash():
    """A name for a text that is found without its shingles."""
    return F.xxhash64("text").alias("text_hash")


# ------------------------------------------------------------------ frequencies


def _blobs(parts: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])


def _slot(shingles: np.ndarray, width: int) -> np.ndarray:
    return (shingles >> np.uint64(8)).astype(np.int64) & (width - 1)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact below 96, then 16 steps to a doubling."""
    high = 96 + np.floor(16 * np.log2(np.maximum(counts, 96) / 96))
    return np.where(counts < 96, counts, np.minimum(high, 255)).astype(np.uint8)


def _count_of(level: np.ndarray) -> np.ndarray:
    return np.where(level < 96, level, 96 * 2 ** ((level.astype(np.float64) - 96) / 16))


def frequency_levels(docs: DataFrame, width: int) -> np.ndarray:
    """For each of ``width`` slots, in how many sets its shingles are, as a level.

    All rows are counted.  A task sends the slots it met as differences of one
    or two bytes; slots are summed by ranges, and the table of ``width`` bytes
    is all that reaches the driver.
    """
    parts = min(width, shuffle_width(docs.sparkSession))
    span = -(-width // parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, s in _distinct(batches):
            held.append(_slot(s, width))
            size += len(s)
            if size > 2_000_000:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def packed(held) -> pa.RecordBatch:
        slots = np.sort(np.concatenate(held))
        cuts = np.searchsorted(slots, span * np.arange(parts + 1))
        out, data = [], []
        for p in range(parts):
            mine = slots[cuts[p] : cuts[p + 1]]
            if len(mine):
                steps = np.diff(mine, prepend=p * span)
                wide = np.flatnonzero(steps > 254)
                small = steps.astype(np.uint8)
                small[wide] = 255
                out.append(p)
                data.append(np.int64(len(small)).tobytes() + small.tobytes() + steps[wide].astype("<u4").tobytes())
        return _blobs(out, data)

    def summed(key: tuple, group: pa.Table) -> pa.Table:
        p = key[0].as_py()
        counts = np.zeros(span, np.int64)
        for blob in group["data"]:
            raw = blob.as_buffer()
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            steps = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
            steps[steps == 255] = np.frombuffer(raw, np.uint8, offset=8 + n).view("<u4")
            counts += np.bincount(np.cumsum(steps), minlength=span)
        return pa.table({"part": pa.array([p], pa.int32()), "data": pa.array([_levels(counts).tobytes()], pa.binary())})

    dealt = docs.select("text").mapInArrow(count, BLOB_SCHEMA)
    table = np.zeros(span * parts, np.uint8)
    # as Arrow batches: rows would hold the table once more in the driver
    found = dealt.groupBy("part").applyInArrow(summed, BLOB_SCHEMA).toArrow()
    for part, data in zip(found["part"].to_pylist(), found["data"], strict=True):
        table[part * span : (part + 1) * span] = np.frombuffer(data.as_buffer(), np.uint8)
    return table[:width]


def _slots_by_level(levels: np.ndarray) -> np.ndarray:
    """How many slots have each level; by pieces, since ``bincount`` makes eight bytes of each."""
    return sum((np.bincount(levels[i : i + PIECE], minlength=256) for i in range(0, len(levels), PIECE)), np.zeros(256, np.int64))


def boundary(levels: np.ndarray) -> int:
    """The size up to which enumerating pairs of the prefix costs no more than scanning lists.

    A set of n has a prefix of p = n/4 + 1 shingles; its pairs are about
    p(p+1)/2, its lists p, each read up to the mean length of a list: p(1 + L).
    They meet at p = 1 + 2L.  L comes from the frequency table, less what
    different shingles in one slot add to it.
    """
    slots, counts = _slots_by_level(levels), _count_of(np.arange(256))
    total = float((slots * counts).sum())
    if not total:
        return 3
    mean = float((slots * counts**2).sum()) / total - 1 - total / len(levels)
    return int(max(3, min(8 * max(mean, 0.5), 64)))


# ------------------------------------------------------------------ keys and lists


def _postings(fp: int, s: np.ndarray, levels: np.ndarray, bound: int):
    """(kind, key, position, level) of one set; kind 0: pairs among small sets, 1: lists that hold large ones."""
    n = len(s)
    rank = levels[_slot(s, len(levels))]
    order = np.argsort(rank, kind="stable")
    least = least_overlap(n, -(-LEAST[0] * n // LEAST[1]))
    single = n - least + 1
    if n <= bound:
        two = order[: single + 1]
        i, j = np.triu_indices(len(two), 1)
        yield 0, _mixed(s[two[i]] * np.uint64(3) + _mixed(s[two[j]])), i, rank[two[i]]
    if n > bound * LEAST[0] / LEAST[1]:
        one = order[:single]
        yield 1, _mixed(s[one]), np.arange(len(one)), rank[one]


class _Packer:
    """Gathers postings of a task and sends them by parts of the key space."""

    def __init__(self, parts: int):
        self.parts, self.docs, self.keys, self.places, self.owners, self.kinds, self.hot, self.size = parts, [], [], [], [], [], [], 0

    def add(self, fp: int, n: int, kind: int, key: np.ndarray, place: np.ndarray, level: np.ndarray) -> None:
        self.keys.append(key)
        self.places.append(np.minimum(place, 65535).astype(np.uint16))
        self.kinds.append(np.full(len(key), kind, np.uint8))
        copies = np.ceil(_count_of(level) / HOT_LIST).astype(np.uint64)
        self.hot.append(np.where(copies > 1, np.uint64(fp & 0xFFFFFFFF) % np.maximum(copies, 1) + np.uint64(1), np.uint64(0)))
        self.owners.append(np.full(len(key), len(self.docs), np.uint32))
        self.size += len(key)

    def flush(self) -> pa.RecordBatch:
        key, hot = np.concatenate(self.keys), np.concatenate(self.hot)
        columns = [np.concatenate(c) for c in (self.owners, self.places, self.kinds)]
        part = ((key >> np.uint64(48)) + hot * np.uint64(7919)) % np.uint64(self.parts)
        order = np.lexsort((key & np.uint64((1 << 48) - 1), part))
        cuts = np.searchsorted(part[order], np.arange(self.parts + 1))
        fps, sizes = np.array([d[0] for d in self.docs], "<i8"), np.array([d[1] for d in self.docs], "<u4")
        out, data = [], []
        for p in range(self.parts):
            mine = order[cuts[p] : cuts[p + 1]]
            if len(mine):
                used, owner = np.unique(columns[0][mine], return_inverse=True)
                k = key[mine]
                data.append(
                    np.array([len(used), len(mine)], "<i8").tobytes()
                    + fps[used].tobytes() + sizes[used].tobytes() + owner.astype("<u4").tobytes()
                    + (k & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + ((k >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes()
                    + columns[1][mine].tobytes() + columns[2][mine].tobytes() + (hot[mine] > 0).astype(np.uint8).tobytes()
                )
                out.append(p)
        return _blobs(out, data)


def _unpacked(blob) -> tuple[np.ndarray, ...]:
    raw = memoryview(blob)
    docs, n = np.frombuffer(raw, "<i8", 2)
    at, found = 16, []
    for kind, size in (("<i8", docs), ("<u4", docs), ("<u4", n), ("<u4", n), ("<u2", n), ("<u2", n), ("<u1", n), ("<u1", n)):
        found.append(np.frombuffer(raw, kind, size, at))
        at += found[-1].nbytes
    fps, sizes, owner, low, high, place, kind, hot = found
    key = low.astype(np.int64) | (high.astype(np.int64) << 32)
    return key, fps[owner], sizes[owner].astype(np.int64), place.astype(np.int64), kind, hot


LIST_SCHEMA = "list long, a long, n int, place int, b long, m int"


def meetings(docs: DataFrame, levels: np.ndarray, bound: int) -> DataFrame:
    """What the lists say: pairs of a hub and a member (``list`` null), and the members of longer lists."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(levels)
    # a set has about a quarter of its shingles in its prefix
    shingles = float((_slots_by_level(levels) * _count_of(np.arange(256))).sum())
    parts = max(shuffle_width(spark), min(65536, int(shingles / 4 / POSTINGS_PER_PART)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, packer = shared.value, _Packer(parts)
        for fp, s in _distinct(batches):
            if len(s) < 3:  # only equal sets are near enough
                continue
            for posting in _postings(fp, s, table, bound):
                packer.add(fp, len(s), *posting)
            packer.docs.append((fp, len(s)))
            if packer.size > POSTINGS_TOGETHER:
                yield packer.flush()
                packer = _Packer(parts)
        if packer.size:
            yield packer.flush()

    def meet(group: pa.Table) -> pa.Table:
        key, fp, n, place, kind, hot = (np.concatenate(c) for c in zip(*[_unpacked(b.as_buffer()) for b in group["data"]], strict=True))
        order = np.lexsort((fp, key))
        same = (key[order][1:] == key[order][:-1]) & (fp[order][1:] == fp[order][:-1])
        order = order[np.concatenate([[True], ~same])]
        key, fp, n, place, kind, hot = (c[order] for c in (key, fp, n, place, kind, hot))
        _, first, size = np.unique(key, return_index=True, return_counts=True)
        keep = np.repeat((size > 1) | (hot[first] > 0), size)
        key, fp, n, place, kind, hot = (c[keep] for c in (key, fp, n, place, kind, hot))
        order = np.lexsort((fp, place, key))
        key, fp, n, place, kind, hot = (c[order] for c in (key, fp, n, place, kind, hot))
        if not len(key):
            return _lists([])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(first, append=len(key))
        start, rank = np.repeat(first, size), np.arange(len(key)) - np.repeat(first, size)
        pairs = []
        for hub in (0, 1):
            member = np.flatnonzero(rank > hub)
            h = start[member] + hub
            fits = _may_link(n[h], place[h], n[member], place[member], kind[member], bound)
            pairs.append(np.stack([fp[h], n[h], fp[member], n[member]])[:, fits])
        a, na, b, nb = np.concatenate(pairs, axis=1)
        swap = a > b
        a, na, b, nb = np.where(swap, b, a), np.where(swap, nb, na), np.where(swap, a, b), np.where(swap, na, nb)
        one = np.unique(np.stack([a, b, na, nb]), axis=1) if len(a) else np.empty((4, 0), np.int64)
        # longer lists: of those with the same members the first in the order of shingles stands for all
        scrambled = _mixed(fp.astype(np.uint64))
        members = np.add.reduceat(scrambled, first).astype(np.int64)
        long_, is_hot = size > 3, hot[first] > 0
        plain = np.flatnonzero(long_ & ~is_hot)
        plain = plain[np.lexsort((place[first[plain]], members[plain]))]
        plain = plain[np.concatenate([[True], members[plain][1:] != members[plain][:-1]])] if len(plain) else plain
        name = np.where(is_hot, key[first], members)
        chosen = np.sort(np.concatenate([plain, np.flatnonzero(is_hot)]))
        rows = np.flatnonzero(np.isin(start, first[chosen]))
        name = np.repeat(name, size)[rows]
        return _lists([(None, one[0], one[2], None, one[1], one[3]), (name, fp[rows], n[rows], place[rows], None, None)])

    def _lists(parts_) -> pa.Table:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        names = [c.split()[0] for c in LIST_SCHEMA.split(", ")]
        tables = [
            pa.table([pa.nulls(len(p[1]), k) if c is None else pa.array(c, k) for c, k in zip(p, kinds, strict=True)], names=names)
            for p in parts_
        ]
        return pa.concat_tables(tables) if tables else pa.table([pa.array([], k) for k in kinds], names=names)

    packed = docs.select("text").mapInArrow(post, BLOB_SCHEMA)
    return packed.groupBy("part").applyInArrow(meet, LIST_SCHEMA)


def _may_link(n, i, m, j, kind, bound):
    """Sizes near enough, enough shingles left behind both places, and not a pair that the other kind finds."""
    need = least_overlap(n, m)
    near = (LEAST[1] * n >= LEAST[0] * m) & (LEAST[1] * m >= LEAST[0] * n)
    left = np.minimum(n - i, m - j) >= need
    mine = np.where(kind == 0, True, np.maximum(n, m) > bound)
    return near & left & mine


# ------------------------------------------------------------------ comparing


def _screened(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) with the likeness of their sketches, without those that cannot be links."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [
                alike(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4"))
                for x, y in zip(batch["x"], batch["y"], strict=True)
            ]
            out = pa.record_batch([batch["a"], batch["b"], pa.array(like, pa.float64())], names=["a", "b", "like"])
            yield out.filter(pa.array([v >= SCREEN for v in like], pa.bool_()))

    both = pairs.join(sketches.select(F.col("fp").alias("a"), F.col("sketch").alias("x")), "a").join(
        sketches.select(F.col("fp").alias("b"), F.col("sketch").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, like double")


def _membership_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of at most ``FILTER_BITS`` bits, built by parts; it may let others pass, never hold one back."""
    count = ids.count()
    bits = min(FILTER_BITS, 1 << max(16, int(16 * count).bit_length()))
    parts = min(64, bits >> 13)
    span = bits // parts

    def build(key: tuple, group: pa.Table) -> pa.Table:
        field = np.zeros(span, bool)
        field[group["bit"].to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([np.packbits(field).tobytes()], pa.binary())})

    spots = ids.select(F.explode(F.array(*_spots(bits))).alias("spot")).distinct()
    dealt = spots.select(F.floor(F.col("spot") / span).cast("int").alias("part"), (F.col("spot") % span).alias("bit"))
    table = np.zeros((parts, span // 8), np.uint8)
    for row in dealt.groupBy("part").applyInArrow(build, BLOB_SCHEMA).collect():
        table[row["part"]] = np.frombuffer(row["data"], np.uint8)
    return table.reshape(-1)


def _spots(bits: int) -> list:
    return [F.pmod(F.xxhash64("text_hash", F.lit(k)), F.lit(bits)).alias(f"h{k}") for k in range(2)]


def _compared(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, by their whole texts.

    One text stands for each class.  Only texts that the filter lets pass leave
    the task that reads them.
    """
    one = sets.where("fp is not null").groupBy("fp").agg(F.min("text_hash").alias("text_hash"))
    ids = kept(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(one, "fp"), "texts")
    bits = docs.sparkSession.sparkContext.broadcast(_membership_filter(ids))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = bits.value, set()
        for batch in batches:
            spots = np.stack([batch[f"h{k}"].to_numpy() for k in range(2)])
            hit = ((table[spots >> 3] >> (7 - (spots & 7)).astype(np.uint8)) & 1).all(axis=0)
            names = batch["text_hash"].to_numpy()
            for i in np.flatnonzero(hit):
                hit[i] = names[i] not in seen
                seen.add(names[i])
            yield batch.select(["text_hash", "text"]).filter(pa.array(hit))

    texts = (
        docs.where("text is not null")
        .select("text", _text_hash())
        .select("text_hash", "text", *_spots(8 * len(bits.value)))
        .mapInArrow(wanted, "text_hash long, text string")
        .groupBy("text_hash")
        .agg(F.first("text").alias("text"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last, held = Shingler(), None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch["a"].to_pylist(), batch["x"], batch["y"], strict=True):
                if a != last:
                    last, held = a, shingle(x.as_py())
                keep.append(linked(held, shingle(y.as_py())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    named = pairs.select("a", "b")
    for end, text in (("a", "ta"), ("b", "tb")):
        named = named.join(ids.select(F.col("fp").alias(end), F.col("text_hash").alias(text)), end)
    for text, end in (("tb", "y"), ("ta", "x")):
        named = named.join(texts.select(F.col("text_hash").alias(text), F.col("text").alias(end)), text)
    return named.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


# ------------------------------------------------------------------ the join


def joined(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest id reachable by links.  Null and empty
    texts, and texts of white space, have an empty set and no links: their
    component is their own id.  Rows of equal sets are linked, so repeated rows
    share a component; a null id takes part but never names one, unless all ids
    of a component are null.  An empty table gives no rows.  Other columns than
    ``doc_id`` and ``text`` are not read.
    """
    rows = rooted(docs)
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(names, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def rooted(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, n_shingles, root``; rows of one component share a root, empty sets have none."""
    docs = docs.select("doc_id", "text")
    sets = kept(shingle_sets(docs), "sets")
    roots = components(docs, sets)
    rows = sets.select("doc_id", "text_hash", "n_shingles", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rows.select("doc_id", "text_hash", "n_shingles", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of every class of equal sets that has a link to another."""
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    width = min(COUNTERS, 1 << max(12, int(total).bit_length()))
    levels = frequency_levels(docs, width)
    lists = kept(meetings(docs, levels, boundary(levels)), "lists")
    sketches = sets.where("fp is not null").groupBy("fp").agg(F.first("sketch").alias("sketch"))

    stars = lists.where("list is null").select("a", "b").distinct()
    candidates = kept(_screened(stars, sketches), "candidates")
    # first the likeliest partner of each class, then only what these have not connected
    ways = candidates.unionByName(candidates.select(F.col("b").alias("a"), F.col("a").alias("b"), "like"))
    best = ways.groupBy("a").agg(F.max(F.struct("like", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = kept(_compared(best, docs, sets), "links")
    roots = connected(near)

    rest = _apart(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), roots)
    across = _screened(_across(lists.where("list is not null"), roots), sketches).select("a", "b")
    open_ = kept(rest.unionByName(across).distinct(), "candidates")
    if open_.isEmpty():
        return roots
    return connected(near.unionByName(_compared(open_, docs, sets)))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    found = pairs.join(a, "a", "left").join(b, "b", "left")
    return found.where(~F.coalesce("root_a", "a").eqNullSafe(F.coalesce("root_b", "b"))).select("a", "b")


def _across(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of one list whose ends are in different components.

    Only members outside a list's largest component look for partners, so a list
    of many copies costs as much as it has strangers.
    """
    members = lists.select("list", F.col("a").alias("fp"), "n", "place").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    members = members.select("list", "fp", "n", "place", F.coalesce("root", "fp").alias("root"))
    sizes = members.groupBy("list", "root").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("list").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("roots"), F.sum("c").alias("members")).where("roots > 1")
    inside = members.join(mixed.select("list", F.col("m.root").alias("largest"), "members"), "list")
    # members wait in blocks of bounded size, so a pair that shares many lists is not a row for each
    block = F.pmod(F.xxhash64("fp"), F.ceil(F.col("members") / BLOCK_MEMBERS)).alias("block")
    blocks = inside.select("list", block, F.struct("fp", "n", "place", "root").alias("y")).groupBy("list", "block").agg(F.collect_list("y").alias("ys"))
    strangers = inside.where("root <> largest").select("list", F.col("fp").alias("a"), "n", "place", "root")
    p, q = LEAST

    def fits(y):
        need = F.ceil(F.lit(p) * (F.col("n") + y["n"]) / F.lit(p + q))
        return (
            (F.col("root") != y["root"])
            & (q * F.col("n") >= p * y["n"])
            & (q * y["n"] >= p * F.col("n"))
            & (F.least(F.col("n") - F.col("place"), y["n"] - y["place"]) >= need)
        )

    met = strangers.join(blocks, "list").select("a", F.transform(F.filter("ys", fits), lambda y: y["fp"]).alias("bs")).where("size(bs) > 0")
    once = met.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("bs"))).alias("bs"))
    pairs = once.select("a", F.explode("bs").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
