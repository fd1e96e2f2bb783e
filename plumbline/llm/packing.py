"""Packing token sequences into windows of fixed size by best-fit decreasing.

Documents are tokenized where they lie and cut into full windows first; what
remains of each is shorter than a window.  Full windows are sequences as they are
and do not move.  The remainders with their ids are dealt to partitions of bounded
size, and each partition packs its own and writes the ids of every sequence together.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.tables import kept, small_batches

WINDOW = 1024
#: a file of the public tokenizers
TOKENIZER = "byte_bpe_50k.json"
#: closes every document
END_ID = 0
#: pieces a partition packs together; the loss at its end is under one window in some thousands
PIECES_PER_TASK = 8192
#: characters that both pattern engines class alike; texts with others are encoded whole
UNALIKE = re.compile("[^\x00-\x1b\x20-\x84\x86-\u024f\u2010-\u2027]")
#: a space that no visible character follows
UNEVEN = re.compile(r" (?!\S)")
#: words remembered by a Python worker
MEMORY = 600_000
#: texts whose words are looked up together
TEXTS_AT_ONCE = 256
#: pieces or sequences that leave a task together
PIECES_AT_ONCE = 1024

#: ids are little-endian unsigned 32-bit numbers; slot names the row
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, slot long, ids binary"
PLACED_NAMES = ["doc_id", "start", "length", "doc_tokens", "offset"]
SEQUENCE_SCHEMA = (
    "sequence_id long, padded_length long, ids binary, pieces array<struct<" + ", ".join(f"{n}: long" for n in PLACED_NAMES) + ">>"
)
PACKED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes; those of words are remembered.

    A pre-token never starts before and ends behind a space that a visible
    character follows, and byte pairs never cross a pre-token.  So the ids of a
    text are those of its words, each with the space before it.  New words are
    encoded together, by the same vocabulary in its fast form.  Texts with other
    spacing, with characters of ``UNALIKE``, or with an added token such as
    ``<|endoftext|>`` are encoded whole.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: unusual spacing or letters, or a token that only the tokenizer knows
        self.odd = re.compile("|".join([UNALIKE.pattern, UNEVEN.pattern, *added]))
        vocabulary = Path(public_tokenizers.path(str(Path(name).with_suffix(".tiktoken")))).read_bytes()
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, vocabulary.splitlines())}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        even = [None if self.odd.search(t) else t.split(" ") for t in texts]
        self.learn(set().union(*[w[1:] for w in even if w]))
        return [self._whole(t) if w is None else self._joined(w) for t, w in zip(texts, even, strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _joined(self, words: list[str]) -> bytes:
        head = np.array(self.fast.encode_ordinary(words[0]), "<u4").tobytes()
        return head + b"".join(map(self.known.__getitem__, words[1:]))

    def learn(self, words: set[str]) -> None:
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list(words.difference(self.known))
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(new)) if new else [], "<u4")
        starts = (4 * np.flatnonzero(self.spaced[ids])).tolist() + [4 * len(ids)]
        every = ids.tobytes()
        for word, at, end in zip(new, starts[:-1], starts[1:], strict=True):
            self.known[word] = every[at:end]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Full windows and remainders of every row: ``PIECE_SCHEMA``.

    ``doc_id`` and ``text`` are read; a null text is empty, and an empty one is
    the closing id alone.  Repeated rows are cut each by itself.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, slot = Encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            coded = [c + END_ID.to_bytes(4, "little") for c in encoder.ids([t or "" for t in batch["text"].to_pylist()])]
            sizes = np.array([len(c) // 4 for c in coded], "i8")
            count = -(-sizes // WINDOW)
            owner = np.repeat(np.arange(len(sizes)), count)
            start = WINDOW * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
            length = np.minimum(WINDOW, sizes[owner] - start)
            ends = np.concatenate([[0], 4 * np.cumsum(length)]).astype("i4")
            columns = [
                batch["doc_id"].take(pa.array(owner)),
                pa.array(start),
                pa.array(length),
                pa.array(sizes[owner]),
                pa.array(np.arange(slot, slot + len(owner))),
                pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(coded))]),
            ]
            slot += len(owner)
            made = pa.record_batch(columns, names=["doc_id", "start", "length", "doc_tokens", "slot", "ids"])
            yield from (made.slice(at, PIECES_AT_ONCE) for at in range(0, len(owner), PIECES_AT_ONCE))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECE_SCHEMA)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest that fits."""

    def __init__(self, window: int = WINDOW):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, n: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += n
            node >>= 1

    def push(self, capacity: int, sequence: int) -> None:
        """A window whose free part is its last ``capacity`` places."""
        if capacity:
            self.stacks[capacity].append((sequence, capacity))
            self._add(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of ``need`` or more."""
        node, count = need + self.size, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return self.stacks[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; sequences count from 0."""
    sequence, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    windows, made = OpenWindows(window), 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        found = windows.tightest(n)
        if found is None:
            found, made = (made, window), made + 1
        sequence[i], offset[i] = found[0], window - found[1]
        windows.push(found[1] - n, found[0])
    return sequence, offset


def _packed(rows: pa.Table, first: int) -> tuple[pa.Table, int]:
    """The sequences of some remainders, named by odd numbers from ``first`` on, and how many there are."""
    rows = rows.combine_chunks()
    lengths = rows["length"].to_numpy()
    sequence, offset = best_fit_decreasing(lengths)
    used = np.bincount(sequence, weights=lengths).astype("i8")
    rows = rows.append_column("offset", pa.array(offset)).take(pa.array(np.lexsort((offset, sequence))))
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(sequence))]), pa.int32())
    placed = pa.StructArray.from_arrays([rows[n].combine_chunks() for n in PLACED_NAMES], PLACED_NAMES)
    ids, cuts = rows["ids"].to_pylist(), ends.to_pylist()
    columns = {
        "sequence_id": pa.array(2 * np.arange(first, first + len(used)) + 1),
        "padded_length": pa.array(np.where((used & (used - 1)) == 0, used, WINDOW)),
        "ids": pa.array([b"".join(ids[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        "pieces": pa.ListArray.from_arrays(ends, placed),
    }
    return pa.table(columns), len(used)


def _packer(most: int):
    """Packs the remainders of a partition, ``most`` at a time."""

    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, room = TaskContext.get().partitionId() << 32, [], most
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                room -= held[-1].num_rows
                if not room:
                    made, n = _packed(pa.Table.from_batches(held), first)
                    yield from made.to_batches(max_chunksize=PIECES_AT_ONCE)
                    first, held, room = first + n, [], most
        if held:
            yield from _packed(pa.Table.from_batches(held), first)[0].to_batches(max_chunksize=PIECES_AT_ONCE)

    return pack_all


def sequences(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The packed training sequences, one row each: ``SEQUENCE_SCHEMA``.

    ``ids`` holds the sequence's tokens, at most ``WINDOW``; ``pieces`` says which
    document each run of them is from, without gaps from offset 0.  ``padded_length``
    is the size with padding, which is the window, or no padding at all where the
    ids fill a power of two.  Full windows have even names and the packed remainders
    odd ones.  Repeated rows are packed each, rows with a null id under that null; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    cut = kept(pieces(docs, tokenizer), "pieces", compression="zstd")
    full = F.col("length") == WINDOW
    placed = F.array(F.struct(*PLACED_NAMES[:-1], F.lit(0).cast("long").alias("offset")))
    size = F.lit(WINDOW).cast("long").alias("padded_length")
    whole = cut.where(full).select((2 * F.col("slot")).alias("sequence_id"), size, "ids", placed.alias("pieces"))
    rest = cut.where(~full)
    n = max(1, -(-rest.count() // PIECES_PER_TASK))
    # a slot is one row, so the deal is even, and a task that runs again gets the same rows; their order is settled by sorting
    dealt = rest.repartition(n, "slot").sortWithinPartitions("slot")
    return whole.unionByName(dealt.mapInArrow(_packer(2 * PIECES_PER_TASK), SEQUENCE_SCHEMA))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def listed(ids: pa.Array) -> pa.Array:
    """The ids of a sequence as numbers."""
    sizes = np.array([len(i.as_buffer()) // 4 if i.is_valid else 0 for i in ids])
    every = np.frombuffer(b"".join(i.as_py() or b"" for i in ids), "<i4")
    mask = ids.is_null() if ids.null_count else None
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(every), mask=mask)


def places(packed: DataFrame, whole: bool = False) -> DataFrame:
    """Every piece of ``sequences`` with its place: ``PACKED``, its checksum of the ids where they are now.

    With ``whole`` also ``sequence``: the ids of the whole sequence in the row of
    its first piece (offset 0), none in the others.
    """
    rows = packed.select("sequence_id", "padded_length", "ids", F.inline("pieces"))
    own = F.substring(F.col("ids"), (4 * F.col("offset") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    told = rows.withColumn("ids_crc32", F.crc32(own))
    if not whole:
        return told.select(*PACKED)
    return told.select(*PACKED, listed(F.when(F.col("offset") == 0, F.col("ids")).otherwise(F.lit(b""))).alias("sequence"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Every piece of every row with its place, and ``sequences`` with them: ``places`` of the whole."""
    return places(sequences(docs, tokenizer), whole=True)
