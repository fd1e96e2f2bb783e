"""Packing token sequences by vector best fit.

A window has several capacities: tokens, documents and attention cost (a piece
of n tokens costs n * n, since documents in a window do not see each other).  Of
the open windows that have room for a piece in every one of them, it goes to
that with the smallest weighted norm of what would be left, or with the largest
weighted dot product of its need and what is left.

Documents are tokenized where they lie.  Full windows are sequences as they are
and do not move; the remainders are dealt to partitions of bounded size, and
each partition packs its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.packing import TOKENIZER, Encoder
from plumbline.llm.tables import kept, small_batches

WINDOW = 1024
#: closes every document
END_ID = 2
#: remainders a partition packs together
PIECES_PER_TASK = 8192
#: texts whose words are looked up together, and pieces that leave a task together
TEXTS_AT_ONCE, PIECES_AT_ONCE = 256, 1024
#: pieces between two looks for windows that nothing fits any more
TIDY_EVERY = 128

#: ids are little-endian unsigned 32-bit numbers; slot names the row
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, slot long, ids binary"
SEQUENCE_SCHEMA = "sequence_id long, ids binary, pieces array<struct<doc_id: long, piece: int, start: long, length: long, offset: long>>"
_PLACED = ["doc_id", "piece", "start", "length", "offset"]


@dataclass(frozen=True)
class Capacities:
    """What a window holds, and how much each residual weighs.

    By default documents and cost never bind before the tokens do, so that as few
    windows as possible are opened; the weights then only choose among them.
    """

    tokens: int = WINDOW
    documents: int = WINDOW
    cost: int = WINDOW * WINDOW
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"

    def needs(self, lengths: np.ndarray) -> np.ndarray:
        """(3, n): tokens, documents and attention cost of each piece."""
        return np.stack([lengths, np.ones_like(lengths), lengths * lengths])

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], "i8")


def vector_best_fit(lengths: np.ndarray, room: Capacities = Capacities()) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; sequences count from 0.

    Pieces come in decreasing length, equal ones as they stand.  A piece that no
    open window can take opens one; equal choices go to the oldest window.  A piece
    beyond the capacities of an empty window is an error.
    """
    lengths = np.asarray(lengths, "i8")
    sequence, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    limits, needs = room.limits(), room.needs(lengths)
    if (needs > limits[:, None]).any():
        raise ValueError("a piece is larger than a window")
    scale = np.sqrt(np.array(room.weights)) / limits
    order = np.argsort(-lengths, kind="stable")
    # what the pieces to come need at least
    least = np.minimum.accumulate(needs[:, order[::-1]], axis=1)[:, ::-1]
    names, left, opened, made = np.zeros(64, "i8"), np.zeros((3, 64), "i8"), 0, 0
    for turn, i in enumerate(order):
        if turn % TIDY_EVERY == 0 and opened:
            useful = np.flatnonzero((left[:, :opened] >= least[:, turn, None]).all(axis=0))
            names[: len(useful)], left[:, : len(useful)] = names[useful], left[:, useful]
            opened = len(useful)
        need = needs[:, i]
        after = left[:, :opened] - need[:, None]
        if room.rule == "norm":
            score = np.square(after * scale[:, None]).sum(axis=0)
        else:
            score = -((need * scale) @ (left[:, :opened] * scale[:, None]))
        score[(after < 0).any(axis=0)] = np.inf
        at = int(score.argmin()) if opened else 0
        if not opened or score[at] == np.inf:
            if opened == len(names):
                names, left = np.concatenate([names, names]), np.concatenate([left, left], axis=1)
            at, names[opened], left[:, opened] = opened, made, limits
            opened, made = opened + 1, made + 1
        sequence[i], offset[i] = names[at], limits[0] - left[0, at]
        left[:, at] -= need
    return sequence, offset


def cuts(total: int, window: int = WINDOW) -> list[int]:
    """Where the pieces of ``total`` ids start: full windows, before them what is left over."""
    return [0, *range(total % window or window, total, window)]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The pieces of every row: ``PIECE_SCHEMA``.

    ``doc_id`` and ``text`` are read; a null text is empty, and an empty one is
    the closing id alone.  Repeated rows are cut each by itself.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, slot = Encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            coded = [c + END_ID.to_bytes(4, "little") for c in encoder.ids([t or "" for t in batch["text"].to_pylist()])]
            sizes = [len(c) // 4 for c in coded]
            starts = [cuts(n) for n in sizes]
            count = list(map(len, starts))
            start = np.concatenate([np.zeros(0, "i8"), *starts]).astype("i8")
            length = np.diff(np.append(start, 0))
            last = np.cumsum(count) - 1
            length[last] = np.array(sizes) - start[last]
            ends = np.concatenate([[0], 4 * np.cumsum(length)]).astype("i4")
            columns = [
                batch["doc_id"].take(pa.array(np.repeat(np.arange(len(count)), count))),
                pa.array(np.concatenate([np.arange(n) for n in count]), pa.int32()),
                pa.array(start),
                pa.array(length),
                pa.array(np.arange(slot, slot + len(start))),
                pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(coded))]),
            ]
            slot += len(start)
            made = pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "slot", "ids"])
            yield from (made.slice(at, PIECES_AT_ONCE) for at in range(0, len(start), PIECES_AT_ONCE))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECE_SCHEMA)


def _packed(rows: pa.Table, first: int, room: Capacities) -> tuple[pa.Table, int]:
    """The sequences of some remainders, named by odd numbers from ``first`` on, and how many there are."""
    rows = rows.combine_chunks()
    sequence, offset = vector_best_fit(rows["length"].to_numpy(), room)
    rows = rows.append_column("offset", pa.array(offset)).take(pa.array(np.lexsort((offset, sequence))))
    count = np.bincount(sequence)
    ends = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
    placed = pa.StructArray.from_arrays([rows[n].combine_chunks() for n in _PLACED], _PLACED)
    ids, used = rows["ids"].to_pylist(), ends.to_pylist()
    columns = {
        "sequence_id": pa.array(2 * np.arange(first, first + len(count)) + 1),
        "ids": pa.array([b"".join(ids[a:z]) for a, z in zip(used[:-1], used[1:], strict=True)], pa.binary()),
        "pieces": pa.ListArray.from_arrays(ends, placed),
    }
    return pa.table(columns), len(count)


def _packer(most: int, room: Capacities):
    """Packs the remainders of a partition, ``most`` at a time."""

    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal first
            made, n = _packed(pa.Table.from_batches(held), first, room)
            first += n
            yield from made.to_batches(max_chunksize=PIECES_AT_ONCE)

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from packed()
                held, rows = [], 0
        if rows:
            yield from packed()

    return pack_all


def sequences(docs: DataFrame, room: Capacities = Capacities(), tokenizer: str = TOKENIZER) -> DataFrame:
    """The packed training sequences, one row each: ``SEQUENCE_SCHEMA``.

    ``ids`` are the sequence's tokens, at most ``WINDOW``; ``pieces`` says which
    document each run of them is from, without gaps from offset 0.  Only documents
    longer than a window are cut.  Full windows have even names and the packed
    remainders odd ones.  Repeated rows are packed each, rows with a null id under
    that null; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    cut = kept(pieces(docs, tokenizer), "pieces", compression="zstd")
    full = F.col("length") == WINDOW
    placed = F.array(F.struct(*_PLACED[:-1], F.lit(0).cast("long").alias("offset")))
    whole = cut.where(full).select((2 * F.col("slot")).alias("sequence_id"), "ids", placed.alias("pieces"))
    rest = cut.where(~full)
    n = max(1, -(-rest.count() // PIECES_PER_TASK))
    # a slot is one row, so the deal is even, and a task that runs again gets the same rows; their order is settled by sorting
    dealt = rest.repartition(n, "slot").sortWithinPartitions("slot")
    return whole.unionByName(dealt.mapInArrow(_packer(2 * PIECES_PER_TASK, room), SEQUENCE_SCHEMA))


def places(packed: DataFrame) -> DataFrame:
    """Every piece of ``sequences`` with its place, and the checksum of its ids where they are now."""
    rows = packed.select("sequence_id", "ids", F.inline("pieces"))
    own = F.substring(F.col("ids"), (4 * F.col("offset") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    return rows.select("doc_id", "piece", "start", "length", F.crc32(own).alias("ids_crc32"), "sequence_id", "offset")
