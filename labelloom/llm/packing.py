"""Harmonic packing of token sequences.

Bins of a class hold a fixed number of pieces: class k takes pieces of at most capacity / k
tokens and closes a bin after k of them. Texts may be cut, so each document is cut to pieces
of exactly capacity / k for k = 1, 2, 4, ... (a power-of-two capacity): a full bin has no
padding at all. A bin that stays open at the end of a task is cut into sequences of a power
of two of pieces, which need no padding either.

A worker fills the bins of its own task, so there is no shuffle and no shared state; only
the few open bins of a task depend on how the table is split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.llm.bpe import SharedTokenizer
from labelloom.llm.columns import quoted
from labelloom.llm.library_ids import library_encoder

PIECE = [
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("piece_ids", T.BinaryType()),
    ("ids_crc32", T.LongType()),
    ("doc_tokens", T.LongType()),
    ("sequence_id", T.LongType()),
    ("offset", T.LongType()),
]

ARROW = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]

# Documents encoded together.
TOGETHER = 500

# Bits of a sequence id for the task's own count; the bits above hold the task's number.
OWN_BITS = 40


class Bins:
    """The open bin of every class of one task."""

    def __init__(self, capacity: int, task: int) -> None:
        self.capacity = capacity
        self.next_id = task << OWN_BITS
        # size of the class's pieces -> pieces that wait for their bin
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        number = self.next_id
        self.next_id += 1
        return [(*piece, number, i * piece[2]) for i, piece in enumerate(pieces)]

    def add(self, piece: tuple) -> list[tuple]:
        """Puts a piece (its size third) in its class; the full bin's pieces, if it is full."""
        waiting = self.open.setdefault(piece[2], [])
        waiting.append(piece)
        if len(waiting) * piece[2] < self.capacity:
            return []
        del self.open[piece[2]]
        return self._close(waiting)

    def rest(self) -> Iterator[list[tuple]]:
        """The open bins, each as sequences of a power of two of pieces."""
        for waiting in self.open.values():
            at = 0
            for bit in reversed(range(len(waiting).bit_length())):
                if len(waiting) >> bit & 1:
                    yield self._close(waiting[at : at + (1 << bit)])
                    at += 1 << bit


def cuts(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and size of a document's pieces: whole bins, then ever smaller classes."""
    start = 0
    while total - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity
    while start < total:
        size //= 2
        if total - start >= size:
            yield start, size
            start += size


def pack(
    df: DataFrame,
    path: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: the carried columns of its document, and where the piece lies.

    start and length: the piece within the document's ids; piece_ids: the ids, packed as
    little-endian unsigned 32-bit integers; ids_crc32: their CRC-32; doc_tokens: the
    document's ids with the end id; sequence_id and offset: its place, gapless from 0 in
    every sequence. Pieces of one sequence have one size, so the length of a sequence is a
    power of two, capacity at most.

    A null or empty text is the end id alone; other nulls are carried along. Long documents
    are cut into many pieces. Repeated rows are packed each. An empty table gives no rows.
    Columns that are not carried are left out, so extra ones cannot clash; a carried column
    must not be named like a result. capacity must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    names = [n for n, _ in PIECE]
    if {c.lower() for c in carry} & set(names):
        raise ValueError(f"carried columns must not be named like {names}")
    shared = SharedTokenizer(df.sparkSession, path)
    source = df.select(*[df[quoted(c)] for c in carry], df[quoted(text)].alias("__llm_text"))
    schema = T.StructType(
        [source.schema[i] for i in range(len(carry))] + [T.StructField(n, t) for n, t in PIECE]
    )
    closing = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, types = Bins(capacity, TaskContext.get().partitionId()), None

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True))
            arrays = [
                pa.array(values, kind)
                for values, kind in zip([*zip(*columns[0], strict=True)] if carry else [], types, strict=True)
            ]
            for values, kind in zip(columns[1:], ARROW, strict=True):
                arrays.append(pa.array(values, kind))
            return pa.RecordBatch.from_arrays(arrays, [*carry, *names])

        for batch in batches:
            types = [batch.schema.field(i).type for i in range(len(carry))]
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(carry))], strict=True))
            for at in range(0, batch.num_rows, TOGETHER):
                texts = batch.column(len(carry)).slice(at, TOGETHER).to_pylist()
                ready: list[tuple] = []
                for i, ids in enumerate(library_encoder(shared).encode_batch(texts), at):
                    ids += closing
                    key = keys[i] if carry else ()
                    for start, size in cuts(len(ids) // 4, capacity):
                        piece = ids[4 * start : 4 * (start + size)]
                        ready += bins.add((key, start, size, piece, crc32(piece), len(ids) // 4))
                if ready:
                    yield rows(ready)
        left = [piece for pieces in bins.rest() for piece in pieces]
        if left:
            yield rows(left)

    return source.mapInArrow(run, schema)
