"""Harmonic packing of token ids into sequences of a fixed capacity.

A piece of length L belongs to class k = capacity // L, the reciprocal class
(capacity / (k + 1), capacity / k], and a bin of class k takes exactly k pieces.
Every worker fills the bins of its own partition; nothing is shuffled and no
worker waits for another.

Documents may be cut, so a document is cut where classes waste nothing: whole
capacities first, then the largest capacity // k that fits, until at most
capacity // 16 ids are left.  Those ids are one last piece of their own class, whose
bins waste less than one such piece.  The bins that are not full when a
partition ends are mixed, the longest pieces first, each into the first of
the open bins with room.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.tokens import byte_bpe, default_path
from tallymart.llm.util import table, text_slices

CAPACITY = 1024
END_ID = 0
#: Shorter rests than capacity // SHORTEST are not cut further.
SHORTEST = 16

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long,"
    " sequence_id long, offset long, padded_length long"
)


def cut_lengths(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document with ``total`` ids, in order."""
    pieces = [capacity] * (total // capacity)
    rest = total % capacity
    while rest > max(1, capacity // SHORTEST):
        piece = capacity // (capacity // (rest + 1) + 1)
        pieces.append(piece)
        rest -= piece
    return [*pieces, rest] if rest else pieces


def padded(length: int, capacity: int) -> int:
    """A sequence is padded to the capacity, except at a power of two."""
    return length if length & (length - 1) == 0 else capacity


class _Bins:
    """The open bins of one partition: one for each class, of fewer than k pieces."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.done: list[tuple] = []

    def add(self, piece: tuple) -> None:
        k = self.capacity // piece[2]
        self.open[k].append(piece)
        if len(self.open[k]) == k:
            self._close(self.open.pop(k))

    def _close(self, pieces: list[tuple]) -> None:
        total = padded(sum(p[2] for p in pieces), self.capacity)
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next_id, offset, total))
            offset += piece[2]
        self.next_id += 1

    def finish(self) -> None:
        """First fit of what is left; fewer than sum(k) pieces, whatever the input."""
        left = sorted((p for k in self.open for p in self.open[k]), key=lambda p: -p[2])
        self.open.clear()
        bins: list[list[tuple]] = []
        room: list[int] = []
        for piece in left:
            at = next((i for i, r in enumerate(room) if r >= piece[2]), len(bins))
            if at == len(bins):
                bins.append([])
                room.append(self.capacity)
            bins[at].append(piece)
            room[at] -= piece[2]
        for pieces in bins:
            self._close(pieces)

    def take(self) -> pa.RecordBatch | None:
        if not self.done:
            return None
        columns = list(zip(*self.done))
        self.done = []
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
        )


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their place in the sequences.

    Reads ``doc_id`` and ``text`` only.  A null or empty text has the one id
    ``end_id``; a null ``doc_id`` is kept as null; equal rows are packed one by
    one; a very long text is many whole sequences; an empty table gives no
    rows; other columns are ignored.  ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit numbers.  ``sequence_id`` starts with the
    partition number, so workers need not agree on it.
    """
    path = tokenizer or default_path()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        bins = _Bins(capacity, TaskContext.get().partitionId() << 40)
        for batch in text_slices(batches):
            ids_text = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for doc_id, text in ids_text:
                ids = bpe.ids(text) + end
                total, start = len(ids) // 4, 0
                for n in cut_lengths(total, capacity):
                    bins.add((doc_id, start, n, ids[4 * start : 4 * (start + n)], total))
                    start += n
            if (out := bins.take()) is not None:
                yield out
        bins.finish()
        if (out := bins.take()) is not None:
            yield out

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(pack, SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """One row per piece with the checksum of its ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "padded_length",
    )


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(table(spark, sf_dir, "documents")))
