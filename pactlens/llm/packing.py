"""Packing of token sequences: bounded-space online best fit, and best-fit decreasing in blocks.

Every task packs its own documents as they stream by; nothing is shuffled, and memory is one batch
of documents plus the open bins. Sequence numbers hold the partition's number, so they are unique
and a task that is run again gives the same ones. A document is its ids and the id 0; only documents
longer than a sequence are cut. Null text is empty, a null doc_id is passed on, repeated rows are
packed each by itself, and other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pactlens.llm import common as c
from pactlens.llm.tokens import default_tokenizer, token_batches

CAPACITY = 2048
OPEN_BINS = 1024
BLOCK_TOKENS = 4_000_000


class OnlineBestFit:
    """At most ``open_bins`` bins, found by a bitset of their free spaces.

    An item goes to the bin it fills best. If it fits none and all bins are taken, the fullest bin
    closes for a new one.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.spaces = 0  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item of 1 to ``capacity``."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            number, free = self.made, self.capacity
            self.made += 1
        rest = free - length
        if rest:
            if not self.bins[rest]:
                self.spaces |= 1 << rest
            self.bins[rest].append(number)
            self.open += 1
        return number, self.capacity - free


def _pieces(doc_ids: list, ids: list[bytes], capacity: int) -> Iterator[tuple]:
    width = 4 * capacity
    for doc_id, data in zip(doc_ids, ids, strict=True):
        for piece, at in enumerate(range(0, len(data), width)):
            yield doc_id, piece, at // 4, data[at : at + width]


def _task_base() -> int:
    task = TaskContext.get()
    return (task.partitionId() if task else 0) << 33


def packed_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids
    as little-endian unsigned 32-bit numbers if asked for.

    The documents of one batch, a few megabytes of text, are placed longest first; apart from that
    an item's place depends on earlier items only.
    """
    path = tokenizer or default_tokenizer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OnlineBestFit(capacity, open_bins), _task_base()
        for doc_ids, ids in token_batches(batches, path):
            pieces = list(_pieces(doc_ids, ids, capacity))
            places: list[tuple[int, int]] = [(0, 0)] * len(pieces)
            for i in sorted(range(len(pieces)), key=lambda i: -len(pieces[i][3])):
                places[i] = bins.place(len(pieces[i][3]) // 4)
            if not pieces:
                continue
            id_, number, start, data = zip(*pieces, strict=True)
            columns = [
                pa.array(id_, pa.int64()),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array([len(d) // 4 for d in data], pa.int64()),
                pa.array([zlib.crc32(d) for d in data], pa.int64()),
                pa.array([base + p[0] for p in places], pa.int64()),
                pa.array([p[1] for p in places], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(data, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return c.prepared(c.pick(docs, "doc_id", "text")).mapInArrow(pack, schema + (", ids binary" if with_ids else ""))


class CapacityTree:
    """Segment tree over free spaces 0..capacity; an inner node counts the bins below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, free: int, by: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, free: int, number: int) -> None:
        self.bins[free].append(number)
        self._change(free, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(free, bin) of the smallest free space of ``least`` or more."""
        node = self.leaves + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._change(free, -1)
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of every bin, longest items placed first."""
    tree, bins = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            free, number = capacity, len(bins)
            bins.append([])
        else:
            free, number = found
        bins[number].append(i)
        if free > lengths[i]:
            tree.put(free - lengths[i], number)
    return bins


def packed_sequences(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per packed sequence, ready to be written as id matrices.

    ``ids`` (filled up with 0 to the capacity) and ``positions`` (from 0 anew in every segment) are
    binary rows of little-endian unsigned 32-bit numbers, ``cu_seqlens`` are the cumulative segment
    lengths from 0, ``segments`` tell the document, piece and start of each segment. Best-fit
    decreasing runs over blocks of about ``block_tokens`` tokens of a task.
    """
    path = tokenizer or default_tokenizer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = _task_base(), 0
        block: list[tuple] = []
        size = 0
        counting = np.arange(capacity, dtype=np.uint32)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            bins = best_fit_decreasing([len(p[3]) // 4 for p in block], capacity)
            for first in range(0, len(bins), 256):
                rows = []
                for items in bins[first : first + 256]:
                    parts = [block[i] for i in items]
                    sizes = [len(p[3]) // 4 for p in parts]
                    total = sum(sizes)
                    rows.append(
                        {
                            "sequence_id": base + made,
                            "n_tokens": total,
                            "ids": b"".join(p[3] for p in parts).ljust(4 * capacity, b"\0"),
                            "positions": np.concatenate([counting[:n] for n in sizes])
                            .tobytes()
                            .ljust(4 * capacity, b"\0"),
                            "cu_seqlens": np.cumsum([0, *sizes]).tolist(),
                            "segments": [{"doc_id": p[0], "piece": p[1], "start": p[2]} for p in parts],
                        }
                    )
                    made += 1
                yield pa.RecordBatch.from_pylist(rows, schema=_SEQUENCE)

        for doc_ids, ids in token_batches(batches, path):
            for piece in _pieces(doc_ids, ids, capacity):
                block.append(piece)
                size += len(piece[3]) // 4
                if size >= block_tokens:
                    yield from flush()
                    block, size = [], 0
        if block:
            yield from flush()

    return c.prepared(c.pick(docs, "doc_id", "text")).mapInArrow(
        pack,
        "sequence_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>,"
        " segments array<struct<doc_id: long, piece: int, start: long>>",
    )


_SEQUENCE = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("segments", pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64())]))),
    ]
)


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """Write the packed sequences as Parquet: fixed-width id and position rows with their offsets."""
    packed_sequences(docs, **options).write.parquet(path)
