"""Texts in chunks of bounded size, for operators that ask a table of the corpus about every position.

A chunk is some megabytes of text. It asks for each of its different keys once, and the answers go back to
the chunk alone. Neither the corpus table nor the questions pass through the driver or are sent to every
executor, and no key is hot: a key is asked once a chunk, however often it stands there. Questions may be
dealt to shards by a remainder of the key, so that a shuffle moves compressed runs of keys in place of a row
per key; the number of shards grows with the corpus. Within a chunk questions and answers have one order, by
shard, then by key, so answers need not repeat the keys.

Chunks are a written table, so their numbers hold when a task runs again. A row is a part of a chunk with
the documents of one tag: their ids, the ends of their texts, and the texts, compressed. Null text is
empty; a single longer text makes a larger chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import common as c

CHUNK_BYTES = 32 << 20
PART_BYTES = 1 << 20
SHARD_BYTES = 16 << 20
SCHEMA = "chunk long, tag string, doc_ids array<long>, ends array<int>, body binary"
_CODEC = pa.Codec("zstd", 1)

#: Turns the bytes and offsets of some texts into those the operator works on.
Change = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def packed(body: np.ndarray | bytes) -> bytes:
    """Compressed bytes, their length before them."""
    data = bytes(body)
    return len(data).to_bytes(8, "little") + _CODEC.compress(data, asbytes=True)


def unpacked(body: bytes) -> np.ndarray:
    size = int.from_bytes(body[:8], "little")
    if not size:
        return np.zeros(0, np.uint8)
    return np.frombuffer(_CODEC.decompress(body[8:], size, asbytes=True), np.uint8)


def _chunked(batches: Iterator[pa.RecordBatch], change: Change, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    chunk = (task.partitionId() if task else 0) << 31
    filled = 0
    for batch in batches:
        raw, offsets = c.buffers(batch.column("text"))
        tags = np.array(batch.column("tag").to_pylist(), object)
        doc_ids = batch.column("doc_id")
        for i, j, part, at in c.slices(raw, offsets, min(PART_BYTES, chunk_bytes)):
            if filled and filled + len(part) > chunk_bytes:
                chunk, filled = chunk + 1, 0
            filled += len(part)
            rows = []
            for tag in sorted(set(tags[i:j])):
                mine = np.flatnonzero(tags[i:j] == tag)
                if len(mine) == j - i:
                    own, ends = part, at
                else:
                    own = np.concatenate([part[at[k] : at[k + 1]] for k in mine])
                    ends = np.append(0, np.cumsum(at[mine + 1] - at[mine]))
                own, ends = change(own, ends)
                rows.append((tag, doc_ids.take(pa.array(mine + i)), ends[1:], packed(own)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * len(rows), pa.int64()),
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1].to_pylist() for r in rows], pa.list_(pa.int64())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["chunk", "tag", "doc_ids", "ends", "body"],
            )


def chunked(docs: DataFrame, change: Change, name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Written chunks of ``docs`` (doc_id, text, tag), the texts changed."""

    @c.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chunked(batches, change, chunk_bytes)

    return c.kept_table(c.prepared(docs).select("doc_id", "text", "tag").mapInArrow(work, SCHEMA), name)


def parts(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, str, list, np.ndarray, np.ndarray]]:
    """(chunk, tag, doc_ids, bytes, offsets) of every row."""
    for chunk, tag, doc_ids, ends, body in zip(
        *[table.column(n).to_pylist() for n in ("chunk", "tag", "doc_ids", "ends", "body")], strict=True
    ):
        yield chunk, tag, doc_ids, unpacked(body), np.append(0, np.array(ends, np.int64))


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[str, list, np.ndarray, np.ndarray]]]]:
    """(chunk, parts) of a task's rows, a run of rows of one chunk at a time."""
    held: list = []
    now = None
    for batch in batches:
        for chunk, *part in parts(batch):
            if held and chunk != now:
                yield now, held
                held = []
            now = chunk
            held.append(tuple(part))
    if held:
        yield now, held


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each stands there."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.diff(np.append(heads, len(keys)))


def summed(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of several (keys, counts) in order, with the sums of their counts."""
    keys = np.concatenate([s[0] for s in sums]) if sums else np.zeros(0, np.uint64)
    counts = np.concatenate([s[1] for s in sums]) if sums else np.zeros(0, np.int64)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(counts[order], heads)


def shard_count(texts: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """A prime number of shards for written chunks, about one to ``shard_bytes`` of text."""
    total = texts.agg(F.sum(F.element_at("ends", -1).cast("long"))).first()[0] or 0
    n = max(2, -(-total // shard_bytes))
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of different keys by shard, then by key, and where each shard starts in it."""
    shard = keys.view(np.int64) % shards
    order = np.lexsort((keys, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


class Answers:
    """Values of sorted 64-bit keys; a directory of leading bits of the mixed key keeps a search short."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        mixed = c.mix(keys.view(np.uint64))
        order = np.argsort(mixed)
        self.keys = np.append(mixed[order], np.uint64(2**64 - 1))
        self.values = np.append(values[order], values.dtype.type(0))
        self.n = len(keys)
        bits = max(8, self.n.bit_length())
        self.shift = np.uint64(64 - bits)
        heads = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.directory = np.searchsorted(self.keys, heads).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where a key is unknown, and whether it is known."""
        asked = c.mix(keys.view(np.uint64))
        at = self.directory[asked >> self.shift]
        later = np.flatnonzero(self.keys[at] < asked)
        while len(later):
            at[later] += 1
            later = later[self.keys[at[later]] < asked[later]]
        known = (self.keys[at] == asked) & (at < self.n)
        return np.where(known, self.values[at], self.values.dtype.type(0)), known
