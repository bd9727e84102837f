"""What the operators share: safe column choice, written intermediates and vectorised word hashing.

A word is a run of bytes other than the six ASCII blanks ``[\\x20\\x09-\\x0D]``. Text arrives in
Python as Arrow buffers and is handled in slices of a megabyte, so that memory does not depend
on the number of rows of a batch; only a single longer document makes a longer slice.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.session import scratch_path

BLANKS = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
# rows and bytes that Spark hands to a Python worker at a time
BATCH_ROWS, BATCH_BYTES = "2000", "8m"

_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(df: DataFrame) -> DataFrame:
    """Session settings for work in Python.

    Arrow batches stay small: two Python workers share an executor's memory with the JVM, and what a
    worker has touched it keeps. Workers get this package's folder on their path, wherever the driver
    was started; on a cluster the package must be there or be sent with ``--py-files``.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *paths])
    return df


def give_back() -> None:
    """Return what a task has left unused to the system: Spark reuses a worker for the tasks of later stages."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


_memories: dict[str, Callable[[], None]] = {}


def remembers(name: str, forget: Callable[[], None]) -> None:
    """Name a memory that an operator's workers keep from task to task; tasks of ``returning`` operators ``forget`` it."""
    _memories[name] = forget


def returning(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``work`` on the batches of a task, which gives its memory back at its end and holds no named memory
    of another operator."""

    @functools.wraps(work)
    def run(*batches):
        for forget in _memories.values():
            forget()
        try:
            yield from work(*batches)
        finally:
            give_back()

    return run


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names; other columns may differ from them in case only."""
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[f"`{n}`" for n in names])
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def unused(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_tag(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart: hash and length."""
    return F.xxhash64(text, F.length(text))


def drop_rows(docs: DataFrame, dropped: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``docs`` whose keys are not in ``dropped``. Spark broadcasts ``dropped`` only if its
    written size is below the session's limit, else both sides are shuffled."""
    return docs.join(dropped, list(keys), "left_anti")


def without_ids(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``dropped`` (doc_id); all columns stay as they are."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index('doc_id')}"
    gone = dropped.select(F.col("doc_id").alias("gone_id"))
    return plain.join(gone, F.col(at) == F.col("gone_id"), "left_anti").toDF(*names)


# ---- text in Arrow buffers ----


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1] or b"\0" * 8, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0:
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    raw: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive documents, about ``limit`` bytes at a time."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


# ---- hashes ----


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` well mixed 64-bit numbers, always the same for a seed."""
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed & _M64)) * np.uint64(
        0x9E3779B97F4A7C15
    )
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x5851F42D4C957F2D
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


_LETTERS = splitmix(256, 7)


def span_hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = _LETTERS
) -> np.ndarray:
    """64-bit hash of each span of bytes; equal spans have equal hashes wherever they stand."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(letters[raw] * powers(len(raw)), out=total[1:])
    inverse = powers(len(raw) + 1, pow(_BASE, -1, 1 << 64))
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_spans(
    raw: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of every document."""
    n = len(offsets) - 1
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(n, np.int64)
    blank = _BLANK[raw]
    cut = np.empty(len(raw) + 1, bool)  # a word cannot go on from i-1 to i
    cut[0] = cut[-1] = True
    cut[1:-1] = blank[:-1]
    cut[offsets] = True
    starts = np.flatnonzero(~blank & cut[:-1])
    cut[:-1] |= blank
    cut[offsets] = True
    ends = np.flatnonzero(~blank & cut[1:]) + 1
    at = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(at)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbouring word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(splitmix(size, 11) | np.uint64(1)):
        total += words[i : i + n] * factor
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
