"""Shared pieces of the training-data operators: lineage cuts, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import xxhash

from tabkit.session import drop_path, scratch_path, ship_package

__all__ = ["ship_package"]

#: Bytes of text handled by one run of the vectorised code (a longer document is a run of its own).
SLICE_BYTES = 1 << 20
#: Sorts after every real id: stands for a NULL doc_id where ids are compared.
NULL_ID = (1 << 63) - 1

MUL1, MUL2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage that
    survives lost executors and is computed once.

    The shuffles behind it are not needed any more. Spark removes their files when the
    driver collects its garbage, which is asked for here: else they pile up until the end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    for df in tables:
        drop_path(df.sparkSession, df.written_path)


#: What the tasks of a module remember in a Python worker from one to the next.
REMEMBERED: list[dict] = []


def give_back() -> None:
    """Drop what this Python worker remembers and return the memory that it has freed to the system. Workers
    live on between the stages of a job, and what an earlier one held would count beside what the next one needs."""
    for held in REMEMBERED:
        held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_key(col="text"):
    """64-bit key of a whole text (NULL counts as empty)."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * MUL1
    x ^= x >> np.uint64(33)
    x *= MUL2
    x ^= x >> np.uint64(33)
    return x


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            steps = np.full(n, BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps = np.full(n, BASE_INV, np.uint64)
            steps[0] = 1
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up, self.down


POWERS = _Powers()
#: A random 64-bit value for each byte; the bytes with A-Z as a-z.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word that are hashed in steps.
LONG_WORD = 256
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def window_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (uint64)."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = POWERS.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: n - k + 1])


def word_hash(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at ``start``: eight bytes after eight bytes are mixed in, each step a
    bijection of the eight bytes, so words of up to eight bytes never collide with their like. Words over
    LONG_WORD bytes, which are few, are hashed by xxHash64."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    out = mix(size.astype(np.uint64) + np.uint64(BASE))
    left, at, open_ = size.copy(), start.copy(), np.flatnonzero((size > 0) & (size <= LONG_WORD))
    while len(open_):
        rest = left[open_]
        chunk = eight[at[open_]]
        short = rest < 8
        chunk[short] &= (np.uint64(1) << (np.uint64(8) * rest[short].astype(np.uint64))) - np.uint64(1)
        out[open_] = mix((out[open_] ^ chunk) * np.uint64(BASE))
        left[open_] -= 8
        at[open_] += 8
        open_ = open_[rest > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(padded[start[i]: start[i] + size[i]].tobytes())
    return out


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts in one buffer.

    ``start`` / ``end``: byte positions; ``hash``: 64-bit word hashes; ``first``: the
    first word of each text (one more entry than texts).
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool):
        n = len(data)
        word = ~IS_SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        before = np.zeros(n + 1, bool)
        before[1:] = word
        now = np.zeros(n + 1, bool)
        now[:n] = word
        self.start = np.flatnonzero(now & (~before | cut))
        self.end = np.flatnonzero(before & (~now | cut))
        self.hash = word_hash(_LOWER[data] if lower else data, self.start, self.end - self.start)
        self.first = np.searchsorted(self.start, bounds)


def slices(column: pa.Array):
    """Cut a string column into runs of about SLICE_BYTES: yields (first row, last row,
    bytes as uint8, text boundaries within them). NULL counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j
