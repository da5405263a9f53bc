"""Helpers shared by the operators: blocks of documents, postings cut by bucket, per-worker memory."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that later tasks find what earlier ones built.

    Task functions are sent by value and bring new globals with each stage; only
    ``sys.modules`` outlives them. Nothing may depend on what is found here.
    """
    module = sys.modules.setdefault("_rillstone_worker", types.ModuleType("_rillstone_worker"))
    return module.__dict__.setdefault(name, {})


def trim() -> None:
    """Give memory that is free in this Python worker back, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_size(df: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]


def parts_for(df: DataFrame, size: int, each: int) -> int:
    """How many parts of about ``each`` bytes hold ``size`` bytes; a few per core at least."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // each))


def block_of(key: Column, blocks: int) -> Column:
    """The block that a row belongs to; the same for every row with this key."""
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def flat(column: pa.ChunkedArray) -> pa.Array:
    got = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.concat_arrays(got.chunks) if isinstance(got, pa.ChunkedArray) else got


def utf8(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes end to end, and the offsets at which they begin; null is the empty text."""
    texts = flat(pc.fill_null(column.cast(pa.large_binary()), b""))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.zeros(0, np.uint8)
    if not len(texts):
        return data, np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Binary cells as one array of ``kind``, and how many items each cell held."""
    data, offsets = utf8(column)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def thin(values: np.ndarray, rising: bool = True) -> bytes:
    """Integers as planes of their bytes: what is always zero compresses away. Rising ones as their differences."""
    values = values.astype(np.int64)
    steps = np.diff(values, prepend=np.int64(0)) if rising else values
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def wide(column: pa.ChunkedArray, rising: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """What ``thin`` packed into each cell, end to end, and how many items each cell held."""
    data, offsets = utf8(column)
    cells = [np.ascontiguousarray(data[a:b].reshape(8, -1).T).view(np.int64).ravel()
             for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b > a]
    cells = [c.cumsum() for c in cells] if rising else cells
    return np.concatenate(cells) if cells else np.zeros(0, np.int64), np.diff(offsets) // 8


def cut_by(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns' items for each bucket, in the order in which they stand."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    ranked = bucket[order]
    edges = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sorted_columns = [c[order] for c in columns]
    for a, b in zip(edges, np.r_[edges[1:], len(ranked)], strict=True):
        yield int(ranked[a]), [c[a:b] for c in sorted_columns]


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with every bit spread over the word (a 64-bit finaliser)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * _SPREAD
    return h ^ (h >> np.uint64(32))


class RollingHash:
    """64-bit hashes of any stretch of a byte array: sums of random byte values times powers of an odd base.

    A stretch's sum is the difference of two prefix sums; multiplying it by the
    inverse power of its start makes it the same wherever the stretch stands.
    """

    BASE = np.uint64(0xD6E8FEB86659FD93)
    BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))

    def __init__(self, data: np.ndarray, seed: int = 7):
        n = len(data)
        values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        powers = np.full(n + 1, self.BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * powers[:n], out=self.sums[1:])
        del powers
        self.back = np.full(n + 1, self.BACK, np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))
