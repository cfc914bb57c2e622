"""Numpy views of the strings of an Arrow batch, hashed without a Python loop over characters."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# An odd multiplier of the prefix hashes, its inverse modulo 2**64, mixing constants.
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
CHUNK_BYTES = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int, lower: bool = False) -> np.ndarray:
    """A random 64-bit word per byte; with ``lower`` A-Z get the words of a-z."""
    codes = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


class Powers:
    """Powers of the multiplier and of its inverse, grown as longer buffers are met."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            self.up, self.down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)


#: One table for all operators of a process.
POWERS = Powers()


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` for ``mapInArrow``; at its end the process, which goes on to other tasks, gives its free memory back."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library keeps what is free
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


class PrefixHash:
    """Hash of any range of a buffer from two prefix sums: sum(code * base**place) modulo 2**64."""

    def __init__(self, data: np.ndarray, codes: np.ndarray, powers: Powers) -> None:
        powers.upto(len(data))
        self.powers = powers
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * powers.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.powers.down[start]

    def width(self, k: int) -> np.ndarray:
        """Hash of every range of ``k`` bytes."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[k:] - self.sums[:n]) * self.powers.down[:n]


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its rows in them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each byte."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A column of 64-bit integer lists from their concatenation."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False)))
