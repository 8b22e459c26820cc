"""Vectorised hashes over a batch of texts laid out as one byte array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# The mixing constants of splitmix64 and an odd base.
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    def run(x: int) -> np.ndarray:
        out = np.full(n + 1, x, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * M2)


class Prefix:
    """Polynomial prefix hash of a byte array: ``of(s, e)`` hashes the bytes [s, e)."""

    _powers: tuple[np.ndarray, np.ndarray] = powers(1 << 12)

    def __init__(self, data: np.ndarray):
        if len(Prefix._powers[0]) <= len(data):
            Prefix._powers = powers(max(len(data), 1 << 20))
        up, self.down = Prefix._powers
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of the texts); NULL is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices_by_size(offsets: np.ndarray, most: int):
    """Consecutive ranges of texts of about ``most`` bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi
