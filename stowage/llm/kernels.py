"""Vector helpers over Arrow string columns: words, hashes and shingles of many texts at once.

All of them work on the UTF-8 bytes of a block of whole documents. Hashes are 64
bits wide and depend on the content alone, so that they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19  # documents handled together; a longer document makes a block of its own

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def texts(column) -> pa.Array:
    """The column as one plain string array; null texts are empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.cast(pa.large_string()).fill_null("")


def blocks(array: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents of about ``limit`` bytes: first, last (exclusive), bytes, offsets of each document."""
    if not len(array):
        return
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that cross no document: starts, ends, and the words before each document."""
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(inside)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any byte ranges of a block, from one pass of prefix sums."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(16, int(len(data)).bit_length())
        self._up, self._down = _powers(size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        # bytes + 1, so that zero bytes count
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A mixed hash of the bytes from each start to its end."""
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def every(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes at each place that has as many."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[width:] - self._sums[:n]) * self._down[:n])


def _join(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        h = h * np.uint64(_BASE) + part
    return mix(h)


def shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each document (words ``bounds[i]`` to ``bounds[i + 1]``) its sorted distinct n-word shingles.

    Fewer words than ``n`` make one shingle of the whole sequence; no words, none.
    """
    whole = _join([words[j : len(words) - n + 1 + j] for j in range(n)]) if len(words) >= n else None
    none = np.zeros(0, np.uint64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            yield np.unique(whole[a : b - n + 1])
        elif b > a:
            yield _join([words[j : j + 1] for j in range(a, b)])
        else:
            yield none
