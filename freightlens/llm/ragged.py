"""Batches of strings as flat numpy arrays: slices of bounded size, hashes of spans.

A batch of texts becomes one array of code points (or bytes) plus row borders, so that
a per-character step is a handful of array operations for the whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Code points handled at a time; one longer text goes alone.
SLICE = 1 << 18
#: Stands between two texts; no code point has this value.
BORDER = 0x110000

_MULTIPLIER = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def slices(lengths: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Borders [a, b) of runs of rows of about ``most`` units in all, one row at least."""
    at, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(lengths):
        yield at, len(lengths)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by ``BORDER``, and where each text starts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1)
    flat = np.empty(int(ends[-1]) if len(texts) else 0, np.uint32)
    keep = np.ones(len(flat), bool)
    keep[ends - 1] = False
    flat[keep] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    flat[ends - 1] = BORDER
    return flat, ends - lengths - 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and n + 1 borders."""
    column = column.cast(pa.large_binary())
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if column.null_count:
        sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(borders))
        if int(sizes.sum()) == int(borders[-1] - borders[0]):
            return flat, borders
        flat = flat[np.repeat(borders[:-1], sizes) + within(sizes)]
        borders = np.concatenate([[0], np.cumsum(sizes)])
    return flat, borders


def within(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each size n, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd 64-bit base and of its inverse, kept between calls."""
    have = _powers.get(seed)
    if have is None or len(have[0]) <= n:
        base = int(mix(np.array([seed + 1], np.uint64))[0]) * _MULTIPLIER % (1 << 64) | 5
        room = max(n + 1, SLICE * 2)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(room, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = _powers[seed] = tuple(both)
    return have


class Hashes:
    """64-bit hashes of any spans of one array of symbols, in constant time a span."""

    def __init__(self, symbols: np.ndarray, seed: int = 0):
        up, self._down = powers(len(symbols), seed)
        kinds = np.arange(256, dtype=np.uint64) if symbols.dtype == np.uint8 else symbols.astype(np.uint64)
        terms = mix(kinds + np.uint64((seed + 1) * _MULTIPLIER % (1 << 64)))
        if symbols.dtype == np.uint8:  # each byte's term is one of 256
            terms = terms[symbols]
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(terms * up[:len(symbols)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_MULTIPLIER))

    def every(self, size: int) -> np.ndarray:
        """Of all spans of one size, by start."""
        n = len(self._sums) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        value = (self._sums[size:] - self._sums[:n]) * self._down[:n]
        return mix(value + np.uint64(size * _MULTIPLIER % (1 << 64)))
