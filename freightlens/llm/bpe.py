"""Byte-pair merging of many pre-tokens at once, and a bounded memory of results."""

from __future__ import annotations

import json

import numpy as np

from freightlens.llm.ragged import within

NEVER = np.int32(2**31 - 1)
#: Distinct pre-tokens a worker remembers before it starts anew; speed only, never results.
REMEMBERED = 1_500_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, by the byte-level rule: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return [chr(b) if b in set(printable) else chr(256 + others.index(b)) for b in range(256)]


class Merges:
    """Ranks and products of symbol pairs, found by hashing in numpy arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.product = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.of_byte = np.array([vocabulary[s] for s in byte_symbols()], np.int32)
        keys = left << 32 | right
        bits = max(4, int(len(keys) * 8).bit_length())
        self._shift = np.uint64(64 - bits)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._ranks = np.full(1 << bits, NEVER, np.int32)
        todo = np.arange(len(keys))
        slots = self._slots(keys)
        while len(todo):
            free = self._keys[slots[todo]] == -1
            put = todo[free]
            self._keys[slots[put]] = keys[put]
            self._ranks[slots[put]] = put
            todo = todo[self._keys[slots[todo]] != keys[todo]]
            slots[todo] = (slots[todo] + 1) & (len(self._keys) - 1)

    @classmethod
    def from_json(cls, text: str) -> "Merges":
        model = json.loads(text)["model"]
        return cls(model["vocab"], model["merges"])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        out = np.full(len(keys), NEVER, np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            found = self._keys[slots[todo]]
            same = found == keys[todo]
            out[todo[same]] = self._ranks[slots[todo[same]]]
            todo = todo[~same & (found != -1)]
            slots[todo] = (slots[todo] + 1) & (len(self._keys) - 1)
        return out

    def counts(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Symbols left of each byte sequence when no pair of it can be merged."""
        left = np.zeros(len(sizes), np.int64)
        symbol = self.of_byte[data]
        row = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbol), NEVER, np.int32)
        if len(symbol) > 1:
            inner = np.flatnonzero(row[1:] == row[:-1])
            rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            lengths = np.diff(np.append(heads, len(row)))
            lowest = np.minimum.reduceat(rank, heads)
            done = lowest == NEVER
            left[row[heads[done]]] = lengths[done]
            if done.any():
                stay = np.repeat(~done, lengths)
                symbol, row, rank = symbol[stay], row[stay], rank[stay]
                lowest, lengths = lowest[~done], lengths[~done]
                if not len(symbol):
                    break
            hit = rank == np.repeat(lowest, lengths)
            twin = np.flatnonzero(hit[1:] & hit[:-1])
            if len(twin):  # a pair of equal symbols overlaps itself: every other one, from the left
                at = np.flatnonzero(hit)
                fresh = np.flatnonzero(np.append(True, (np.diff(at) > 1)))
                odd = within(np.diff(np.append(fresh, len(at)))) % 2 == 1
                hit[at[odd]] = False
            symbol[hit] = self.product[rank[hit]]
            gone = np.zeros(len(hit), bool)
            gone[1:] = hit[:-1]
            stay = ~gone
            changed = hit[stay]
            symbol, row, rank = symbol[stay], row[stay], rank[stay]
            stale = changed.copy()
            stale[:-1] |= changed[1:]
            stale = np.flatnonzero(stale)
            rank[stale] = NEVER
            stale = stale[stale < len(row) - 1]
            stale = stale[row[stale] == row[stale + 1]]
            rank[stale] = self.ranks(symbol[stale], symbol[stale + 1])
        return left


class Memory:
    """Values of hashed spans, kept in sorted arrays between batches of one worker."""

    def __init__(self, most: int = REMEMBERED):
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.keys, self.values = np.empty(0, np.uint64), np.empty(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of keys (any order), and which of them are known."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[at], self.keys[at] == keys

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, sorted and unknown so far."""
        if len(self.keys) + len(keys) > self.most:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        self.keys, self.values = np.insert(self.keys, at, keys), np.insert(self.values, at, values)
