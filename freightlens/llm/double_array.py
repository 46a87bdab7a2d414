"""A double-array trie over byte strings: built once, walked for many starts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class DoubleArray:
    """From state s, byte c leads to base[s] + c if check there is s."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: list[bytes], values: list[int]) -> "DoubleArray":
        nodes: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in zip(keys, values):
            at = 0
            for byte in key:
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][byte]
            ends[at] = value
        room = 2 * len(nodes) + 1024
        base, check, value = [0] * room, [-1] * room, [-1] * room
        free = bytearray(b"\1") * room
        free[0] = 0
        state, order, tries, low = [0] * len(nodes), [0], 0, 1
        for node in order:  # level by level, so that a node's own slot is known before its children's
            at, children = state[node], sorted(nodes[node])
            value[at] = ends[node]
            if not children:
                continue
            gaps = [c - children[0] for c in children[1:]]
            low = spot = free.find(1, low)
            tries = 0
            while spot >= 0 and (spot < children[0] or not all(free[spot + g] for g in gaps)):
                spot, tries = free.find(1, spot + 1, len(free) - 256), tries + 1
            if spot < 0:
                spot = max(room, children[0])
                more = spot + 1024 - room
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
                free += b"\1" * more
                room += more
            if tries > 64:  # the crowded front part is not looked through again
                low += 16
            base[at] = spot - children[0]
            for symbol in children:
                child = nodes[node][symbol]
                state[child] = base[at] + symbol
                check[state[child]], free[state[child]] = at, 0
                order.append(child)
        base, check, value = (np.array(x, np.int32) for x in (base, check, value))
        return cls(base, check, value)

    def matches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which start, end, value) of every key that begins at a start and stops by its
        end, key length by key length."""
        which, at = np.arange(len(starts)), starts.copy()
        state = np.zeros(len(starts), np.int64)
        top = len(self.check)
        while True:
            on = at < ends[which]
            which, at, state = which[on], at[on], state[on]
            if not len(which):
                return
            following = self.base[state].astype(np.int64) + data[at]
            good = (following < top) & (self.check[np.minimum(following, top - 1)] == state)
            which, at, state = which[good], at[good] + 1, following[good]
            found = np.flatnonzero(self.value[state] >= 0)
            yield which[found], at[found], self.value[state[found]]
