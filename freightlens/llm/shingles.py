"""Distinct word shingles of a batch of texts, and their minimum hashes."""

from __future__ import annotations

import numpy as np

from freightlens.llm.ragged import Hashes, mix

BLANKS = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
WORDS = ~BLANKS
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every word: what stands between ASCII white space."""
    borders = borders - borders[0]
    word = WORDS[data]
    head, tail = word.copy(), word.copy()
    head[1:] &= ~word[:-1]
    tail[:-1] &= ~word[1:]
    cuts = borders[(borders > 0) & (borders < len(data))]
    head[cuts] = word[cuts]
    tail[cuts - 1] = word[cuts - 1]
    starts = np.flatnonzero(head)
    return np.repeat(np.arange(len(borders) - 1), np.diff(np.searchsorted(starts, borders))), starts, np.flatnonzero(tail) + 1


def shingle_sets(data: np.ndarray, borders: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's distinct shingles, ascending, and n + 1 borders.

    ``data``, ``borders``: UTF-8 bytes of n texts, of which A-Z are lowered. A text of
    fewer words than ``size``, but not none, is one shingle.
    """
    n = len(borders) - 1
    data = LOWER[data]
    rows, starts, ends = words_of(data, borders)
    words = Hashes(data).spans(starts, ends)
    counts = np.bincount(rows, minlength=n)
    made = Hashes(words, 1)
    head = np.cumsum(counts) - counts
    whole = np.flatnonzero(rows[size - 1:] == rows[:len(rows) - size + 1]) if len(rows) >= size else np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    hashes = np.concatenate([made.spans(whole, whole + size), made.spans(head[short], head[short] + counts[short])])
    owner = np.concatenate([rows[whole], short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def signatures(hashes: np.ndarray, borders: np.ndarray, n_hashes: int) -> np.ndarray:
    """Minimum of each of ``n_hashes`` hash functions over each non-empty set (rows)."""
    starts = borders[:-1][np.diff(borders) > 0]
    out = np.empty((len(starts), n_hashes), np.uint64)
    keys = mix(np.arange(1, n_hashes + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    for k in range(n_hashes if len(starts) else 0):
        out[:, k] = np.minimum.reduceat((hashes ^ keys[k]) * (keys[k] | np.uint64(1)), starts)
    return mix(out)
