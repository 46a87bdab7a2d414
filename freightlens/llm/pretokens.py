"""Splitting of texts into byte-level BPE pre-tokens by array operations.

The split is that of the public byte-level pattern: contractions, an optional space
before a run of letters, of digits or of other signs, and runs of white space that
leave their last character to what follows. Strings of special tokens inside a text
stand for themselves, as the tokenizers library has it by default.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata

import numpy as np

from freightlens.llm.ragged import BORDER, Hashes, code_points

LETTER, DIGIT, OTHER, SPACE, END = range(5)
# The Unicode White_Space property; the endings of the pattern's contractions.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point, and of ``BORDER``."""
    if not _classes:
        table = np.full(BORDER + 1, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": DIGIT}
        table[:BORDER] = np.fromiter(
            (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
            np.uint8, sys.maxunicode + 1)
        table[WHITE_SPACE] = SPACE
        table[BORDER] = END
        _classes.append(table)
    return _classes[0]


class Split:
    """Pre-tokens of a batch: rows, spans in the code points, span hashes."""

    def __init__(self, texts: list[str], specials: list[str]):
        self.n_special = np.zeros(len(texts), np.int64)
        self.special_order: dict[int, list[int]] = {}
        parts, rows = texts, np.arange(len(texts))
        marks = [s for s in specials if any(s in t for t in texts)]
        if marks:
            parts, rows = self._cut(texts, specials)
        self.flat, starts_of = code_points(parts)
        starts = token_starts(self.flat)
        borders = np.flatnonzero(starts)
        ends = np.append(borders[1:], len(self.flat))
        real = self.flat[borders] != BORDER
        self.starts, self.ends = borders[real], ends[real]
        self.parts = np.searchsorted(starts_of, self.starts, side="right") - 1
        self.rows = rows[self.parts]
        self.hashes = Hashes(self.flat).spans(self.starts, self.ends)

    def _cut(self, texts: list[str], specials: list[str]) -> tuple[list[str], np.ndarray]:
        pattern = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))
        parts, rows = [], []
        for i, text in enumerate(texts):
            found = pattern.findall(text)
            self.n_special[i] = len(found)
            pieces = pattern.split(text) if found else [text]
            for j in range(len(found)):
                self.special_order[len(parts) + j] = specials.index(found[j])
            parts += pieces
            rows += [i] * len(pieces)
        return parts, np.array(rows, np.int64)

    def text(self, k: int) -> str:
        return self.flat[self.starts[k]:self.ends[k]].astype("<u4").tobytes().decode("utf-32-le")


def token_starts(flat: np.ndarray) -> np.ndarray:
    """Where a pre-token starts in code points of texts parted by ``BORDER``."""
    kind = classes()[flat]
    n = len(flat)
    change = np.empty(n, bool)
    if not n:
        return change
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= kind == END
    follows_space = np.zeros(n, bool)
    follows_space[1:] = kind[:-1] == SPACE
    heads = np.flatnonzero(change & follows_space & (kind < SPACE))
    starts = change
    starts[heads - 1] = True
    starts[heads[flat[heads - 1] == 32]] = False
    quotes = np.flatnonzero(starts & (flat == ord("'")))
    if len(quotes):
        at = lambda k: flat[np.minimum(quotes + k, n - 1)]
        short = np.isin(at(1), [ord(c) for c in SHORT_ENDINGS])
        long = np.zeros(len(quotes), bool)
        for a, b in LONG_ENDINGS:
            long |= (at(1) == ord(a)) & (at(2) == ord(b))
        for which, size in ((short, 2), (long, 3)):
            q = quotes[which]
            starts[q + 1] = False
            starts[q + size] = True
    return starts


def special_tokens(path: str) -> list[dict]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)["added_tokens"]
