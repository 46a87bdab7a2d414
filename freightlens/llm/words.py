"""Words of a batch of texts as one flat Arrow array, by byte classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTES = np.arange(256)
#: Bytes of letters and of whatever is not ASCII, after lowering.
LETTERS = ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: The same and digits.
LETTERS_DIGITS = LETTERS | ((_BYTES >= 48) & (_BYTES <= 57))


def lowered_words(data: np.ndarray, borders: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Row and lowered text of every run of bytes of the class ``word``.

    ``data``, ``borders``: UTF-8 bytes of n texts and n + 1 borders in them, from 0.
    """
    data = LOWER[data]
    inside = word[data]
    head, tail = inside.copy(), inside.copy()
    head[1:] &= ~inside[:-1]
    tail[:-1] &= ~inside[1:]
    cuts = borders[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    head[cuts] |= inside[cuts]
    tail[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    sizes = np.concatenate([[0], np.cumsum(ends - starts)])
    rows = np.searchsorted(borders, starts, "right") - 1
    flat = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(data[inside])])
    return rows, flat
