"""Token counts of whole texts by rank-synchronous array merging.

A batch of texts is split into pre-tokens by array operations. Pre-tokens that the
worker has not met are held as one ragged array of byte symbols; in each round every
sequence merges its lowest-ranked pair, all sequences at once, until none has a pair
left. A text's count is the sum over its pre-tokens plus its special strings.

No shuffle, one pass over the text column. Memory in a worker is a slice of texts
(about a million code points, or one longer text) and a memory of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.bpe import Memory, Merges
from freightlens.llm.pretokens import Split
from freightlens.llm.ragged import slices

_workers: dict[int, tuple["Counter", str]] = {}


class Counter:
    """Counts tokens of texts with one tokenizer file; remembers pre-tokens it has met."""

    def __init__(self, text: str):
        self.merges = Merges.from_json(text)
        self.specials = [t["content"] for t in json.loads(text)["added_tokens"]]
        self.memory = Memory()

    def __call__(self, texts: list[str]) -> np.ndarray:
        split = Split(texts, self.specials)
        keys, first, which = np.unique(split.hashes, return_index=True, return_inverse=True)
        values, known = self.memory.find(keys)
        new = np.flatnonzero(~known)
        if len(new):
            words = [split.text(k).encode() for k in first[new].tolist()]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            values[new] = self.merges.counts(np.frombuffer(b"".join(words), np.uint8), sizes)
            self.memory.add(keys[new], values[new])
        return np.bincount(split.rows, values[which], len(texts)).astype(np.int64) + split.n_special


def _counter(content: str) -> Counter:
    key = hash(content)
    if key not in _workers or _workers[key][1] != content:
        _workers.clear()
        _workers[key] = (Counter(content), content)
    return _workers[key][0]


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; other columns are not read.

    A null text counts as empty: no bytes, no tokens, not over the limit. An id may be
    null or repeated, each row is counted by itself; an empty table gives no rows.
    ``tokenizer``: a byte-level BPE file of the tokenizers library, read by the driver
    and broadcast (its size is that of the vocabulary, whatever the data).
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content.value)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            sizes = pc.binary_length(texts).cast(pa.int64())
            counts = np.zeros(len(batch), np.int64)
            for a, b in slices(sizes.to_numpy()):
                counts[a:b] = counter(texts.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
