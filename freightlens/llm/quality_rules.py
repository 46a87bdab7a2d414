"""Quality rules by compression bands.

A text that zstandard makes much smaller than others of its length is repetitive or
made of few parts; one that it hardly makes smaller is noise. Both the whole text and
its chunks are compressed by themselves; the whole text's ratio must lie in the band of
its length, and at most a share of the chunks outside theirs. Chunks cover the whole text:
the last one ends with it and overlaps the one before. Chunks are as long as four of them
fit, up to a longest size; texts of that size or more have chunks of it in any case.

Counts of words, symbols, repeated lines and repeated word triples come with it; they
are array operations on a slice of texts at a time. No shuffle, one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.ragged import Hashes, mix, slices, utf8

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
BLANKS = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, by size in bytes: (up to, lowest, highest).

    Prose of up to a few hundred bytes keeps half to three quarters of its size and
    longer prose less, as the window fills; the limits leave some twentieths below and
    above what prose shows. The last row holds for all longer texts. ``short_chunks`` has the
    highest ratio of chunks up to some size, which short ones of prose need; the first is
    the shortest chunk there is.
    """

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.20, 1.20), (512, 0.49, 0.86), (1024, 0.455, 0.80), (2048, 0.44, 0.74), (4096, 0.42, 0.70),
        (8192, 0.405, 0.66), (16384, 0.39, 0.64), (65536, 0.37, 0.62), (float("inf"), 0.35, 0.62))
    chunk: int = 4096
    chunk_lowest: float = 0.40
    chunk_highest: float = 0.70
    chunk_share: float = 0.25
    short_chunks: tuple[tuple[int, float], ...] = ((256, 0.88), (512, 0.78))
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_outside long")


def _twice(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, hash) pairs: whether each stands twice or more, and whether it is not the first."""
    keys = mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return counts[which] > 1, later


def text_counts(data: np.ndarray, borders: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by text of a slice: UTF-8 bytes of all texts and their borders."""
    n = len(borders) - 1
    row_of = np.repeat(np.arange(n), np.diff(borders))
    blank = BLANKS[data]
    edge = np.ones(len(data), bool)
    edge[1:] = row_of[1:] != row_of[:-1]
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | edge))
    after = np.ones(len(data), bool)
    after[:-1] = blank[1:] | edge[1:]
    ends = np.flatnonzero(~blank & after) + 1
    word_rows = row_of[starts]
    out = {"n_words": np.bincount(word_rows, minlength=n),
           "word_chars": np.bincount(row_of[~blank & (data & 0xC0 != 0x80)], minlength=n),
           "n_symbols": np.bincount(row_of[SYMBOLS[data]], minlength=n)}
    hashes = Hashes(data)
    # lines with a word
    break_after = data == 10
    heads = edge.copy()
    heads[1:] |= break_after[:-1]
    line_starts = np.flatnonzero(heads)
    line_ends = np.append(line_starts[1:], len(data))
    line_ends = line_ends - break_after[line_ends - 1] if len(line_starts) else line_ends[:0]
    words_before = np.concatenate([[0], np.cumsum(~blank)])
    spoken = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends = line_starts[spoken], line_ends[spoken]
    _, later = _twice(row_of[line_starts], hashes.spans(line_starts, line_ends))
    out["n_dup_lines"] = np.bincount(row_of[line_starts[later]], minlength=n)
    # words inside a repeated window of three
    repeated = np.zeros(len(starts), bool)
    if len(starts) > 2:
        whole = np.flatnonzero(word_rows[2:] == word_rows[:-2])
        words = hashes.spans(starts, ends)
        windows = Hashes(words, 1).every(3)[whole]
        again, _ = _twice(word_rows[whole], windows)
        for k in range(3):
            repeated[whole[again] + k] = True
    out["n_repeat_words"] = np.bincount(word_rows[repeated], minlength=n)
    return out


def chunk_sizes(size: int, bands: Bands) -> list[int]:
    """Sizes of chunks that a text is judged by; none if it is shorter than the shortest chunk."""
    fine, shortest = bands.chunk, bands.short_chunks[0][0]
    while fine > shortest and 4 * fine > size:
        fine //= 2
    return [c for c in dict.fromkeys((bands.chunk, fine)) if c <= size]


def compression(text: memoryview, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, chunks of all sizes, chunks outside their band, verdict."""
    size = len(text)
    if not size:
        return 0.0, 0, 0, False
    ratio = len(packer.compress(text)) / size
    lowest, highest = next((low, high) for most, low, high in bands.whole if size <= most)
    good, n_chunks, n_outside = lowest <= ratio <= highest, 0, 0
    for chunk in chunk_sizes(size, bands):
        most = next((high for up_to, high in bands.short_chunks if chunk <= up_to), bands.chunk_highest)
        starts = [*range(0, size - chunk, chunk), size - chunk]
        outside = sum(not bands.chunk_lowest <= len(packer.compress(text[k:k + chunk])) / chunk <= most for k in starts)
        good &= outside <= bands.chunk_share * len(starts)
        n_chunks, n_outside = n_chunks + len(starts), n_outside + outside
    return ratio, n_chunks, n_outside, good


def _judged(texts: pa.Array, packer: zstandard.ZstdCompressor, bands: Bands) -> dict[str, np.ndarray]:
    """Result columns of a batch of texts."""
    data, borders = utf8(texts)
    kinds = {"base_failed": bool, "kept": bool, "ratio": float}
    columns = {c.split()[0]: np.zeros(len(texts), kinds.get(c.split()[0], np.int64)) for c in COLUMNS.split(", ")[1:]}
    view = memoryview(data)
    for a, b in slices(np.diff(borders)):
        counts = text_counts(data[borders[a]:borders[b]], borders[a:b + 1] - borders[a])
        found = [compression(view[borders[i]:borders[i + 1]], packer, bands) for i in range(a, b)]
        base = (counts["n_words"] < bands.min_words) | (
            100 * counts["n_repeat_words"] > bands.max_repeat_percent * counts["n_words"])
        counts["base_failed"] = base
        counts["kept"] = ~base & np.array([x[3] for x in found], bool)
        for k, name in enumerate(("ratio", "n_chunks", "n_chunks_outside")):
            counts[name] = np.array([x[k] for x in found])
        for name, values in counts.items():
            columns[name][a:b] = values
    return columns


def quality_rules(documents: DataFrame, bands: Bands = Bands(), id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Counts, compression and verdict of every row; other columns are not read.

    A null or blank text has no words and is not kept. Ids may be null or repeated,
    each row is judged by itself; an empty table gives no rows.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for batch in batches:
            columns = _judged(batch.column("text"), packer, bands)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(columns[c]) for c in names[1:]], names=names)

    return rows.mapInArrow(judge, COLUMNS)


def keep_good(documents: DataFrame, bands: Bands = Bands(), text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that ``quality_rules`` keeps."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            yield batch.filter(pa.array(_judged(batch.column(text_column), packer, bands)["kept"]))

    return documents.mapInArrow(keep, documents.schema)
