"""Resampling towards a target distribution by hashed features, exact ranks by parallel sorting.

1. Both corpora are counted into hashed buckets of word runs, an array a task; the sums have
   one row a bucket, however much text there is.
2. A bucket's gain is the log ratio of its shares in the target and in the corpus. A document's
   weight is the sum of the gains of its features, looked up in an array; a hash of its id
   gives the noise that turns the highest scores into a weighted sample without replacement.
3. Ranks by regular sampling: every task sorts its rows (a run) and gives every s-th of them;
   regular splitters of these cut all runs into segments. Counts of the segments give the rank
   before each; segments that begin within the draw are exchanged and merged, each by itself,
   and a row's rank is its place in the segment after that count. Segments beyond the draw
   never move.

The sort key ends with the row's number, so rows that tie in everything else, however many,
are cut like others. Gains (a row a bucket) and splitters (``SAMPLES`` and one a run at most)
are the only things that reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from freightlens.llm.ragged import slices, utf8
from freightlens.llm.words import LETTERS_DIGITS, lowered_words
from freightlens.session import land

#: Rows that a segment has about, the most segments, and the samples that cut them.
SEGMENT, SEGMENTS, SAMPLES = 8_192, 1_024, 1 << 16
#: Stands for an id that is null: behind all others.
_LAST = 2**63 - 1


def features(data: np.ndarray, borders: np.ndarray, n_buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature (runs of 1 to ``longest`` words), and words of each row."""
    rows, words = lowered_words(data, borders, LETTERS_DIGITS)
    at_rows, at_buckets = [], []
    for size in range(1, longest + 1):
        whole = np.flatnonzero(rows[size - 1:] == rows[:len(rows) - size + 1]) if len(rows) >= size else np.empty(0, np.int64)
        runs = words if size == 1 else pc.binary_join_element_wise(*(words.take(pa.array(whole + k)) for k in range(size)), pa.scalar(" ", pa.large_string()))
        coded = runs.dictionary_encode()
        hashed = np.array([zlib.crc32(w.encode()) % n_buckets for w in coded.dictionary.to_pylist()], np.int64)
        at_rows.append(rows[whole])
        at_buckets.append(hashed[coded.indices.to_numpy(zero_copy_only=False)] if len(hashed) else np.empty(0, np.int64))
    return np.concatenate(at_rows), np.concatenate(at_buckets), np.bincount(rows, minlength=len(borders) - 1)


def bucket_counts(texts: DataFrame, n_buckets: int, longest: int) -> DataFrame:
    """(bucket, n) of the features of all rows of ``text``; buckets without any have no row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            for x, y in slices(np.diff(borders)):
                _, buckets, _ = features(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], n_buckets, longest)
                total += np.bincount(buckets, minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's shares, smoothed by one, in thousandths, rounded down."""
    s_all, t_all, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratio = ((target + 1) * float(s_all + n)) / ((corpus + 1) * float(t_all + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A Gumbel variate in thousandths, rounded down, drawn from the id's hash."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(rows: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            for x, y in slices(np.diff(borders)):
                at, buckets, n_words = features(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], len(gain), longest)
                weight = np.zeros(y - x, np.int64)
                np.add.at(weight, at, gain[buckets])
                ids = batch.column("doc_id").slice(x, y - x)
                drawn = np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.bincount(at, minlength=y - x)), pa.array(n_words), pa.array(weight), pa.array(weight + drawn)],
                    names=["doc_id", "n_features", "n_words", "weight", "score"])

    return rows.mapInArrow(score, "doc_id long, n_features long, n_words long, weight long, score long")


def _regular_samples(runs: DataFrame, step: int) -> list[tuple[int, int, int]]:
    """Sort keys at every ``step``-th place of each sorted run, in order."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = step // 2  # places to go until the next sample
        for batch in batches:
            yield batch.take(pa.array(np.arange(at, len(batch), step)))
            at = at - len(batch) if at >= len(batch) else (at - len(batch)) % step

    sample = runs.select("down", "id", "row").mapInArrow(pick, "down long, id long, row long")
    return sorted(tuple(r) for r in sample.collect())


def segments_of(down: np.ndarray, ids: np.ndarray, rows: np.ndarray, splitters: list[tuple[int, int, int]]) -> np.ndarray:
    """How many splitters are at or before each key."""
    first = np.array([s[0] for s in splitters], np.int64)
    low, high = np.searchsorted(first, down, "left"), np.searchsorted(first, down, "right")
    for i in np.flatnonzero(low < high).tolist():  # ties with a splitter's score
        low[i] = bisect_right(splitters, (int(down[i]), int(ids[i]), int(rows[i])), int(low[i]), int(high[i]))
    return low


def sorted_ranks(scored: DataFrame, draw: int, n_rows: int, segment: int = SEGMENT, most: int = SEGMENTS, samples: int = SAMPLES) -> DataFrame:
    """``scored`` (doc_id, score, row, ...) and ``rank``: 1 to ``draw`` by descending score,
    then ascending doc_id (nulls last), then row; null beyond."""
    keyed = scored.withColumn("down", -F.col("score")).withColumn("id", F.coalesce("doc_id", F.lit(_LAST)))
    parts = min(most, max(1, math.ceil(n_rows / segment)))
    order = ["down", "id", "row"]
    found = _regular_samples(keyed.select(order).sortWithinPartitions(order), max(1, n_rows // samples)) if parts > 1 else []
    splitters = sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []
    shared = scored.sparkSession.sparkContext.broadcast(splitters)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            down, ids, rows = (batch.column(c).to_numpy() for c in order)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segments_of(down, ids, rows, shared.value))], names=[*batch.schema.names, "segment"])

    cut = land(keyed.mapInArrow(assign, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", segment long"), "segments")
    sizes = dict(tuple(r) for r in cut.groupBy("segment").count().collect())
    before, total = [], 0
    for k in range(len(splitters) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    last = sum(b < draw for b in before)  # segments that begin within the draw
    place = F.row_number().over(Window.partitionBy("segment").orderBy(order))
    start = F.element_at(F.array(*map(F.lit, before)), (F.col("segment") + 1).cast("int"))
    moved = cut.where(F.col("segment") < last).withColumn("rank", start.cast("long") + place)
    moved = moved.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = cut.where(F.col("segment") >= last).withColumn("rank", F.lit(None).cast("long"))
    return moved.unionByName(rest).select(*scored.columns, "rank")


def importance_sample(documents: DataFrame, target: DataFrame, percent: int = 10, n_buckets: int = 10_000, longest: int = 1,
                      min_words: int = 20, seed: int = 2024, id_column: str = "doc_id", text_column: str = "text", **sorting) -> DataFrame:
    """Per row of ``documents``: doc_id, n_features, weight, score, rank (null if not drawn).

    Words are runs of ASCII letters, digits and of characters beyond ASCII, A-Z lowered. Of
    the rows with at least ``min_words`` words, ``percent`` in a hundred are drawn (rounded
    down), those of the highest scores, ties to the smaller id. Rows of one id have the same
    noise and are drawn each by itself; a row without an id has the noise of an empty id and
    comes after others of its score. A null or empty text has no features and weight 0. An
    empty corpus gives no rows; without any target text the gains are those of a target of
    equal shares. Other columns are not read.
    """
    text = lambda df: F.col(text_column).cast("string").alias("text")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text(documents))
    arrays = []
    for table in (rows, target.select(text(target))):
        counts = np.zeros(n_buckets, np.int64)
        for bucket, n in bucket_counts(table, n_buckets, longest).collect():
            counts[bucket] = n
        arrays.append(counts)
    scored = _scored(rows, gains(*arrays), longest, seed).withColumn("row", F.monotonically_increasing_id())
    scored = land(scored, "scored")
    long = scored.where(F.col("n_words") >= min_words)
    n = long.count()
    ranked = sorted_ranks(long, percent * n // 100, n, **sorting)
    short = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short).select("doc_id", "n_features", "weight", "score", "rank")
