"""SentencePiece encoding and decoding: the best path over pieces with log scores.

The pieces of a model file are held in a double-array trie over UTF-8 bytes. Of all ways
to cut a text into pieces the one with the greatest sum of the file's scores is taken
(of equal ones that whose last piece is longest, and so on backwards); a character
that no piece covers costs less than any piece and becomes its bytes' pieces. A file of
any kind will do: its scores are used as they stand.

No piece runs over the border between a character and a following word marker (looked up
in the file), so that words can be cut apart from each other; each distinct word is cut
once while a worker remembers it. Decoding is a lookup of pieces' bytes.

One pass over (id, text), no shuffle; the trie is broadcast, its size is the vocabulary's.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.bpe import Memory
from freightlens.llm.double_array import DoubleArray
from freightlens.llm.ragged import Hashes, slices, within

SPACE = "▁".encode()
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
#: What an uncovered character scores below the lowest piece.
PENALTY = 10.0

_workers: dict[int, "Codec"] = {}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield tag >> 3, struct.unpack("<d" if size == 8 else "<f", data[at:at + size])[0]
            at += size


@dataclass
class Pieces:
    """What a model file says, and the trie of it."""

    surfaces: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    unknown: int
    dummy_prefix: bool
    trie: DoubleArray

    @classmethod
    def from_file(cls, path: str) -> "Pieces":
        surfaces, scores, kinds, normal = [], [], [], {}
        with open(path, "rb") as file:
            for field, value in _fields(file.read()):
                if field == 1:
                    piece = dict(_fields(value))
                    surfaces.append(piece.get(1, b""))
                    scores.append(piece.get(2, 0.0))
                    kinds.append(piece.get(3, NORMAL))
                elif field == 3:
                    normal = dict(_fields(value))
        if normal.get(1, b"") != b"identity" or normal.get(4, 1):
            raise ValueError("only models that leave the text as it is are covered: name identity, white space kept")
        kinds, scores = np.array(kinds), np.array(scores, np.float64)
        usable = np.flatnonzero((kinds == NORMAL) | (kinds == USER_DEFINED)).tolist()
        trie = DoubleArray.build([surfaces[i] for i in usable], usable)
        return cls(surfaces, scores, kinds, int(np.flatnonzero(kinds == UNKNOWN)[0]), bool(normal.get(3, 1)), trie)

    @property
    def words_apart(self) -> bool:
        """Whether no piece has a word marker after another character."""
        return not any(b"\1" in s.replace(SPACE, b"\1").lstrip(b"\1")
                       for s, k in zip(self.surfaces, self.kinds.tolist()) if k in (NORMAL, USER_DEFINED))


class Codec:
    """Encodes and decodes with one set of pieces; remembers words it has met."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.trie = pieces, pieces.trie
        self.apart = pieces.words_apart
        self.byte_ids = np.full(256, pieces.unknown, np.int64)
        for i in np.flatnonzero(pieces.kinds == BYTE).tolist():
            self.byte_ids[int(pieces.surfaces[i][3:5], 16)] = i
        self.lowest = pieces.scores[pieces.kinds == NORMAL].min() - PENALTY
        texts = []
        for surface, kind in zip(pieces.surfaces, pieces.kinds.tolist()):
            texts.append(bytes([int(surface[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                         else "⁇".encode() if kind == UNKNOWN else surface.replace(SPACE, b" "))
        self.text_sizes = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.cumsum(self.text_sizes) - self.text_sizes
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.memory = Memory()
        self._forget()

    def _forget(self) -> None:
        self.memory.forget()
        self.pool, self.used = np.empty(1 << 16, np.int32), 0

    def best_paths(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best path of each word, one after the other, and how many each has.

        ``data``: the words' bytes; ``borders``: n + 1 offsets.
        """
        n = len(borders) - 1
        sizes = np.diff(borders)
        heads = np.flatnonzero(data & 0xC0 != 0x80)
        word = np.searchsorted(borders, heads, side="right") - 1
        char_ends = np.append(heads[1:], len(data))
        edges = [(w, e, v) for w, e, v in self.trie.matches(data, heads, borders[word + 1])]
        start = np.concatenate([w for w, _, _ in edges]) if edges else np.empty(0, np.int64)
        end = np.concatenate([e for _, e, _ in edges]) if edges else np.empty(0, np.int64)
        piece = np.concatenate([v for _, _, v in edges]).astype(np.int64) if edges else np.empty(0, np.int64)
        covered = np.zeros(len(heads), bool)
        covered[start[end == char_ends[start]]] = True
        bare = np.flatnonzero(~covered)
        start = np.concatenate([start, bare])
        end = np.concatenate([end, char_ends[bare]])
        score = np.concatenate([self.pieces.scores[piece], np.full(len(bare), self.lowest)])
        piece = np.concatenate([piece, np.full(len(bare), self.pieces.unknown)])
        place = heads[start] - borders[word[start]]
        order = np.argsort(place, kind="stable")
        start_at, end, piece, score, place = heads[start[order]], end[order], piece[order], score[order], place[order]
        # each word has a place for its end: byte p of word w is at p + w
        best = np.full(len(data) + n, -np.inf)
        best[borders[:-1] + np.arange(n)] = 0.0
        owner = word[start[order]]
        source, target = start_at + owner, end + owner
        came = np.zeros(len(data) + n, np.int64)
        steps = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.empty(0, np.int64)
        for a, b in zip(steps.tolist(), [*steps[1:].tolist(), len(place)]):
            value = best[source[a:b]] + score[a:b]
            better = np.flatnonzero(value > best[target[a:b]])
            best[target[a:b][better]] = value[better]
            came[target[a:b][better]] = a + better
        at = borders[1:] + np.arange(n)
        active = np.flatnonzero(sizes > 0)
        rows, found, turns, turn = [], [], [], 0
        while len(active):
            edge = came[at[active]]
            rows.append(active)
            found.append(edge)
            turns.append(np.full(len(active), turn))
            at[active] = source[edge]
            active = active[at[active] > borders[active] + active]
            turn += 1
        if not rows:
            return np.empty(0, np.int32), np.zeros(n, np.int64)
        rows, found, turns = np.concatenate(rows), np.concatenate(found), np.concatenate(turns)
        order = np.lexsort((-turns, rows))
        rows, found = rows[order], found[order]
        ids = piece[found]
        unknown = ids == self.pieces.unknown
        spread = np.where(unknown, end[found] - start_at[found], 1)
        out = np.repeat(ids, spread)
        lone = np.repeat(unknown, spread)
        out[lone] = self.byte_ids[data[(np.repeat(start_at[found], spread) + within(spread))[lone]]]
        return out.astype(np.int32), np.bincount(rows, spread, n).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        prefix = SPACE if self.pieces.dummy_prefix else b""
        raw = [prefix + t.encode().replace(b" ", SPACE) if t else b"" for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[sizes > 0]
        if self.apart and len(data):
            mark = np.zeros(len(data) + 3, bool)
            mark[:len(data) - 2] = (data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])
            inside = mark.copy()
            inside[1:] |= mark[:-1]
            inside[2:] |= mark[:-2]
            cut = mark[:len(data)].copy()
            cut[1:] &= ~inside[:len(data) - 1]
            cut[starts] = True
            starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(data))
        rows = np.searchsorted(ends, starts, side="right")
        keys, first, which = np.unique(Hashes(data).spans(starts, stops), return_index=True, return_inverse=True)
        if len(self.memory.keys) + len(keys) > self.memory.most:
            self._forget()
        values, known = self.memory.find(keys)
        new = np.flatnonzero(~known)
        if len(new):
            a, lengths = starts[first[new]], (stops - starts)[first[new]]
            words = data[np.repeat(a, lengths) + within(lengths)]
            ids, counts = self.best_paths(words, np.concatenate([[0], np.cumsum(lengths)]))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty(len(self.pool), np.int32)])
            self.pool[self.used:self.used + len(ids)] = ids
            values[new] = (self.used + np.cumsum(counts) - counts) << 32 | counts
            self.used += len(ids)
            self.memory.add(keys[new], values[new])
        values = values[which]
        counts = values & 0xFFFFFFFF
        ids = self.pool[np.repeat(values >> 32, counts) + within(counts)]
        return ids, np.bincount(rows, counts, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts that ids stand for: byte pieces joined, word markers as spaces, the
        prefix that encoding puts before a text taken off, bytes that are no UTF-8 replaced."""
        sizes = self.text_sizes[ids]
        data = self.text_bytes[np.repeat(self.text_starts[ids], sizes) + within(sizes)].tobytes()
        borders = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        skip = 1 if self.pieces.dummy_prefix else 0
        return [data[a + (skip if data[a:a + 1] == b" " else 0):b].decode("utf-8", "replace")
                for a, b in zip(borders, borders[1:])]


def _codec(pieces) -> Codec:
    if pieces.id not in _workers:
        _workers.clear()
        _workers[pieces.id] = Codec(pieces.value)
    return _workers[pieces.id]


class _Shared:
    """Pieces as a broadcast, with the identity a worker knows its codec by."""

    def __init__(self, spark, path: str):
        pieces = Pieces.from_file(path)
        self.sent = spark.sparkContext.broadcast(pieces)
        self.id = zlib.crc32(repr((path, len(pieces.surfaces), pieces.scores.tobytes())).encode())

    @property
    def value(self) -> Pieces:
        return self.sent.value


def encode(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; other columns are not read.

    A null or empty text has no ids. Ids of documents may be null or repeated, each row
    is encoded by itself; an empty table gives no rows. A word marker in the text itself
    cannot be told from a space and is decoded as one.
    """
    pieces = _Shared(documents.sparkSession, model)
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for batch in batches:
            for a, b in slices(_lengths(batch.column("text"))):
                part = batch.slice(a, b - a)
                ids, counts = codec.encode([t or "" for t in part.column("text").to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids))],
                                                 names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of every (doc_id, ids) row; null or no ids give an empty text."""
    pieces = _Shared(encoded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            texts = codec.decode(np.concatenate(lists) if lists else np.empty(0, np.int64), np.array([len(x) for x in lists], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


REPORT = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, n_decoded_chars long, round_trip boolean"


def round_trip(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: pieces, byte pieces, crc32 of the ids (little-endian, 4 bytes each), length of
    what they decode to, and whether that is the text. Nulls and ties as in ``encode``."""
    pieces = _Shared(documents.sparkSession, model)
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        is_byte = codec.pieces.kinds == BYTE
        for batch in batches:
            for a, b in slices(_lengths(batch.column("text"))):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, counts = codec.encode(texts)
                back = codec.decode(ids, counts)
                borders = np.concatenate([[0], np.cumsum(counts)])
                fallen = np.concatenate([[0], np.cumsum(is_byte[ids])])[borders]
                raw = memoryview(ids.astype("<i4").tobytes())
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(borders.tolist(), borders[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(np.diff(fallen)), pa.array(crc, pa.int64()),
                     pa.array(map(len, back), pa.int64()), pa.array([x == y for x, y in zip(texts, back)])],
                    names=[c.split()[0] for c in REPORT.split(", ")])

    return rows.mapInArrow(run, REPORT)
