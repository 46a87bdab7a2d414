"""Token ids of whole texts as binary shards, and back.

Shard file, all numbers little-endian:

    8 bytes    magic
    segments   each: the ids' dictionary (4 bytes an id, most frequent first), control
               bytes (two bits an id, four ids a byte, first id lowest: length - 1),
               data bytes (the rank of each id in 1 to 4 bytes)
    documents  per document: id (8), null flag (1), number of ids (8), column by column
    segments   per segment: offset, dictionary entries, ids, data bytes (8 each)
    32 bytes   offset of the documents' columns, documents, segments, magic

Ids are ranked by frequency in their segment, so that the commonest 256 take one data
byte; control and data bytes are apart, so that a block is decoded by looking up the
control bytes in tables of lengths and offsets. Segments bound what a task holds.

Documents are sorted by a range shuffle of the text; a shard is one range. The only
things that reach the driver are the shards' names and totals.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.bpe import Memory
from freightlens.llm.files import make_file, make_folder, new_folder, open_file
from freightlens.llm.pretokens import Split
from freightlens.llm.ragged import slices, within

MAGIC = b"TOKIDS01"
#: Ids in a segment.
SEGMENT = 1 << 22

LENGTHS = np.stack([(np.arange(256) >> (2 * k) & 3) + 1 for k in range(4)], 1)
OFFSETS = np.cumsum(LENGTHS, 1) - LENGTHS
TOTALS = LENGTHS.sum(1)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

_workers: dict[str, "Encoder"] = {}


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dictionary, control bytes and data bytes of ids."""
    ids = ids.astype(np.uint32, copy=False)
    if not len(ids):
        return np.empty(0, np.uint32), np.empty(0, np.uint8), np.empty(0, np.uint8)
    top = int(ids.max())
    if top < 1 << 22:
        counts = np.bincount(ids, minlength=top + 1)
        seen = np.flatnonzero(counts)
        order = seen[np.argsort(-counts[seen], kind="stable")]
        rank_of = np.empty(top + 1, np.uint32)
        rank_of[order] = np.arange(len(order), dtype=np.uint32)
        ranks = rank_of[ids]
    else:
        seen, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
        by = np.argsort(-counts, kind="stable")
        order = seen[by]
        place = np.empty(len(by), np.uint32)
        place[by] = np.arange(len(by), dtype=np.uint32)
        ranks = place[which]
    sizes = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[:len(ids)] = sizes - 1
    padded = padded.reshape(-1, 4)
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return order.astype("<u4"), control.astype(np.uint8), data


def unpack(dictionary: np.ndarray, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ids that ``pack`` was given."""
    spare = -n % 4
    ends = np.cumsum(TOTALS[control])
    at = ((ends - TOTALS[control])[:, None] + OFFSETS[control]).reshape(-1)[:n]
    sizes = LENGTHS[control].reshape(-1)[:n]
    if len(control) and int(ends[-1]) - spare != len(data):
        raise ValueError("control bytes and data bytes do not agree")
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    ranks = padded[at].astype(np.uint32)
    for k in range(1, int(sizes.max()) if n else 1):
        ranks |= padded[at + k].astype(np.uint32) << np.uint32(8 * k)
    return dictionary[ranks & MASKS[sizes]]


class Encoder:
    """Ids of texts by the tokenizers library; each distinct pre-token is encoded once while remembered."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_padding()
        self.library.no_truncation()
        self.specials = [t["content"] for t in json.loads(content)["added_tokens"]]
        self.memory = Memory()
        self._forget()

    def _forget(self) -> None:
        self.memory.forget()
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts = np.zeros(1, np.int64)  # of each known pre-token's ids in the pool, and the end

    def _remember(self, keys: np.ndarray, words: list[str]) -> np.ndarray:
        """Numbers of new pre-tokens, whose ids go to the pool."""
        found = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        n = int(sizes.sum())
        while self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + n] = np.fromiter((i for ids in found for i in ids), np.uint32, n)
        values = len(self.starts) - 1 + np.arange(len(sizes))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes)])
        self.used += n
        self.memory.add(keys, values)
        return values

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if any(s in t for s in self.specials for t in texts):
            found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64)
        split = Split(texts, [])
        keys, first, which = np.unique(split.hashes, return_index=True, return_inverse=True)
        if len(self.memory.keys) + len(keys) > self.memory.most:
            self._forget()
        values, known = self.memory.find(keys)
        new = np.flatnonzero(~known)
        if len(new):
            values[new] = self._remember(keys[new], [split.text(k) for k in first[new].tolist()])
        values = values[which]
        begins = self.starts[values]
        sizes = self.starts[values + 1] - begins
        ids = self.pool[np.repeat(begins, sizes) + within(sizes)]
        return ids, np.bincount(split.rows, sizes, len(texts)).astype(np.int64)


def encoder(content: str) -> Encoder:
    if content not in _workers:
        _workers.clear()
        _workers[content] = Encoder(content)
    return _workers[content]


class Shard:
    """Writes one shard file, a segment at a time."""

    def __init__(self, folder: str):
        self.stream, self.path = make_file(folder, "shard")
        self.stream.write(MAGIC)
        self.offset, self.held, self.n_held = len(MAGIC), [], 0
        self.segments, self.doc_ids, self.nulls, self.sizes, self.n_ids = [], [], [], [], 0

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.nulls.append(np.array([d is None for d in doc_ids], np.uint8))
        self.doc_ids.append(np.array([d or 0 for d in doc_ids], "<i8"))
        self.sizes.append(sizes.astype("<i8"))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= SEGMENT:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        while len(ids) >= SEGMENT or last and len(ids):
            parts = pack(ids[:SEGMENT])
            n, ids = min(SEGMENT, len(ids)), ids[SEGMENT:]
            self.segments.append((self.offset, len(parts[0]), n, len(parts[2])))
            for part in parts:
                self.stream.write(part.tobytes())
                self.offset += part.nbytes
        self.held, self.n_held = [ids], len(ids)

    def close(self) -> tuple[str, int, int]:
        """Path, number of documents and of ids."""
        self._flush(True)
        columns = [np.concatenate(x) if x else np.empty(0) for x in (self.doc_ids, self.nulls, self.sizes)]
        for column in [*columns, np.array(self.segments, "<i8")]:
            self.stream.write(column.tobytes())
        n = len(columns[0])
        self.stream.write(struct.pack("<QQQ8s", self.offset, n, len(self.segments), MAGIC))
        self.stream.close()
        return self.path, n, self.n_ids


def read_shard(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document ids with their token ids; holds a segment and one document at a time."""
    with open_file(path) as file:
        size = file.size()
        at, n, n_segments, magic = struct.unpack("<QQQ8s", file.read_at(32, size - 32))
        if magic != MAGIC or file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no shard of token ids")
        raw = file.read_at(n * 17 + n_segments * 32, at)
        doc_ids = np.frombuffer(raw, "<i8", n)
        nulls = np.frombuffer(raw, np.uint8, n, 8 * n)
        sizes = np.frombuffer(raw, "<i8", n, 9 * n)
        segments = np.frombuffer(raw, "<i8", offset=17 * n).reshape(-1, 4)
        ids, following = np.empty(0, np.uint32), iter(segments.tolist())
        used = 0
        for doc_id, null, count in zip(doc_ids.tolist(), nulls.tolist(), sizes.tolist()):
            while len(ids) - used < count:
                offset, n_dictionary, n_ids, n_data = next(following)
                n_control = -(-n_ids // 4)
                block = file.read_at(4 * n_dictionary + n_control + n_data, offset)
                fresh = unpack(np.frombuffer(block, "<u4", n_dictionary),
                               np.frombuffer(block, np.uint8, n_control, 4 * n_dictionary),
                               np.frombuffer(block, np.uint8, n_data, 4 * n_dictionary + n_control), n_ids)
                ids, used = np.concatenate([ids[used:], fresh]), 0
            yield None if null else doc_id, ids[used:used + count]
            used += count


def write_token_store(documents: DataFrame, tokenizer: str, folder: str | None = None, end_id: int | None = 0,
                      id_column: str = "doc_id", text_column: str = "text") -> str:
    """Encode every text, write shards in ascending document order, return the folder.

    A null text is an empty one; ``end_id`` (if not None) follows each document. Null
    ids come first; rows of one id follow each other by a hash of their texts, so they may
    fill several shards. Only the two columns are read. The folder's ``shards`` table lists
    the files that count, by the number of their range.
    """
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "token-store")
    with open(tokenizer, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    make_folder(folder)
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"),
                            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "place"]
    ordered = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(content.value), None
        for batch in batches:
            if not len(batch):
                continue
            shard = shard or Shard(folder)
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            lengths = texts.cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset:lengths.offset + len(lengths) + 1])
            for a, b in slices(sizes):
                ids, counts = encode(texts.slice(a, b - a).to_pylist())
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                shard.add(doc_ids[a:b], ids, counts)
        if shard:
            path, n, n_ids = shard.close()
            yield pa.RecordBatch.from_pydict({"range": [TaskContext.get().partitionId()], "path": [path], "n_docs": [n], "n_ids": [n_ids]})

    shards = ordered.select("doc_id", "text").mapInArrow(write, "range long, path string, n_docs long, n_ids long")
    shards.write.parquet(f"{folder}/shards")
    return folder


def read_token_store(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shard files.

    ``start`` counts the ids of all documents before it. A task reads one shard.
    """
    shards = spark.read.parquet(f"{folder}/shards").collect()  # a row a file
    shards.sort(key=lambda s: s.range)
    starts = np.cumsum([0, *(s.n_ids for s in shards)]).tolist()
    listed = [(s.path, start) for s, start in zip(shards, starts)]
    files = spark.createDataFrame(listed, "path string, start long").repartition(max(1, len(listed)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], ([], [], [], [])
                for doc_id, ids in read_shard(row["path"]):
                    for column, value in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
