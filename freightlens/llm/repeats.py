"""Repeated byte strings across documents, by prefix-free parsing.

Every start of a string of ``length`` bytes is given an anchor: of the grams inside the
string the one whose rolling hash is lowest (the rightmost of equals). The anchor depends
on the string alone, so that equal strings have it at the same place. Neighbouring starts
with one anchor make a phrase, and a phrase's context (its first byte to the last byte of
its last string) holds all its strings.

1. Parse. One pass makes the phrases. Each task hands on one row for each anchor gram it
   has met; phrases that repeat a context inside the task are repeats, and a gram with
   several contexts inside the task has its phrases looked at closely in any case.
2. Merge. Grams meet, a row a task and gram at most, so no gram is too frequent. Of equal
   contexts the first in corpus order stays; grams with one context are done. What is left
   is the dictionary: distinct contexts whose gram also stands in another context.
3. Suffix order. The dictionary's contexts are shuffled by gram; the suffixes of a block of
   them are sorted by their first ``length`` bytes, and the parse's order (document, place)
   says which of equal ones is the first. Contexts of a very frequent gram are instead
   named string by string, and the names aggregated before they are shuffled.
4. Each document gets the starts of its repeats, and their bytes are taken off.

Corpus order is (id, place); nulls come first, and rows of one id follow in the order of
their texts' hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.ragged import Hashes, mix, slices, utf8, within
from freightlens.operators.distributed import number_rows
from freightlens.session import land

#: Bytes of a string, and the most that a phrase's 16-bit numbers hold.
LENGTH, LONGEST = 100, 65_535
#: Phrases a task parses before it hands on what it has found.
PHRASES = 300_000
#: Bytes of contexts sorted at a time; contexts of one gram beyond which its strings are named.
BLOCK, FREQUENT = 1 << 20, 20_000
#: Ids (16 bytes each) that may be broadcast to find their documents.
BROADCAST_IDS = 2_000_000

PHRASE = np.dtype([("gram", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("copy", "<i4"), ("at", "<u4"), ("n", "<u2"),
                   ("back", "<u2"), ("several", "?")])
SPAN = np.dtype([("at", "<u4"), ("n", "<u2"), ("back", "<u2")])
FINDINGS = "part long, doc_id long, copy int, repeats binary, open binary, phrases binary"


def gram_size(length: int) -> int:
    return max(1, length // 3 - 1)


def anchors(data: np.ndarray, borders: np.ndarray, length: int) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a slice: hashes of its bytes, row, first start, number of starts, anchor."""
    size = gram_size(length)
    window = length - size + 1
    hashes = Hashes(data)
    none = np.empty(0, np.int64)
    if len(data) < length:
        return hashes, none, none, none, none
    bits = np.uint64(int(len(data)).bit_length())
    grams = hashes.every(size)
    lowest = (grams >> bits << bits) | (np.uint64(len(data)) - np.arange(len(grams), dtype=np.uint64))
    reach = 1
    while 2 * reach <= window:
        lowest = np.minimum(lowest[:len(lowest) - reach], lowest[reach:])
        reach *= 2
    if reach < window:
        lowest = np.minimum(lowest[:len(lowest) - (window - reach)], lowest[window - reach:])
    anchor = len(data) - (lowest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    sizes = np.maximum(np.diff(borders) - (length - 1), 0)
    starts = np.repeat(borders[:-1], sizes) + within(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    anchor = anchor[starts]
    heads = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1]))) if len(starts) else none
    counts = np.diff(np.append(heads, len(starts)))
    return hashes, rows[heads], starts[heads], counts, anchor[heads]


def parse(data: np.ndarray, borders: np.ndarray, docs: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """The phrases of a slice of documents."""
    hashes, rows, starts, counts, anchor = anchors(data, borders, length)
    out = np.zeros(len(rows), PHRASE)
    out["gram"] = hashes.spans(anchor, anchor + gram_size(length))
    out["back"] = anchor - starts
    out["content"] = mix(hashes.spans(starts, starts + counts + length - 1) ^ mix(out["back"].astype(np.uint64)))
    out["doc"], out["copy"], out["at"], out["n"] = docs[rows], copies[rows], starts - borders[rows], counts
    return out


def _settle(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the phrases by gram, context and place; in that order, which are the first
    of their context and which of their gram."""
    order = np.lexsort((phrases["at"], phrases["copy"], phrases["doc"], phrases["several"], phrases["content"], phrases["gram"]))
    ordered = phrases[order]
    new_gram = np.append(True, ordered["gram"][1:] != ordered["gram"][:-1])
    first = new_gram | np.append(True, ordered["content"][1:] != ordered["content"][:-1])
    return order, first, new_gram


def _by_document(phrases: np.ndarray, is_repeat: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(doc, copy, repeats, open) spans of each document."""
    order = np.lexsort((phrases["at"], phrases["copy"], phrases["doc"]))
    phrases, is_repeat = phrases[order], is_repeat[order]
    heads = np.flatnonzero(np.append(True, (phrases["doc"][1:] != phrases["doc"][:-1]) | (phrases["copy"][1:] != phrases["copy"][:-1])))
    spans = np.empty(len(phrases), SPAN)
    for name in SPAN.names:
        spans[name] = phrases[name]
    for a, b in zip(heads.tolist(), np.append(heads[1:], len(phrases)).tolist()):
        part, repeat = spans[a:b], is_repeat[a:b]
        yield int(phrases["doc"][a]), int(phrases["copy"][a]), part[repeat].tobytes(), part[~repeat].tobytes()


def _found(documents: list[tuple[int, int, bytes, bytes]], parts: int) -> dict:
    doc, copy, repeats, open_ = zip(*documents) if documents else ((), (), (), ())
    return {"part": pa.array([d % parts for d in doc], pa.int64()), "doc_id": pa.array(doc, pa.int64()), "copy": pa.array(copy, pa.int32()),
            "repeats": pa.array(repeats, pa.binary()), "open": pa.array(open_, pa.binary()), "phrases": pa.nulls(len(doc), pa.binary())}


def _hand_on(phrases: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """What a task knows of its phrases, and one row for each gram, dealt to parts."""
    if not len(phrases):
        return
    order, first, new_gram = _settle(phrases)
    ordered = phrases[order]
    group = np.cumsum(new_gram) - 1
    several = (np.bincount(group, first) > 1)[group]
    settled = ~first | several
    if settled.any():
        known = list(_by_document(ordered[settled], ~first[settled]))
        for at in range(0, len(known), 4096):
            yield pa.RecordBatch.from_pydict(_found(known[at:at + 4096], parts))
    rows = ordered[new_gram]
    rows["several"] = several[new_gram]
    part = (rows["gram"] % np.uint64(parts)).astype(np.int64)
    rows = rows[np.lexsort((rows["at"], rows["doc"], part))]
    cuts = np.searchsorted(np.sort(part), np.arange(parts + 1))
    filled = np.flatnonzero(np.diff(cuts))
    blobs = [_columns(rows[cuts[k]:cuts[k + 1]]) for k in filled.tolist()]
    n = len(blobs)
    yield pa.RecordBatch.from_pydict({"part": pa.array(filled, pa.int64()), "doc_id": pa.nulls(n, pa.int64()), "copy": pa.nulls(n, pa.int32()),
                                      "repeats": pa.nulls(n, pa.binary()), "open": pa.nulls(n, pa.binary()), "phrases": pa.array(blobs, pa.binary())})


def _columns(rows: np.ndarray) -> bytes:
    """Column by column, so that places compress."""
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in PHRASE.names)


def _from_columns(raw: bytes) -> np.ndarray:
    n, at = len(raw) // PHRASE.itemsize, 0
    out = np.empty(n, PHRASE)
    for name in PHRASE.names:
        kind = PHRASE[name]
        out[name] = np.frombuffer(raw, kind, n, at)
        at += n * kind.itemsize
    return out


def _batch_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, borders = utf8(batch.column("text"))
    return data, borders, batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("copy").to_numpy(zero_copy_only=False)


def _findings(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """Repeats and open phrases of every document that has some."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            data, borders, docs, copies = _batch_arrays(batch)
            for x, y in slices(np.diff(borders)):
                phrases = parse(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], docs[x:y], copies[x:y], length)
                held.append(phrases)
                n += len(phrases)
                if n >= PHRASES:
                    yield from _hand_on(np.concatenate(held), parts)
                    held, n = [], 0
        if held:
            yield from _hand_on(np.concatenate(held), parts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            handed = batch.column("phrases").is_valid()
            known = batch.filter(batch.column("phrases").is_null())
            if len(known):
                yield known.select(["doc_id", "copy", "repeats", "open"])
            held += [_from_columns(raw) for raw in batch.filter(handed).column("phrases").to_pylist()]
        if not held:
            return
        phrases = np.concatenate(held)
        del held
        order, first, new_gram = _settle(phrases)
        ordered = phrases[order]
        group = np.cumsum(new_gram) - 1
        plain = ~ordered["several"]  # in a context before the marks of tasks that met several
        contexts = np.bincount(group, first & plain)
        marked = np.bincount(group, ~plain) > 0
        repeat = plain & ~first
        open_ = plain & first & ((contexts + marked)[group] > 1)
        told = repeat | open_
        documents = list(_by_document(ordered[told], repeat[told])) if told.any() else []
        for at in range(0, len(documents), 4096):
            found = _found(documents[at:at + 4096], 1)
            yield pa.RecordBatch.from_pydict({k: found[k] for k in ("doc_id", "copy", "repeats", "open")})

    handed = rows.select("doc_id", "copy", "text").mapInArrow(make, FINDINGS)
    return handed.repartition("part").mapInArrow(merge, "doc_id long, copy int, repeats binary, open binary")


def _contexts(rows: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """(gram, context, doc_id, copy, at, n) of every open phrase."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = gram_size(length)
        for batch in batches:
            data, borders, docs, copies = _batch_arrays(batch)
            for i, blobs in enumerate(batch.column("open").to_pylist()):
                spans = np.frombuffer(b"".join(blobs), SPAN)
                own = data[borders[i]:borders[i + 1]]
                at = spans["at"].astype(np.int64)
                anchor = at + spans["back"]
                grams = Hashes(own).spans(anchor, anchor + size)
                raw = own.tobytes()
                n = spans["n"].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array([raw[a:a + k + length - 1] for a, k in zip(at.tolist(), n.tolist())], pa.binary()),
                     pa.array(np.full(len(n), docs[i])), pa.array(np.full(len(n), copies[i])), pa.array(at), pa.array(n)],
                    names=["gram", "context", "doc_id", "copy", "at", "n"])

    joined = rows.join(open_, ["doc_id", "copy"]).select("doc_id", "copy", "text", "open")
    return joined.mapInArrow(cut, "gram long, context binary, doc_id long, copy int, at long, n long")


def _strings(contexts: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of contexts, and context and place of every string start in them."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    which = np.repeat(np.arange(len(counts)), counts)
    inside = within(counts)
    return np.frombuffer(b"".join(contexts), np.uint8), which, (np.cumsum(sizes) - sizes)[which] + inside


def later_starts(contexts: list[bytes], docs: np.ndarray, copies: np.ndarray, at: np.ndarray, counts: np.ndarray,
                 length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start in the document) of the strings that some context has earlier.

    The suffixes at the starts are sorted by their first ``length`` bytes, then by place.
    """
    data, which, place = _strings(contexts, counts)
    start = at[which] + within(counts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(data), np.uint64)  # eight bytes from each place on
    for j in range(8):
        word = word << np.uint64(8) | padded[j:len(data) + j]
    if length < 8:
        keys = [word[place] >> np.uint64(8 * (8 - length))]
    else:
        keys = [word[place + k] for k in (*range(0, length - 8, 8), length - 8)]
    order = np.lexsort((start, copies[which], docs[which], *reversed(keys)))
    same = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        key = key[order]
        same &= key[1:] == key[:-1]
    late = order[1:][same]
    return which[late], start[late]


def _runs(which: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of following starts: context, first, how many."""
    order = np.lexsort((start, which))
    which, start = which[order], start[order]
    heads = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1))) if len(which) else np.empty(0, np.int64)
    return which[heads], start[heads], np.diff(np.append(heads, len(which)))


def _sizes(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy().astype(np.int64)


LATER = "doc_id long, copy int, at long, n long"


def _sorted_later(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of later starts, block by block of whole grams."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def settle(rows: pa.Table) -> pa.RecordBatch:
            docs, copies, at, n = (rows.column(c).to_numpy() for c in ("doc_id", "copy", "at", "n"))
            which, start = later_starts(rows.column("context").to_pylist(), docs, copies, at, n, length)
            which, start, count = _runs(which, start)
            return pa.RecordBatch.from_arrays([pa.array(docs[which]), pa.array(copies[which]), pa.array(start), pa.array(count)],
                                              names=["doc_id", "copy", "at", "n"])

        for batch in batches:
            sizes = _sizes(batch.column("context"))
            for x, y in slices(sizes, BLOCK):
                held.append(batch.slice(x, y - x))
                size += int(sizes[x:y].sum())
                if size >= BLOCK:
                    rows = pa.Table.from_batches(held)
                    grams = rows.column("gram").to_numpy()
                    whole = int(np.searchsorted(grams, grams[-1]))  # the last gram may go on
                    if whole:
                        yield settle(rows.slice(0, whole))
                        held = rows.slice(whole).to_batches()
                        size = sum(int(_sizes(b.column("context")).sum()) for b in held)
        if held:
            yield settle(pa.Table.from_batches(held))

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, LATER)


def _named_later(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts: strings are named by two hashes, the first
    place of a name is aggregated before the shuffle."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            data, which, place = _strings(batch.column("context").to_pylist(), n)
            names = [Hashes(data, seed).spans(place, place + length).view(np.int64) for seed in (3, 4)]
            take = pa.array(which)
            start = batch.column("at").to_numpy()[which] + within(n)
            yield pa.RecordBatch.from_arrays([pa.array(names[0]), pa.array(names[1]), batch.column("doc_id").take(take), batch.column("copy").take(take),
                                              pa.array(start)], names=["one", "two", "doc_id", "copy", "at"])

    named = contexts.mapInArrow(name, "one long, two long, doc_id long, copy int, at long")
    firsts = named.groupBy("one", "two").agg(F.min(F.struct("doc_id", "copy", "at")).alias("first"), F.count("*").alias("times")).where("times > 1")
    later = named.join(firsts, ["one", "two"]).where(F.struct("doc_id", "copy", "at") != F.col("first"))
    return later.select("doc_id", "copy", "at", F.lit(1).cast("long").alias("n"))


def _keyed(documents: DataFrame, doc_id: Column, text: Column, others: list[str]) -> DataFrame:
    """The rows with what orders them: doc_id (nulls lowest) and a number for rows of one id.

    The number is the place among all rows of repeated ids, by ranges of id, text and place in
    the input, so that many rows without an id are no task's own.
    """
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.coalesce(doc_id.cast("long"), F.lit(-(2**63))).alias("doc_id"),
                            F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    again = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if again.isEmpty():
        return rows.withColumn("copy", F.lit(0))
    again = land(again, "repeated-ids")
    many = rows.withColumn("place", F.monotonically_increasing_id()).join(again, "doc_id", "left_semi")
    many = number_rows(many, ["doc_id", F.xxhash64("text"), "place"], "copy").withColumn("copy", F.col("copy").cast("int")).drop("place")
    return land(many.unionByName(rows.join(again, "doc_id", "left_anti").withColumn("copy", F.lit(0))), "keyed-documents")


def _meet(rows: DataFrame, table: DataFrame, ids: DataFrame, broadcast_ids: int, keep_all: bool) -> DataFrame:
    """Rows with their part of ``table``; only documents that have one are shuffled while
    the ids' counted number allows a broadcast."""
    how = "left" if keep_all else "inner"
    if ids.count() > broadcast_ids:
        return rows.join(table, ["doc_id", "copy"], how)
    with_part = rows.join(F.broadcast(ids), ["doc_id", "copy"], "left_semi").join(table, ["doc_id", "copy"])
    if not keep_all:
        return with_part
    missing = [f for f in table.schema if f.name not in ("doc_id", "copy")]
    rest = rows.join(F.broadcast(ids), ["doc_id", "copy"], "left_anti")
    return with_part.unionByName(rest.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing)))


def remove_repeats(documents: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text",
                   frequent: int = FREQUENT, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(row, doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row of documents.

    ``row`` is the input row without its text; ``kept`` is what is left of the text,
    less characters of which only a part is left. Bytes covered by a string of ``length``
    bytes that starts earlier, too, are removed; strings are judged on the input and lie
    inside one document. A null text is empty, a text of fewer bytes is left as it is. A
    null id comes before all others; rows of one id are documents one after the other.
    A ``length`` beyond ``LONGEST`` raises an error.
    """
    if not 0 < length <= LONGEST:
        raise ValueError(f"strings of {length} bytes, of 1 to {LONGEST}")
    spark = documents.sparkSession
    rows = _keyed(documents, F.col(id_column), F.col(text_column), [c for c in documents.columns if c != text_column])
    narrow = rows.select("doc_id", "copy", "text")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    findings = land(_findings(narrow, length, parts), "phrase-findings")

    open_ = findings.where(F.octet_length("open") > 0)
    open_ids = land(open_.select("doc_id", "copy").distinct(), "open-ids")
    gathered = open_.groupBy("doc_id", "copy").agg(F.collect_list("open").alias("open"))
    near = narrow if open_ids.count() > broadcast_ids else narrow.join(F.broadcast(open_ids), ["doc_id", "copy"], "left_semi")
    contexts = land(_contexts(near, gathered, length), "dictionary")
    many = land(contexts.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > frequent).select("gram"), "frequent-grams")
    later = _sorted_later(contexts.join(many, "gram", "left_anti"), length)
    if not many.isEmpty():
        later = later.union(_named_later(contexts.join(many, "gram", "left_semi"), length))
    later = land(later, "later-starts")

    runs = later.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("at", "n")).alias("starts"))
    whole = findings.where(F.octet_length("repeats") > 0).groupBy("doc_id", "copy").agg(F.collect_list("repeats").alias("repeats"))
    removal = land(whole.join(runs, ["doc_id", "copy"], "full"), "removals")
    met = _meet(rows, removal, removal.select("doc_id", "copy"), broadcast_ids, True)
    numbers = [T.StructField(name, T.LongType()) for name in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    out = T.StructType([rows.schema["row"], *numbers, T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())])

    def take_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            found = ([], [], [], [], [])
            for i, (blobs, starts) in enumerate(zip(batch.column("repeats").to_pylist(), batch.column("starts").to_pylist())):
                own = data[borders[i]:borders[i + 1]]
                gone = removed(len(own), b"".join(blobs or []), [(s["at"], s["n"]) for s in starts or []], length)
                left = own[~gone].tobytes() if gone is not None else own.tobytes()
                edges = 0 if gone is None else int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
                for column, value in zip(found, (len(own), len(own) - len(left), edges, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore"))):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(found, kinds))],
                                             names=["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = met.select("row", "doc_id", "text", "repeats", "starts").mapInArrow(take_off, out)
    return done.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(-(2**63))))


def removed(size: int, blob: bytes, starts: list[tuple[int, int]], length: int) -> np.ndarray | None:
    """Which bytes of a document are covered, None if none is."""
    spans = np.frombuffer(blob, SPAN)
    at = np.concatenate([spans["at"].astype(np.int64), np.array([a for a, _ in starts], np.int64)])
    n = np.concatenate([spans["n"].astype(np.int64), np.array([k for _, k in starts], np.int64)])
    if not len(at):
        return None
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0
