"""Near-duplicate groups: banded minimum hashes, sequential Bayesian verification, exact check.

1. One pass over the texts makes each document's set of word shingles, and keeps its size,
   a fingerprint of the set and a signature (a byte or more of each minimum hash).
2. Documents with one set are one class; its smallest id stands for it.
3. Signatures are cut into bands, as many as the threshold needs; classes that share a
   band's value share a bucket. Every class of a bucket is a candidate of its smallest one.
4. Candidates' signatures are compared a batch at a time. With k of n bytes equal, the
   similarity has a Beta posterior; a pair is given up once the similarity is at or above
   the threshold with no more than the chosen miss probability. Survivors' whole sets are
   compared.
5. Links make components. Where a bucket's classes are not all in one component yet, the
   classes outside its largest one are compared with all of it, by the same two steps; a
   block of bounded size returns only the links that join two components. Where very many
   of a block's pairs come to the exact check, their intersections are counted together.
6. A bucket with more classes than a block is not compared as it stands. Two sets as alike
   as the threshold share one of their rarest shingles (a fifth of a set and one, at 0.8),
   so its classes meet again by those, and a class whose rare shingles are its own meets
   nobody. No link is lost by this: it is a property of the sets, not of the signatures.

So a bucket with very many classes costs a row a class and its rarest shingles, and
all-against-all is never emitted: what is compared beyond the first candidates is only
what is still apart and shares a rare shingle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.components import components
from freightlens.llm.ragged import slices, utf8
from freightlens.llm.shingles import shingle_sets, signatures
from freightlens.session import land

#: Minimum hashes of a set at most, how many are compared at a time, bytes of a band's value at
#: least, and the probability that a pair at the threshold shares no band.
HASHES, BATCH, BAND_BYTES, BAND_MISS = 288, 32, 6, 5e-7
#: Classes in a block of stage 5, and of those outside the largest component.
BLOCK, PIVOTS = 256, 128
#: The commonest shingles (16 bytes each) that are told apart without a join, in stage 6.
HEADS = 65_536
#: Ids (8 bytes each) of classes with a candidate that may be broadcast to find their texts.
BROADCAST_IDS = 4_000_000


@lru_cache
def banding(threshold: float) -> tuple[int, int, int]:
    """Bands, hashes a band and bytes a hash: the longest bands that miss a pair at the
    threshold with ``BAND_MISS`` at most; 48 of 6 hashes of a byte at 0.8."""
    if not 0 < threshold <= 1:
        raise ValueError(f"no similarity to reach: {threshold}")
    for rows in range(HASHES, 0, -1):
        share = threshold**rows
        bands = 1 if share == 1 else ceil(log(BAND_MISS) / log1p(-share)) if share > 1e-9 else HASHES + 1
        if bands * rows <= HASHES:
            return bands, rows, max(1, -(-BAND_BYTES // rows))
    raise ValueError(f"{HASHES} minimum hashes do not find pairs at similarity {threshold}")


@lru_cache
def least_equal(n_hashes: int, threshold: float, miss: float, width: int = 1) -> tuple[tuple[int, int], ...]:
    """(n, k) after each batch: with fewer than k of n hashes equal a pair is given up.

    A uniform prior on the share of equal hashes; of unequal ones, one in 256 to the power
    of the bytes that are kept agrees.
    """
    t = threshold + (1 - threshold) / 256**width
    steps = []
    for n in range(BATCH, n_hashes + 1, BATCH):
        tail = 0.0  # P(share >= t | k of n) = sum over i <= k of C(n+1, i) t^i (1-t)^(n+1-i)
        for k in range(n + 1):
            tail += comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
            if tail > miss:
                steps.append((n, k))
                break
    return tuple(steps)


def plausible(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which pairs of signature rows the sequential test does not give up."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    begin, width = 0, banding(threshold)[2]
    for n, k in least_equal(left.shape[1] // width, threshold, miss, width):
        same = left[alive, begin * width:n * width] == right[alive, begin * width:n * width]
        equal[alive] += (same if width == 1 else same.reshape(len(alive), n - begin, width).all(2)).sum(1)
        alive = alive[equal[alive] >= k]
        begin = n
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of ascending hashes have at least ``percent`` of their union in common."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketches(documents: DataFrame, size: int, n_hashes: int, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of every row; ``width`` bytes a hash."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            for x, y in slices(np.diff(borders)):
                hashes, at = shingle_sets(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], size)
                made = iter(signatures(hashes, at, n_hashes).astype("<u8").view(np.uint8).reshape(-1, n_hashes, 8)[:, :, :width])
                counts, raw = np.diff(at), memoryview(hashes.astype("<u8").tobytes())
                keys = [hashlib.blake2b(raw[8 * p:8 * q], digest_size=16).digest() for p, q in zip(at.tolist(), at[1:].tolist())]
                signs = [next(made).tobytes() if n else None for n in counts.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(x, y - x), pa.array(counts), pa.array(keys, pa.binary()),
                                                  pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "signature"])

    return documents.mapInArrow(sketch, "doc_id long, n_shingles long, set_key binary, signature binary")


def _sets(documents: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of every row, eight bytes a hash, ascending."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            for x, y in slices(np.diff(borders)):
                hashes, at = shingle_sets(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], size)
                raw = memoryview(hashes.astype("<u8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(x, y - x), pa.array([bytes(raw[8 * p:8 * q]) for p, q in zip(at.tolist(), at[1:].tolist())], pa.binary())],
                    names=["id", "shingles"])

    return documents.mapInArrow(make, "id long, shingles binary")


def _rows(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of bytes."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _verified(pairs: DataFrame, signs: DataFrame, sets: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Of (a, b) candidates those that are links."""
    percent = round(100 * threshold)

    def sequential(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keep = plausible(_rows(batch.column("sign_a")), _rows(batch.column("sign_b")), threshold, miss)
                yield batch.select(["a", "b"]).take(pa.array(keep))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)
                    for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda table, value, end: table.select(F.col("id").alias(end), F.col(value).alias(f"{'sign' if value == 'signature' else 'set'}_{end}"))
    both = pairs.join(side(signs, "signature", "a"), "a").join(side(signs, "signature", "b"), "b")
    alive = both.select("a", "b", "sign_a", "sign_b").mapInArrow(sequential, "a long, b long")
    alive = land(alive, "plausible-pairs")
    both = alive.join(side(sets, "shingles", "a"), "a").join(side(sets, "shingles", "b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(exact, "a long, b long")


def _apart(rest: DataFrame) -> DataFrame:
    """(key, id, component, n, n_outside, outside) of the buckets whose classes are not all in
    one component, of (key, id, component); of buckets with the same classes one stays. Landed."""
    sizes = rest.groupBy("key", "component").agg(F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("content"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts"),
                                       F.sum("size").alias("n"), F.sum("content").alias("content")).where("parts > 1")
    shown = F.struct("key", F.col("most.component").alias("main"), (F.col("n") - F.col("most.size")).alias("n_outside"))
    open_ = largest.groupBy("n", "content").agg(F.min(shown).alias("one")).select("n", "one.*")
    return land(rest.join(open_, "key").select("key", "id", "component", "n", "n_outside", (F.col("component") != F.col("main")).alias("outside")), "apart")


def _rare_buckets(crowded: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(key, id, component) by the rarest shingles of the classes of ``crowded``.

    In any order of shingles, two sets of which the larger has m and that have a share t of
    their union in common share one of the first m - ceil(t m) + 1 of each. Shingles of one
    set alone come first and join nothing, so they are only counted.
    """
    percent = round(100 * threshold)
    own = sets.join(crowded, "id").select("id", "component", "shingles")
    common = own.mapInArrow(_every_key, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    common = land(common, "common-shingles")
    # The commonest ones are what a template gives each of its classes. A class takes them last, and
    # no more than its share of rarest ones, so that only these meet the others, with their counts.
    heads = common.where(F.col("n") > BLOCK).orderBy(F.desc("n"), F.desc("key")).limit(HEADS).collect()
    heads = np.array([(r.key, r.n) for r in reversed(heads)], np.int64).reshape(-1, 2)

    shape = "id long, component long, size long, n_heads long, set long, key long, n long"
    tails = own.mapInArrow(_cut(heads, percent, False), shape).drop("n").join(common, "key")
    shared = tails.withColumn("tail", F.lit(1)).unionByName(own.mapInArrow(_cut(heads, percent, True), shape).withColumn("tail", F.lit(0)))
    classes = shared.groupBy("id", "component", "size", "n_heads", "set").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("common"), F.sum("tail").alias("n_tails"))
    first = F.ceil(F.col("size") * percent / F.lit(100)) * -1 + 1 + F.col("n_heads") + F.col("n_tails")
    kept = classes.select("id", "component", "common", first.cast("int").alias("first")).where("first > 0")
    return kept.select(F.explode(F.slice("common", F.lit(1), F.col("first")).getField("key")).alias("key"), "id", "component").distinct()


def _every_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every shingle of every set, one below the other."""
    for batch in batches:
        raw = batch.column("shingles").to_pylist()
        for x, y in slices(np.fromiter(map(len, raw), np.int64, len(raw))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(raw[x:y]), "<i8"))], names=["key"])


def _cut(heads: np.ndarray, percent: int, of_heads: bool):
    """Cuts sets into their shingles: those that are no heads, or the first of those that are.

    ``heads``: (key, n) of the commonest shingles, ascending by n and key. Of a set's heads
    come as many as it has rarest shingles at most, with their n.
    """
    by_key = np.argsort(heads[:, 0])
    known = heads[by_key, 0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("shingles").to_pylist()
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            for x, y in slices(sizes):
                size = sizes[x:y] // 8
                part = np.repeat(np.arange(y - x), size)
                keys = np.frombuffer(b"".join(raw[x:y]), "<i8")
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                head = known[at] == keys if len(known) else np.zeros(len(keys), bool)
                n_heads = np.bincount(part[head], minlength=y - x)
                if of_heads:
                    rank, part = by_key[at[head]], part[head]
                    order = np.lexsort((rank, part))
                    rank, part = rank[order], part[order]
                    nth = np.arange(len(part)) - np.repeat(np.cumsum(n_heads) - n_heads, n_heads)
                    first = nth < size[part] + (-size[part] * percent // 100) + 1
                    part, (keys, n) = part[first], heads[rank[first]].T
                else:
                    part, keys, n = part[~head], keys[~head], np.zeros(int((~head).sum()), np.int64)
                names = [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in raw[x:y]]
                rows = pa.array(part + x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("component").take(rows), pa.array(size[part]), pa.array(n_heads[part]),
                     pa.array(np.array(names, np.int64)[part]), pa.array(np.ascontiguousarray(keys)), pa.array(np.ascontiguousarray(n))],
                    names=["id", "component", "size", "n_heads", "set", "key", "n"])

    return cut


def _block_links(apart: DataFrame, signs: DataFrame, sets: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Links between components inside buckets, found block against block."""
    percent = round(100 * threshold)
    full = apart.join(signs.select("id", "signature"), "id").join(sets.select("id", "shingles"), "id")
    one = F.struct("id", "component", "signature", "shingles")
    dealt = lambda n, most: F.pmod(F.xxhash64("id"), F.ceil(F.col(n) / most))
    blocks = full.groupBy("key", dealt("n", BLOCK).alias("block")).agg(F.collect_list(one).alias("members"))
    pivots = full.where("outside").groupBy("key", dealt("n_outside", PIVOTS).alias("block")).agg(F.collect_list(one).alias("pivots"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for members, pivots in zip(batch.column("members"), batch.column("pivots")):
                links += _joining(members.as_py(), pivots.as_py(), threshold, miss, percent)
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return blocks.select("key", "members").join(pivots.select("key", "pivots"), "key").select("members", "pivots").mapInArrow(
        compare, "a long, b long")


def _joining(members: list[dict], pivots: list[dict], threshold: float, miss: float, percent: int) -> list[tuple[int, int]]:
    """Links from pivots to members that join components not yet joined in this block."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    signs, own = (np.frombuffer(b"".join(m["signature"] for m in side), np.uint8).reshape(len(side), -1) for side in (members, pivots))
    label, of = (np.array([m["component"] for m in side], np.int64) for side in (members, pivots))
    pivot, member = np.nonzero(of[:, None] != label)
    alive = plausible(signs[member], own[pivot], threshold, miss)
    pivot, member = pivot[alive], member[alive]
    sets, cores = ([np.frombuffer(m["shingles"], "<u8") for m in side] for side in (members, pivots))
    shared = _shared_shingles(sets, cores) if len(pivot) > BLOCK else None
    one_by_one = shared is None or len(shared) > len(pivot)  # a shingle costs the product about what a pair costs by itself
    if not one_by_one:
        common = _intersections(shared, sets, cores)[member, pivot]
        both = np.array(list(map(len, sets)))[member] + np.array(list(map(len, cores)))[pivot]
        near = 100 * common >= percent * (both - common)
        pivot, member = pivot[near], member[near]
    links = []
    for j, i in zip(pivot.tolist(), member.tolist()):
        x, y = root(members[i]["component"]), root(pivots[j]["component"])
        if x != y and (not one_by_one or linked(sets[i], cores[j], percent)):
            parent[max(x, y)] = min(x, y)
            links.append((members[i]["id"], pivots[j]["id"]))
    return links


def _shared_shingles(sets: list[np.ndarray], cores: list[np.ndarray]) -> np.ndarray:
    """The shingles that are in one of ``sets`` and in one of ``cores``, ascending."""
    return np.intersect1d(np.unique(np.concatenate(sets)), np.unique(np.concatenate(cores)), assume_unique=True)


def _intersections(shared: np.ndarray, sets: list[np.ndarray], cores: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each of ``sets`` (rows) has in common with each of ``cores``, as
    products of incidence matrices of ``width`` shared shingles at a time."""
    sides = []
    for side in (sets, cores):
        owner, keys = np.repeat(np.arange(len(side)), list(map(len, side))), np.concatenate(side)
        at = np.searchsorted(shared, keys)
        found = shared[np.minimum(at, len(shared) - 1)] == keys if len(shared) else np.zeros(len(keys), bool)
        at, owner = at[found], owner[found]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], owner[order], len(side)))
    common = np.zeros((len(sets), len(cores)), np.int64)
    for x in range(0, len(shared), width):
        one, other = (np.zeros((n, width), np.float32) for _, _, n in sides)
        for (at, owner, _), marks in zip(sides, (one, other)):
            p, q = np.searchsorted(at, [x, x + width])
            marks[owner[p:q], at[p:q] - x] = 1
        common += (one @ other.T).astype(np.int64)
    return common


def near_duplicates(documents: DataFrame, size: int = 5, threshold: float = 0.8, miss: float = 1e-9,
                    id_column: str = "doc_id", text_column: str = "text", broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable), kept (doc_id is it).

    Words stand between ASCII white space, A-Z are lowered; ``size`` words make a shingle.
    A text of fewer words is one shingle; a null or blank one has none and is linked with
    nothing. Rows of one id are one document with the links of all of them; a row without
    an id is a document of its own, kept, with a null component. Other columns are not read.
    A ``threshold`` that ``HASHES`` minimum hashes cannot serve raises an error.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    bands, length, width = banding(threshold)
    sketches = land(_sketches(rows, size, bands * length, width), "sketches")
    named = sketches.where("doc_id is not null and n_shingles > 0")
    classes = land(named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"),
                                                F.min("signature").alias("signature")), "set-classes")
    copied = classes.where("last > id").select("set_key", "id")
    same_set = named.select("doc_id", "set_key").join(copied, "set_key").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))

    value = lambda j: F.xxhash64(F.lit(j), F.substring("signature", j * length * width + 1, length * width))
    buckets = classes.select("id", F.explode(F.array(*(value(j) for j in range(bands)))).alias("key"))
    shared = buckets.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last").select("key", "pivot")
    members = land(buckets.join(shared, "key"), "bucket-members")

    ids = land(members.select("id").distinct(), "candidate-ids")
    near = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
    sets = land(_sets(rows.join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), size).where(F.octet_length("shingles") > 0).distinct(), "shingle-sets")
    signs = classes.select("id", "signature").join(near, "id", "left_semi")
    # Dealt by a, of which there is a row a band at most: neither the distinct nor the first join moves them again.
    pairs = members.where("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).repartition("a").distinct()
    first = land(_verified(pairs, signs, sets, threshold, miss), "first-links")

    labels = components(first)
    rest = members.where("id != pivot").join(labels, members.id == labels.node, "left")
    apart = _apart(rest.select("key", "id", F.coalesce("component", "id").alias("component")))
    crowded = land(apart.where(F.col("n") > BLOCK).select("id", "component").distinct(), "crowded-classes")
    if not crowded.isEmpty():
        apart = apart.where(F.col("n") <= BLOCK).union(_apart(_rare_buckets(crowded, sets, threshold)))
    later = land(_block_links(apart, signs, sets, threshold, miss), "later-links")
    found = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))  # the components of the first links
    labels = components(found.union(later).union(same_set))
    return (sketches.select("doc_id", "n_shingles").join(labels, sketches.doc_id == labels.node, "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
