"""Exact copies by an extendible-hash index on shared files, in DataFrame functions only.

A text's key is the 64-bit hash of its bytes without white space. The index is built in bulk:

1. One narrow pass counts the rows of each key (combined in every task before the shuffle).
2. The directory starts with one slot and doubles while a bucket is overfull: a bucket that
   holds more rows than its capacity is split by the next bit of the key. The rows below
   every prefix of every depth come from one aggregation, so all doublings are decided at
   once: a prefix is a bucket if it is not overfull and its parent is.
3. Rows go to the owner of their bucket, a contiguous range of keys. There the rows of one
   key are a chain; its texts are compared byte by byte, and each text has a place in the
   chain. The owners write the index files, a row a document.
4. A key with very many rows cannot be split by bits, and no owner takes it: its texts are
   combined byte by byte in the tasks that read them, and its rows find their group by a
   join on a table of as many rows as there are such keys.

The directory has at most 2**``DEEPEST`` slots and there are at most ``HOT_KEYS`` keys of
step 4, whatever the data: both are broadcast. Nothing else is.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.session import land

BLANKS = " \t\n\x0b\x0c\r"
#: Rows a bucket holds at least before it is split, and the buckets that all rows may fill.
CAPACITY, BUCKETS = 1_000, 1 << 14
#: Bits of the deepest directory; a bucket there takes what comes.
DEEPEST = 18
#: A key is hot beyond this many rows, and beyond one HOT_KEYS-th of all rows.
HOT_ROWS, HOT_KEYS = 1_000, 50_000


def _slot(key: Column) -> Column:
    """The first ``DEEPEST`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - DEEPEST)


def _prefix(slot: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a slot."""
    return F.call_function("shiftright", slot, (F.lit(DEEPEST) - depth).cast("int"))


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """(depth, prefix, n_rows) of the buckets for ``keys`` (key, n), all prefixes disjoint.

    Every key's first bits are those of one bucket. A bucket is over its capacity only at
    depth ``DEEPEST``.
    """
    slots = keys.groupBy(_slot(F.col("key")).alias("slot")).agg(F.sum("n").alias("n"))
    levels = slots.select("n", "slot", F.explode(F.sequence(F.lit(0), F.lit(DEEPEST))).alias("depth"))
    levels = levels.groupBy("depth", _prefix(F.col("slot"), F.col("depth")).alias("prefix")).agg(F.sum("n").alias("n_rows"))
    levels = levels.withColumn("parent", F.shiftright("prefix", 1))
    over = levels.where(F.col("n_rows") > capacity).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    split = levels.join(over, ["depth", "parent"], "left_semi")
    room = (F.col("n_rows") <= capacity) | (F.col("depth") == DEEPEST)
    return split.unionByName(levels.where("depth = 0")).where(room).select("depth", "prefix", "n_rows")


def _owned(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """The rows of keys that are not hot, judged by the owner of their bucket."""
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    wide = lambda more: F.call_function("shiftleft", F.col("prefix") + more, (F.lit(depth) - F.col("depth")).cast("int"))
    slots = buckets.select(F.explode(F.sequence(wide(0), wide(1) - 1)).alias("slot"), wide(0).alias("bucket"))
    dealt = rows.withColumn("slot", _prefix(_slot(F.col("key")), F.lit(depth))).join(F.broadcast(slots), "slot").repartition("bucket")
    text = Window.partitionBy("bucket", "key", "body")
    best_first = text.orderBy(F.desc("n_points"), F.asc_nulls_last("doc_id"))
    return dealt.select(
        "doc_id", "bucket", "key", F.row_number().over(best_first).alias("place"),
        F.first("doc_id").over(best_first).alias("keep_id"), F.count("*").over(text).alias("group_size"),
        F.dense_rank().over(Window.partitionBy("bucket", "key").orderBy("body")).alias("chain"), F.sha2("body", 256).alias("text_sha256")).select(
        "doc_id", "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "text_sha256", "bucket", "key", "chain")


def _hot(rows: DataFrame) -> DataFrame:
    """The rows of hot keys: texts are combined where they are read, rows find their group."""
    digest = F.sha2("body", 256).alias("text_sha256")
    narrow = land(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_points", "key", digest), "hot-rows")
    texts = rows.select("key", digest, "body").groupBy("key", "text_sha256", "body").agg(F.count("*").alias("n"))
    groups = texts.groupBy("key", "text_sha256").agg(F.sum("n").alias("group_size"), F.count("*").alias("bodies"))
    first = F.min(F.struct((-F.col("n_points")).alias("most"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best")
    best = narrow.groupBy("key", "text_sha256").agg(first)
    size = F.when(F.col("bodies") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts of one SHA-256")).cast("long"))
    groups = land(groups.join(best, ["key", "text_sha256"]).select(
        "key", "text_sha256", size.alias("group_size"), F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("best_row"),
        F.row_number().over(Window.partitionBy("key").orderBy("text_sha256")).alias("chain")), "hot-groups")
    if groups.count() <= HOT_KEYS:
        groups = F.broadcast(groups)
    return narrow.join(groups, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("best_row")).alias("kept"), "text_sha256",
        F.lit(None).cast("long").alias("bucket"), "key", "chain")


def build_index(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
                hot_rows: int = HOT_ROWS, key_bits: int = 64) -> DataFrame:
    """The index files as a table, a row a document: doc_id, keep_id, group_size, kept,
    text_sha256, bucket (first slot of the key's bucket; null for a hot key), key, chain
    (place of the text among those of its key, from 1).

    ``key_bits``: bits of the hash that make the key; fewer make longer chains.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.length("text").alias("n_points"), F.translate("text", BLANKS, "").cast("binary").alias("body"))
    key = F.xxhash64("body")
    if key_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    rows = rows.withColumn("key", key)
    keys = land(rows.groupBy("key").agg(F.count("*").alias("n")), "index-keys")
    n_rows = keys.agg(F.sum("n")).first()[0] or 0
    hot_rows = max(hot_rows, ceil(n_rows / HOT_KEYS))
    hot = keys.where(F.col("n") > hot_rows).select("key")
    any_hot = not hot.isEmpty()
    buckets = land(directory(keys.where(F.col("n") <= hot_rows), max(capacity, ceil(n_rows / BUCKETS))), "index-directory")
    if not any_hot:
        return land(_owned(rows, buckets), "index")
    hot = F.broadcast(land(hot, "hot-keys"))
    owned = _owned(rows.join(hot, "key", "left_anti"), buckets)
    return land(owned.unionByName(_hot(rows.join(hot, "key", "left_semi"))), "index")


def exact_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per row: doc_id, keep_id (id of the row that stays), group_size, kept, text_sha256.

    Texts are equal when they are the same bytes without ASCII white space (space, tab to
    carriage return). Of equal texts the row with the most code points stays, then the one
    with the smallest id; rows without an id come last, and of rows that tie in all of it
    one stays. A null text counts as empty; empty and blank texts are one group. Other
    columns are not read; an empty table gives no rows.
    """
    return build_index(documents, id_column, text_column, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
