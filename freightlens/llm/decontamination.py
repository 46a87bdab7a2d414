"""Benchmark decontamination by a prefix-filtered set join, DataFrame functions only.

An item's windows (ten consecutive words, or all words of a shorter item) are sets of
short shingles. A document holds a window only if it holds all its shingles, so that of
the shingles ordered by rarity in the documents one, the rarest, is the necessary prefix:

1. One pass over the documents finds the places of any benchmark shingle, with the few
   words around each, and lands them.
2. Shingle frequencies over all documents choose each window's rarest shingle; a window
   with a shingle that no document has is given up.
3. Places and windows are joined on that one shingle. A place and the shingle's offset
   fix where the window would begin; it must begin and end inside the document.
4. The window's words are compared with the document's.

The shingles of the benchmark are broadcast only while their number, which is counted,
is within ``broadcast_rows``; beyond it narrow (document, place, shingle) rows are
shuffled. Later joins are on narrow rows and left to Spark's own size checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.session import land

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 4
#: Distinct shingles (16 bytes each and their table's room) that may be broadcast.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text, none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN), "")


def shingle(all_words: Column, at: Column, size: int) -> Column:
    """64-bit hash of the words from a place on, as many as there are up to ``size``."""
    return F.xxhash64(F.lit(size), *(F.get(all_words, at + i) for i in range(size)))


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """(item_id, window, n) of every item, once each; ``window`` is the words joined by spaces."""
    items = benchmark.select(F.col(id_column).alias("item_id"), words(F.col(text_column)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(window)))
    each = items.select("item_id", "n", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))).alias("at"))
    return each.select("item_id", "n", F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " ").alias("window")).distinct()


def window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """(window, n, offset, shingle): the shingles of each distinct window; a window of fewer
    words than a shingle is one itself."""
    split = windows.select("window", "n").distinct().withColumn("w", F.split("window", " "))
    each = split.select("window", "n", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - size, F.lit(0)))).alias("offset"))
    value = shingle(F.col("w"), F.col("offset"), size)
    for short in range(1, size):
        value = F.when(F.col("n") == short, shingle(F.col("w"), F.col("offset"), short)).otherwise(value)
    return each.select("window", "n", "offset", value.alias("shingle"))


def _places(documents: DataFrame, keys: DataFrame, sizes: list[int], window: int, broadcast_rows: int) -> DataFrame:
    """A row for each place of a benchmark shingle, and one at least for each document.

    ``around`` holds the words from ``window`` - 1 before the place to ``window`` - 1 after.
    """
    rows = documents.withColumn("w", words(F.col("text"))).withColumn("n_words", F.size("w")).drop("text")
    made = F.array(*(shingle(F.col("w"), F.col("at"), s) for s in sizes))
    at_start = F.coalesce(F.col("at"), F.lit(0)) == 0
    if keys.count() <= broadcast_rows:
        each = rows.select("*", F.posexplode_outer("w").alias("at", "word"))
        each = each.select("*", F.posexplode(made).alias("turn", "made")) if len(sizes) > 1 else each.withColumn("made", made[0])
        each = each.withColumn("at_start", at_start & (F.col("turn") == 0) if len(sizes) > 1 else at_start)
        found = each.join(F.broadcast(keys), F.col("made") == F.col("shingle"), "left").where("shingle is not null or at_start")
    else:
        narrow = rows.select("key_id", "key_text", "w", F.posexplode("w").alias("at", "word"))
        narrow = narrow.select("key_id", "key_text", "at", F.explode(made).alias("shingle"))
        places = narrow.join(keys, "shingle", "left_semi").distinct()
        places = places.groupBy("key_id", "key_text").agg(F.collect_list(F.struct("at", "shingle")).alias("places"))
        first = rows.select("*", F.lit(None).cast("int").alias("at"), F.lit(None).cast("long").alias("shingle"), F.lit(True).alias("at_start"))
        found = (rows.join(places, ["key_id", "key_text"]).select("*", F.explode("places").alias("p"))
                 .select("*", "p.at", "p.shingle", F.lit(False).alias("at_start")).select(first.columns).union(first))
    begin = F.greatest(F.col("at") - (window - 1), F.lit(0))
    return found.select(
        "doc_id", "key_id", "key_text", "n_words", "at", "shingle", "at_start", begin.alias("around_at"),
        F.when(F.col("shingle").isNotNull(), F.slice("w", begin + 1, F.lit(2 * window - 1))).alias("around"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE,
                  id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                  item_text_column: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or wordless text has no words and is clean; a null or wordless item has no
    windows. Rows that repeat an id and text get the same result each; rows of one id
    with different texts are judged apart. Without documents there are no rows; without
    items every document is clean. Other columns, whatever their names, are not read.
    """
    documents = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    documents = documents.withColumn("key_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    documents = documents.withColumn("key_text", F.xxhash64("text"))
    windows = land(item_windows(benchmark, item_column, item_text_column, window), "item-windows")
    shingles = land(window_shingles(windows, size), "window-shingles")
    lengths = [r.n for r in windows.where(F.col("n") < size).select("n").distinct().collect()]  # fewer than ``size`` rows
    places = land(_places(documents, shingles.select("shingle").distinct(), sorted({size, *lengths}), window, broadcast_rows), "places")

    found = places.where("shingle is not null")
    frequency = found.groupBy("shingle").agg(F.count("*").alias("frequency"))
    ranked = shingles.join(frequency, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "shingle", "offset")).alias("rarest"))
    prefixes = ranked.where("rarest.frequency > 0").select("window", "n", "rarest.shingle", "rarest.offset")

    candidates = found.join(prefixes, "shingle").withColumn("begin", F.col("at") - F.col("offset"))
    candidates = candidates.where("begin >= 0 and begin + n <= n_words")
    same = F.array_join(F.slice("around", F.col("begin") - F.col("around_at") + 1, F.col("n")), " ") == F.col("window")
    hits = land(candidates.where(same).select("key_id", "key_text", "begin", "n", "window").distinct(), "window-hits")

    keys = ["key_id", "key_text"]
    covered = hits.select(*keys, "begin", "n").distinct()
    covered = covered.select(*keys, F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1)).alias("at")).distinct()
    covered = covered.groupBy(*keys).agg(F.count("*").alias("n_hit"))
    items = hits.select(*keys, "window").distinct().join(windows.select("item_id", "window"), "window")
    items = items.select(*keys, F.col("item_id").cast("string").alias("item_id")).distinct().groupBy(*keys).agg(
        F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("item_ids"))
    rows = places.where("at_start").select("doc_id", *keys, "n_words")
    return (rows.join(covered, keys, "left").join(items, keys, "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.sha2(F.coalesce("item_ids", F.lit("")), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))
