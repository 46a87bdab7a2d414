"""What sets the sources of a language apart: term shares, distances, and each one's own terms.

Terms are counted a slice of texts at a time and combined in every task before the shuffle.
With the counts of a language's kept terms landed, two reports are made from them:

* ``pair``: the distance of two sources. Terms are dealt to tasks; a task holds the terms of
  some sources as an array (terms x sources) and adds up all differences of a tile of at most
  ``TILE`` x ``TILE`` sources. Terms that no source of the tile has differ by the same amount
  each and are added by their number.
* ``term``: the terms of a source that stand out most, by a dominance skyband. A term can be
  among the first k only if fewer than k terms of the group dominate it: at least as many
  occurrences in the group, at most as many in the language, earlier in UTF-8 order. Each
  partition keeps its own skyband, the skybands of a group are merged into one, and only
  that is ranked exactly.

A term that is dominated by k others is dominated by k of the skyband, too (dominance is
transitive), so a task holds no more than the skyband of one group.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.ragged import slices, utf8
from freightlens.llm.words import LETTERS, lowered_words
from freightlens.session import land

SCALE, SMOOTH = 1_000_000_000, 5
#: Sources on a side of a tile, terms in an array, and parts that a tile's terms are dealt to.
TILE, CHUNK, PARTS = 128, 256, 128


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs) of rows (lang, source, text): occurrences and documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], names=["lang", "source"]).to_pylist()
            names = list({tuple(g.values()): None for g in groups})
            code = {g: i for i, g in enumerate(names)}
            group_of = np.array([code[tuple(g.values())] for g in groups], np.int64)
            for x, y in slices(np.diff(borders)):
                rows, words = lowered_words(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x], LETTERS)
                if not len(rows):
                    continue
                coded = words.dictionary_encode()
                width = len(coded.dictionary)
                term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                held, n = np.unique(rows * width + term, return_counts=True)  # once a row and term
                keys, at = np.unique(group_of[x + held // width] * width + held % width, return_inverse=True)
                total, docs = np.bincount(at, n).astype(np.int64), np.bincount(at)
                own = [names[g] for g in (keys // width).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in own]), pa.array([g[1] for g in own]), coded.dictionary.take(pa.array(keys % width)).cast(pa.string()),
                     pa.array(total), pa.array(docs)], names=["lang", "source", "term", "n", "n_docs"])

    counted = documents.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * n_terms)), exact; null without terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    whole = F.call_function("div", wide(n + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + wide(n_terms) * F.lit(SMOOTH).cast("decimal(1,0)"))
    return F.when(n_terms > 0, whole + 1).cast("long")


class Skyband:
    """Of terms that come by descending group count, then ascending language count and text,
    those that fewer than ``k`` others dominate."""

    def __init__(self, k: int):
        self.k, self.size = k, 0
        self.terms: list[str] = []
        self.lang_n = np.empty(1024, np.int64)  # by place in ``terms``

    def add(self, term: str, lang_n: int) -> bool:
        """Whether the term is in the skyband; it is kept, then."""
        at = bisect_left(self.terms, term)
        if int(np.count_nonzero(self.lang_n[:at] <= lang_n)) >= self.k:
            return False
        if self.size == len(self.lang_n):
            self.lang_n = np.concatenate([self.lang_n, np.empty_like(self.lang_n)])
        self.lang_n[at + 1:self.size + 1] = self.lang_n[at:self.size].copy()
        self.lang_n[at] = lang_n
        self.terms.insert(at, term)
        self.size += 1
        return True


def skybands(terms: DataFrame, k: int) -> DataFrame:
    """The skyband of every (lang, source) inside each partition of ``terms``
    (lang, source, term, n, lang_n, value)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Skyband(k)
        for batch in batches:
            kept = []
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "term", "lang_n"))
            for i, (lang, source, term, lang_n) in enumerate(zip(*columns)):
                if (lang, source) != group:
                    group, band = (lang, source), Skyband(k)
                if band.add(term, lang_n):
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    ordered = terms.sortWithinPartitions("lang", "source", F.desc("n"), "lang_n", "term")
    return ordered.mapInArrow(keep, terms.schema)


def own_terms(shares: DataFrame, k: int) -> DataFrame:
    """(lang, source, item, value, rank): the first ``k`` terms by p - q, where it is positive."""
    terms = shares.where("p > q").select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value"))
    merged = skybands(skybands(terms, k).repartition("lang", "source"), k)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _tile_sums(dealt: DataFrame) -> DataFrame:
    """(lang, a, b, n_terms, total) over rows (lang, left, right, part, term, no, p): sources
    ``no`` of blocks ``left`` and ``right``, rows without a term first, with the share of a
    term that the source does not have."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, where, base, total, n_terms, seen = None, {}, [], None, 0, []

        def flush() -> None:
            nonlocal total, n_terms, seen
            if not seen:
                return
            size = len(base)
            table = np.repeat(np.array(base, np.int64)[None], len(seen), 0)
            for i, cells in enumerate(seen):
                for no, p in cells:
                    table[i, where[no]] = p
            total = np.zeros((size, size), np.int64) if total is None else total
            for a in range(size):
                total[a] += np.abs(table - table[:, a:a + 1]).sum(0)
            n_terms += len(seen)
            seen = []

        def done() -> Iterator[pa.RecordBatch]:
            flush()
            if tile and n_terms:
                nos = list(where)
                pairs = [(i, j) for i, a in enumerate(nos) for j, b in enumerate(nos) if a < b and {a // TILE, b // TILE} == {tile[1], tile[2]}]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile[0]] * len(pairs), pa.string()), pa.array([nos[i] for i, _ in pairs], pa.int64()),
                     pa.array([nos[j] for _, j in pairs], pa.int64()), pa.array([n_terms] * len(pairs), pa.int64()),
                     pa.array([int(total[i, j]) for i, j in pairs], pa.int64())], names=["lang", "a", "b", "n_terms", "total"])

        last = None
        for batch in batches:
            for lang, left, right, part, term, no, p in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, left, right, part) != tile:
                    yield from done()
                    tile, where, base, total, n_terms, last = (lang, left, right, part), {}, [], None, 0, None
                if term is None:
                    where[no] = len(base)
                    base.append(p)
                    continue
                if term != last:
                    if len(seen) == CHUNK:
                        flush()
                    seen.append([])
                    last = term
                seen[-1].append((no, p))
        yield from done()

    return dealt.mapInArrow(add, "lang string, a long, b long, n_terms long, total long")


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language by distance.

    ``groups``: lang, source, no (from 0 in a language), p_none (share of a term that the
    source does not have), n_kept (kept terms of the language).
    """
    block = F.floor(F.col("no") / TILE).cast("long")
    last = groups.groupBy("lang").agg(F.max(block).alias("last"))

    def tiles(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("own", block).join(last, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        return rows.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))

    columns = ["lang", "left", "right", "part", "term", "no", "p"]
    terms = tiles(shares.join(groups.select("lang", "source", "no"), ["lang", "source"])).withColumn("part", F.pmod(F.xxhash64("term"), F.lit(PARTS)))
    heads = tiles(groups.select("lang", "no", F.col("p_none").alias("p"))).withColumn("term", F.lit(None).cast("string"))
    heads = heads.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    dealt = terms.select(columns).unionByName(heads.select(columns)).repartition("lang", "left", "right", "part")
    dealt = dealt.sortWithinPartitions("lang", "left", "right", "part", F.asc_nulls_first("term"))
    sums = _tile_sums(dealt).groupBy("lang", "a", "b").agg(F.sum("n_terms").alias("n_terms"), F.sum("total").alias("total"))
    side = lambda end: groups.select("lang", F.col("source").alias(f"source_{end}"), F.col("no").alias(end), F.col("p_none").alias(f"none_{end}"), "n_kept")
    pairs = side("a").join(side("b").drop("n_kept"), "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    unseen = F.col("n_kept") - F.coalesce("n_terms", F.lit(0))
    value = F.coalesce("total", F.lit(0)) + F.coalesce(unseen * F.abs(F.col("none_a") - F.col("none_b")), F.lit(0))
    both = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("source_a", "source_b"), ("source_b", "source_a"))))
    pairs = pairs.select("lang", value.alias("value"), F.explode(both).alias("pair")).select("lang", "pair.source", "pair.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order))


def source_divergence(documents: DataFrame, min_docs: int = 30, k: int = 50, text_column: str = "text", lang_column: str = "lang",
                      source_column: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` and ``term`` rows of every source.

    Null text, lang and source read as ''. Terms are runs of ASCII letters and of characters
    beyond ASCII, A-Z lowered; those in at least ``min_docs`` documents of their language are
    kept. Repeated rows count as documents each. A language without kept terms has distances
    of 0 and no terms; a source alone in its language has no pairs. Ties go to the earlier
    item in UTF-8 order. An empty table gives no rows. Other columns are not read.
    """
    plain = lambda c, as_: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(as_)
    rows = documents.select(plain(lang_column, "lang"), plain(source_column, "source"), plain(text_column, "text"))
    over = Window.partitionBy("lang", "term")
    counts = term_counts(rows).withColumn("lang_n", F.sum("n").over(over)).withColumn("docs", F.sum("n_docs").over(over))
    counts = counts.withColumn("lead", (F.row_number().over(over.orderBy("source")) == 1).cast("long"))
    counts = land(counts.where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "lead"), "kept-terms")

    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.sum("lead").alias("leads"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").na.fill(0, ["n_group", "leads"])
    own = Window.partitionBy("lang")
    groups = groups.withColumn("n_kept", F.sum("leads").over(own)).withColumn("n_lang", F.sum("n_group").over(own))
    groups = groups.withColumn("no", F.row_number().over(own.orderBy("source")).cast("long") - 1)
    groups = land(groups.withColumn("p_none", share(F.lit(0), F.col("n_group"), F.col("n_kept"))), "source-groups")

    shares = counts.join(groups.select("lang", "source", "n_group", "n_lang", "n_kept"), ["lang", "source"])
    shares = shares.select("lang", "source", "term", "n", "lang_n", share(F.col("n"), F.col("n_group"), F.col("n_kept")).alias("p"),
                           share(F.col("lang_n"), F.col("n_lang"), F.col("n_kept")).alias("q"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = distances(shares.select("lang", "source", "term", "p"), groups).withColumn("part", F.lit("pair"))
    return pairs.select(columns).unionByName(own_terms(shares, k).withColumn("part", F.lit("term")).select(columns))
