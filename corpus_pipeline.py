"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written
as Parquet and read again as the next one's docs. All but the last return the columns of
``documents``:

1. quality rules: documents that the rules reject go;
2. near-duplicates (shingles of five words, similarity 0.8): of each group the row with the
   smallest id stays, a row without an id only where none has one;
3. repeated byte strings: a text loses what an earlier one has, too, its length is counted
   anew, and a document stays even if nothing of its text is left;
4. benchmark decontamination: documents that hold a window of an item go;
5. pieces: each text is encoded and decoded, one row a document.

Documents are told apart by a row key, a 64-bit hash of id and text, so that rows without
an id and rows of one id are judged each by itself; rows that are equal in both are copies,
of which the second stage keeps one.

No statement in SQL can compress as the first stage does, so there is none for the rows;
the tests hold them against a plain version of every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import decontamination, near_duplicates, quality_rules, repeats, sentencepieces
from freightlens.session import land

#: Row keys (8 bytes each) that may be broadcast; beyond it the documents are shuffled.
BROADCAST_KEYS = 2_000_000
KEY = "_row_key"

#: Rows in an Arrow batch between Spark and Python: a few MB of whole texts. All stages run
#: on the same executors, whose JVM and workers keep what the largest batch has needed.
BATCH_ROWS = 500

ORACLE_SQL: str | None = None


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("text")))


def _among(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The keyed documents whose key is ("left_semi") or is not ("left_anti") one of ``keys``."""
    keys = land(keys.select(KEY).distinct(), "row-keys")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return docs.join(keys, KEY, how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    keyed = _keyed(docs)
    groups = near_duplicates.near_duplicates(keyed.select(KEY, "text"), id_column=KEY).where("component_id IS NOT NULL")
    rows = land(groups.select(F.col("doc_id").alias(KEY), "component_id").distinct(), "row-groups")
    ids = land(keyed.groupBy(KEY).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "row-ids")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", KEY))
    shared = rows.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = rows.join(shared, "component_id").join(ids.select(KEY, "doc_id"), KEY)
    stays = members.groupBy("component_id").agg(first.alias("first")).select("component_id", F.col(f"first.{KEY}").alias("stays"))
    dropped = members.join(stays, "component_id").where(F.col(KEY) != F.col("stays"))
    kept = _among(keyed, dropped, "left_anti")
    copied = ids.where("copies > 1")
    if copied.isEmpty():
        return kept.select(docs.columns)
    once = _among(kept, copied, "left_semi").dropDuplicates([KEY])
    return _among(kept, copied, "left_anti").unionByName(once).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    left = repeats.remove_repeats(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return left.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    found = decontamination.decontaminate(keyed, benchmark, id_column=KEY).where("contaminated")
    return _among(keyed, found.select(F.col("doc_id").alias(KEY)), "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return sentencepieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality), ("near_duplicates", deduplicate), ("repeats", cut_repeats),
          ("decontamination", decontaminate), ("sentencepieces", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
