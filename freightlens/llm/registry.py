"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from freightlens.llm.decontamination import decontaminate
from freightlens.llm.divergence import source_divergence
from freightlens.llm.exact_copies import exact_duplicates
from freightlens.llm.html_paths import extract_text
from freightlens.llm.importance import importance_sample
from freightlens.llm.near_duplicates import near_duplicates
from freightlens.llm.pseudo_likelihood import pseudo_likelihood
from freightlens.llm.quality_rules import quality_rules
from freightlens.llm.repeats import remove_repeats
from freightlens.llm.sentencepieces import round_trip
from freightlens.llm.statements import STATEMENTS
from freightlens.llm.token_counts import token_counts
from freightlens.llm.token_store import read_token_store, write_token_store
from freightlens.llm.warc import read_packages, write_packages

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Rows in an Arrow batch between Spark and Python: a few MB of whole texts.
BATCH_ROWS = 500


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_sentencepieces(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(_table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op4_token_store(spark: SparkSession, folder: str) -> DataFrame:
    written = write_token_store(_table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    return read_token_store(spark, written)


def op5_html_paths(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return read_packages(spark, write_packages(_table(spark, folder, "pages")))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), size=2)


def op9_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(_table(spark, folder, "documents"))


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance_sample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_table(spark, folder, "documents"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_sentencepieces, op4_token_store, op5_html_paths, op6_quality_rules, op7_warc,
                                  op8_near_duplicates, op9_pseudo_likelihood, op10_repeats, op11_importance, op12_exact_copies, op13_divergence)}
ORACLES = STATEMENTS
