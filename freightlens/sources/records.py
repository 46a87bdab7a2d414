"""Delimited text as whole records: quoted line breaks, faulty records, files of any size.

Spark's own multi-line mode reads a file in one task and lets one open quote swallow what
follows. Here files are read as lines, in splits, and lines are put together where the
number of quotes says so:

1. Lines land once, each with its place and whether it holds an odd number of quotes.
2. A split begins inside a quoted field if the splits of the file before it hold an odd
   number of such lines: a running sum over one row a split.
3. Splits without such lines hold a record a line and are parsed as they are. In the
   others a running count inside the split, over marks without their text, numbers the
   records of several lines; lines at its head that continue a record belong to the last
   one begun before. Only lines of such records are put together and shuffled.
4. A record of more than ``max_lines`` lines is an open quote, not a record. It, and any
   record that does not parse as a whole, is parsed line by line, so that a faulty line
   costs itself and at most the records of several lines up to the next line like it.

What still does not parse keeps its text in the column ``MALFORMED``; nothing is dropped but
each file's header and blank lines outside quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.operators.distributed import mark_rows
from freightlens.session import land

MALFORMED = "_malformed"
#: Lines that a record may have; more are parsed one by one.
MAX_LINES = 200
_BOM = "﻿"
#: A record whose quotes stand around whole fields.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_QUOTED_WELL = f"^{_FIELD}(?:,{_FIELD})*+$"


def _odd_quotes(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, mark, odd, line): ``mark`` orders the lines of a split."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("mark"), F.regexp_replace("value", f"^{_BOM}|\r$", "").alias("line"))
    return land(lines.withColumn("odd", _odd_quotes(F.col("line")).cast("int")), "lines")


def _splits(lines: DataFrame) -> DataFrame:
    """A row a split: first mark of the file, and lines with odd quotes in and before it."""
    splits = lines.groupBy("file", "split").agg(F.sum("odd").alias("n_odd"), F.min("mark").alias("first"))
    of_file = Window.partitionBy("file").orderBy("split")
    before = F.coalesce(F.sum("n_odd").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return splits.select("file", "split", (before % 2).alias("open"), ((before % 2 == 1) | (F.col("n_odd") > 0)).alias("tangled"),
                         F.first("first").over(of_file).alias("header"))


def _numbered(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of tangled splits: those that are a record each, and the others with the
    record they belong to: (file, at, no). Only the latter leave their place."""
    inside = Window.partitionBy("file", "split").orderBy("mark")
    odd_before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (F.col("open") + odd_before) % 2 == 0
    narrow = lines.select("file", "split", "mark", "odd", "open").withColumn("begins", begins).withColumn(
        "no", F.sum((F.col("begins") & (F.col("odd") == 1)).cast("int")).over(inside))
    several = land(narrow.where("NOT begins OR odd = 1").select("file", "split", "mark", "no"), "lines-of-several")
    begun = several.groupBy("file", "split").agg(F.max("no").alias("n")).withColumn("last", F.when(F.col("n") > 0, F.struct("split", "n")))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("file", "split", F.last("last", ignorenulls=True).over(earlier).alias("last"))
    own = F.col("no") > 0
    places = several.join(begun, ["file", "split"]).select(
        "file", F.when(own, F.col("split")).otherwise(F.col("last.split")).alias("at"), F.when(own, F.col("no")).otherwise(F.col("last.n")).alias("no"),
        "split", "mark")
    marked = mark_rows(lines.select("mark", "line", "is_header"), "mark", several, "_several")
    return marked.where("NOT _several"), places.join(marked.where("_several"), "mark")


def _stitched(lines: DataFrame, max_lines: int) -> DataFrame:
    """(lines, is_header): the lines of each record in order; those of a runaway one alone."""
    record = ["file", "at", "no"]
    runaway = lines.groupBy(*record).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_lines).drop("n")
    alone = lines.join(runaway, record, "left_semi").select(F.array("line").alias("lines"), "is_header")
    ordered = F.array_sort(F.collect_list(F.struct("split", "mark", "line")))
    whole = lines.join(runaway, record, "left_anti").groupBy(*record).agg(ordered.alias("all"), F.max("is_header").alias("is_header"))
    return alone.unionByName(whole.select(F.col("all.line").alias("lines"), "is_header"))


def read_records(spark: SparkSession, path: str, columns: list[str], header: bool = True, max_lines: int = MAX_LINES) -> DataFrame:
    """Comma-separated files as text columns and ``MALFORMED``.

    Quotes are doubled inside quoted fields. ``MALFORMED`` is NULL in a good row; otherwise
    it is the record's text, and the columns hold what could be read. A record with fewer or
    more fields than ``columns``, or with an open quote, is malformed. An empty field is
    NULL. Line breaks inside quotes are kept, as \\n. ``header``: the first record of a file is
    dropped. A folder without lines gives no rows.
    """
    lines = _lines(spark, path)
    splits = land(_splits(lines), "splits")
    lines = lines.join(splits, ["file", "split"]).withColumn(
        "is_header", (F.col("split") == 0) & (F.col("mark") == F.col("header")) & F.lit(header))
    records = lines.where("NOT tangled").select(F.array("line").alias("lines"), "is_header")
    if not splits.where("tangled").isEmpty():
        single, several = _numbered(lines.where("tangled"))
        records = records.unionByName(single.select(F.array("line").alias("lines"), "is_header")).unionByName(_stitched(several, max_lines))

    schema = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}

    def parsed(text: Column) -> Column:
        return F.from_csv(text, schema, options)

    whole = F.array_join("lines", "\n")
    one = (F.size("lines") == 1) | (whole.rlike(_QUOTED_WELL) & parsed(whole)[MALFORMED].isNull())
    texts = records.where("NOT is_header").select(F.explode(F.when(one, F.array(whole)).otherwise(F.col("lines"))).alias("text"))
    rows = texts.where("text <> ''").select("text", parsed(F.col("text")).alias("row"))
    fault = F.when(F.col(f"row.{MALFORMED}").isNotNull() | (_odd_quotes(F.col("text")) == 1), F.col("text"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], fault.alias(MALFORMED))
