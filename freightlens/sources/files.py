"""Reading and writing the toolkit's tables as files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.operators.staging import RAW_COLUMNS
from freightlens.session import path_exists
from freightlens.sources.records import read_records


def read_raw(spark: SparkSession, path: str, columns: list[str] = RAW_COLUMNS, header: bool = True) -> DataFrame:
    """Raw shipment CSV, every column text, no inference, and what is malformed.

    A leading BOM is dropped. Records may hold quoted line breaks; one that cannot be read
    is a row with its text in ``records.MALFORMED``, which staging rejects to the ledger.
    """
    return read_records(spark, path, columns, header)


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str,
               fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)


def read_folder(spark: SparkSession, folder: str, names: Iterable[str],
                fmt: str = "parquet") -> dict[str, DataFrame]:
    """A folder of files as a table set, one table per name."""
    suffix = {"parquet": ".parquet", "csv": ".csv"}[fmt]
    options = {"header": True} if fmt == "csv" else {}
    return {n: spark.read.format(fmt).options(**options).load(f"{folder}/{n}{suffix}")
            for n in names}


def folder_names(spark: SparkSession, folder: str, fmt: str = "parquet") -> list[str]:
    """Names of the tables that lie in a folder, on whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    names = [entry.getPath().getName() for entry in found]
    return sorted(n.removesuffix(f".{fmt}") for n in names if n.endswith(f".{fmt}"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of a table set."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()])


def coerce_dates(df: DataFrame) -> DataFrame:
    """Parse text columns named ``*_date`` or ``*_timestamp``; bad values become NULL."""
    def read(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return c
        if field.name.endswith("_date"):
            return F.to_date(F.try_to_timestamp(c)).alias(field.name)
        if field.name.endswith("_timestamp"):
            return F.try_to_timestamp(c).alias(field.name)
        return c

    return df.select(*[read(f) for f in df.schema.fields])


def first_rows(df: DataFrame, order_by: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in a stated order, for reviewers."""
    return df.orderBy(*order_by).limit(n)


def _canonical(field: T.StructField) -> Column:
    """A cell as text that does not depend on the engine: fractions as whole ten-thousandths."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
        c = F.round(c * 10_000, 0).cast("bigint")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(c.cast("string"), F.lit("~"))


def provenance(name: str, rows: DataFrame) -> DataFrame:
    """Name, row count and content fingerprint of a source.

    The fingerprint adds up 48 bits of every row's digest, so that it covers all files
    and no order of files or rows changes it.
    """
    text = F.concat_ws("|", *map(_canonical, rows.schema.fields))
    digest = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("row_count"),
                    F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("content_sum")).select(
        F.lit(name).alias("source_name"), "row_count", "content_sum")


def _content(df: DataFrame) -> list[Column]:
    """Row count and order-free content sum of a table, an empty text counted as missing."""
    text = F.concat_ws("|", *[F.coalesce(F.nullif(_canonical(f), F.lit("")), F.lit("~")) for f in df.schema.fields])
    digest = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("content_sum")]


_COMMIT = "commit_no long, version string, table_name string, format string, row_count long, content_sum string, columns string"


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_COMMIT).parquet(f"{folder}/_commits")


def write_layer(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """Full refresh of a layer, all tables or none: returns the new version.

    Every refresh writes a folder of its own, then appends one file to the layer's commit
    log; the newest commit is the layer. A refresh that is stopped leaves the old rows, and
    readers of an older version keep theirs. Row counts and content sums are observed while
    the rows are written and stand in the log, see :func:`check_layer`.
    """
    spark = next(iter(tables.values())).sparkSession
    version, log = uuid.uuid4().hex, []
    for name, df in tables.items():
        seen = Observation(f"{name}-{version}")
        writer = df.observe(seen, *_content(df)).write.mode("errorifexists")
        path = f"{folder}/{version}/{name}"
        writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)
        log.append((version, name, fmt, seen.get["row_count"], seen.get["content_sum"], df.schema.json()))
    number = (_newest(spark, folder) or (0,))[0] + 1
    spark.createDataFrame([(number, *row) for row in log], _COMMIT).coalesce(1).write.mode("append").parquet(f"{folder}/_commits")
    return version


def _newest(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Number and version of the newest commit; the log has a row a table and refresh."""
    if not path_exists(spark, f"{folder}/_commits"):
        return None
    row = _commits(spark, folder).agg(F.max(F.struct("commit_no", "version")).alias("at")).first()
    return (row["at"]["commit_no"], row["at"]["version"]) if row["at"] else None


def read_layer(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a layer as its newest commit (or ``version``) has them, typed."""
    if version is None:
        newest = _newest(spark, folder)
        if newest is None:
            raise FileNotFoundError(f"no committed layer in {folder}")
        version = newest[1]
    entries = _commits(spark, folder).filter(F.col("version") == version).collect()  # a row a table
    if not entries:
        raise FileNotFoundError(f"no version {version} in {folder}")
    return {e["table_name"]: read_typed(spark, f"{folder}/{version}/{e['table_name']}", T.StructType.fromJson(json.loads(e["columns"])),
                                        e["format"]) for e in entries}


def check_layer(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """(table_name, row_count, rows_found, identical): what was written against what lies there.

    A file that is gone, cut or changed shows, because the log's figures come from the rows
    as they were written and not from the files.
    """
    tables = read_layer(spark, folder, version)
    wanted = version or _newest(spark, folder)[1]
    log = _commits(spark, folder).filter(F.col("version") == wanted).select("table_name", "row_count", "content_sum")
    found = reduce(DataFrame.unionByName, [df.agg(*_content(df)).select(
        F.lit(n).alias("table_name"), F.col("row_count").alias("rows_found"), F.col("content_sum").alias("sum_found")) for n, df in tables.items()])
    same = (F.col("row_count") == F.col("rows_found")) & (F.col("content_sum") == F.col("sum_found"))
    return log.join(found, "table_name").select("table_name", "row_count", "rows_found", same.cast("int").alias("identical"))


def export_csv(marts: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write marts as CSV folders and return them as read back."""
    write_layer(marts, folder, "csv")
    return read_layer(next(iter(marts.values())).sparkSession, folder)


def parameterised(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL text with named parameters."""
    return spark.sql(sql, args=args)


def missing_inputs(tables: Iterable[str], available: Iterable[str]) -> list[str]:
    """Prerequisites that are not there."""
    have = set(available)
    return [t for t in tables if t not in have]


def lookup_tables(spark: SparkSession, settings) -> dict[str, DataFrame]:
    """The configuration as small tables, for tools that read tables only."""
    def pairs(mapping: dict, key: str, value: str, kind: str) -> DataFrame:
        rows = [(k, str(v)) for k, v in mapping.items()]
        return spark.createDataFrame(rows, f"{key} string, v string").select(
            key, F.col("v").cast(kind).alias(value))

    thresholds = {"absolute_variance_usd": settings.abs_threshold,
                  "variance_pct": float(settings.pct_threshold) * 100}
    return {
        "meta_dq_severity_weight": pairs(settings.severity_weights, "severity", "weight",
                                         "decimal(6,2)"),
        "meta_accessorial_band": pairs(settings.accessorial_bands, "charge_type",
                                       "max_allowed", "decimal(12,2)"),
        "meta_audit_threshold": pairs(thresholds, "threshold_name", "threshold_value",
                                      "decimal(12,2)"),
        "meta_scorecard_weight": pairs(settings.score_weights, "metric_name", "weight",
                                       "double"),
        "meta_run_context": pairs({"as_of_date": settings.as_of.isoformat()}, "context_key",
                                  "context_value", "string"),
    }


def write_raw(raw: DataFrame, path: str) -> None:
    """All-text CSV with a byte-order mark, the form raw files arrive in."""
    first, *others = raw.columns
    marked = raw.select(F.col(f"`{first}`").alias(f"\ufeff{first}"), *[F.col(f"`{c}`") for c in others])
    marked.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


#: Lines of a compressed file: one task reads it whole.
LINES_PER_FILE = 250_000


def write_lines(lines: DataFrame, path: str, by: str, most: int = LINES_PER_FILE) -> None:
    """Lines as text files in a folder a value of ``by``. They are compressed, which no reader can
    split: a file of at most ``most`` lines is a task's share instead."""
    lines.write.partitionBy(by).options(compression="lz4", maxRecordsPerFile=most).text(path)
