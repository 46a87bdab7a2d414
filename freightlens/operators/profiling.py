"""Profiling an all-text table: types, missing share, distinct and top values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.expr import count_if, number, parse_short_date
from freightlens.operators.staging import TARGETS
from freightlens.session import land


def value_counts(raw: DataFrame) -> DataFrame:
    """(column_name, value, n) over every column of a text table."""
    cells = raw.unpivot([], raw.columns, "column_name", "value")
    return cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(raw: DataFrame, top: int = 3) -> DataFrame:
    """One row per column of a text table.

    The value counts are read twice, so they are landed once. Types are read off the distinct values. The top values come from a ranked
    filter that Spark also applies before the shuffle, so a column of unique ids
    does not travel.
    """
    counts = land(value_counts(raw), "value-counts")
    value = F.col("value")
    num, day = number(value), parse_short_date(value)
    filled = value.isNotNull()
    stats = counts.groupBy("column_name").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0))
        .alias("missing"),
        count_if(filled).alias("distinct_values"), count_if(num.isNotNull()).alias("numbers"),
        count_if(num % 1 == 0).alias("whole"), count_if(day.isNotNull()).alias("days"))
    d = F.col("distinct_values")
    kind = (F.when(d == 0, "unknown")
            .when((F.col("numbers") == d) & (F.col("whole") == d), "integer")
            .when(F.col("numbers") == d, "numeric")
            .when(F.col("numbers") > 0, "mixed (numeric + text sentinels)")
            .when(F.col("days") == d, "date (%d-%b-%y)")
            .when(F.col("days") > 0, "mixed (date + text sentinels)").otherwise("text"))
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = (counts.filter(filled).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top))
    shown = best.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct(
        "rank", F.format_string("%s (%d)", "value", "n").alias("text")))).alias("tops"))
    targets: dict[str, list[str]] = {}
    for t in TARGETS:
        for source in t.source.split(" + "):
            targets.setdefault(source, []).append(t.name)
    mapped = F.create_map(*[F.lit(x) for s, names in targets.items()
                            for x in (s, ", ".join(names))])
    return stats.join(shown, "column_name", "left").select(
        "column_name", kind.alias("inferred_type"),
        F.round(F.col("missing") * 100.0 / F.col("total"), 2).alias("missing_pct"),
        "distinct_values",
        F.coalesce(F.concat_ws("; ", F.col("tops.text")), F.lit("")).alias("top_values"),
        F.coalesce(F.try_element_at(mapped, F.col("column_name")), F.lit("(not modeled)"))
        .alias("target_model_column"))
