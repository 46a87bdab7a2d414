"""Effective-dated join: the version of a record that was valid on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.session import land

#: Levels of the halving of a key's elementary intervals: enough for 2 ** 40 of them.
_LEVELS = 40


def _halved(number: Column, level: Column, up: bool) -> Column:
    """``number`` divided by 2 ** level, rounded down or up."""
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    lower = F.call_function("shiftright", number, level)
    return lower + ((lower * step) < number).cast("bigint") if up else lower


def timeline(versions: DataFrame, keys: list[str], start: str, end: str,
             version_id: str) -> DataFrame:
    """Disjoint windows with the version that holds in each: the latest start, then the
    highest id.

    The borders of a key's windows cut its days into elementary intervals. A window
    covers a run of them, which is a few nodes (two a level) of a halving of all; a node
    keeps its best version, and an interval takes the best of the nodes above it. So n
    versions make at most 2 n intervals and n log n rows, however they are nested.
    """
    others = [c for c in versions.columns if c not in (*keys, start, end, version_id)]
    payload = F.struct(F.col(version_id).alias("_vid"), *[F.col(c) for c in others])
    unique = (versions.dropna(subset=[*keys, start, end]).filter(F.col(start) <= F.col(end))
              .groupBy(*keys, start, end).agg(F.max(payload).alias("_p")))
    borders = unique.select(*keys, F.explode(F.array(start, F.date_add(end, 1))).alias("_at")).distinct()
    order = Window.partitionBy(*keys).orderBy("_at")
    cells = borders.withColumn("_cell", F.row_number().over(order).cast("bigint") - 1).withColumn(
        "_until", F.date_sub(F.lead("_at").over(order), 1))
    low = cells.select(*keys, F.col("_at").alias(start), F.col("_cell").alias("_low"))
    high = cells.select(*keys, F.date_sub("_at", 1).alias(end), F.col("_cell").alias("_high"))
    runs = unique.join(low, [*keys, start]).join(high, [*keys, end])
    level = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS))).alias("_level")
    left, right = _halved(F.col("_low"), F.col("_level"), True), _halved(F.col("_high"), F.col("_level"), False)
    nodes = runs.select("*", level).filter(left < right).select("*", F.explode(F.array_compact(F.array(
        F.when(left % 2 == 1, left), F.when(right % 2 == 1, right - 1)))).alias("_node"))
    best = nodes.groupBy(*keys, "_level", "_node").agg(
        F.max(F.struct(F.col(start).alias("_s"), F.col("_p._vid").alias("_vid"), "_p", F.col(end).alias("_e"))).alias("_best"))
    tops = best.groupBy(*keys).agg(F.max("_level").alias("_top"))
    spots = cells.filter(F.col("_until").isNotNull()).join(tops, keys).select(
        *keys, "_cell", "_at", "_until", F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("_level"))
    spots = spots.withColumn("_node", _halved(F.col("_cell"), F.col("_level"), False))
    held = spots.join(best, [*keys, "_level", "_node"]).groupBy(*keys, "_at", "_until").agg(F.max("_best").alias("_best"))
    return held.select(*keys, F.col("_at").alias("_from"), "_until", F.col("_best._s").alias(start), F.col("_best._e").alias(end),
                       F.col("_best._vid").alias(version_id), *[F.col(f"_best._p.{c}").alias(c) for c in others])


def effective_join(facts: DataFrame, versions: DataFrame, keys: list[str], day: str,
                   start: str, end: str, version_id: str) -> DataFrame:
    """``facts`` left-joined to the one version valid on ``facts.day``, per key.

    The latest start wins, then the highest id; at most one version matches a
    fact, so the result keeps the grain of ``facts``. ``has_version`` tells whether
    the key has any version at all. The timeline is dimension-sized and is landed
    first, so that Spark plans the join knowing its real size.
    """
    line = land(timeline(versions, keys, start, end, version_id), "timeline")
    others = [c for c in versions.columns if c not in keys]
    known = versions.dropna(subset=keys).select(*keys).distinct().withColumn("_known", F.lit(True))
    left = facts.join(known, keys, "left").withColumn("has_version", F.coalesce("_known", F.lit(False)))
    f, v = left.alias("f"), line.alias("v")
    on = [F.col(f"f.{k}") == F.col(f"v.{k}") for k in keys]
    on.append(F.col(f"f.{day}").between(F.col("v._from"), F.col("v._until")))
    return f.join(v, on, "left").select(
        *[F.col(f"f.{c}") for c in facts.columns], "f.has_version",
        *[F.col(f"v.{c}") for c in others])
