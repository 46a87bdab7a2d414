"""Exact order-dependent work without a one-task sort.

Dense numbering, order statistics and modal values are the places where a plan
is tempted to gather a whole group in one task. The operators here keep every
window bounded (histogram digits, a row a partition, the rows of one) and leave the rest
to aggregations that combine before the shuffle. Wide rows are marked by bitmaps of their
row numbers, so that what is found out about their keys does not move them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.session import land

#: Bitmaps (4 KB, 32,768 row numbers each) that are broadcast; beyond them rows are shuffled.
BROADCAST_BITMAPS = 32_768

_DIGIT_BITS = 16
_DIGIT_MASK = (1 << _DIGIT_BITS) - 1


def number_rows(df: DataFrame, order_by: list, into: str = "row_no") -> DataFrame:
    """Add 1, 2, 3, ... in the order of ``order_by`` over the whole table.

    The table is range-partitioned and sorted, landed once with each row's
    position inside its partition, and shifted by the running total of partition
    sizes: one row per partition is all that is ever gathered.
    """
    tagged = (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
              .withColumn("_mark", F.monotonically_increasing_id()))
    landed = land(tagged, "numbered")
    # monotonically_increasing_id keeps the partition in the bits above 33.
    part = F.shiftright("_mark", 33)
    sizes = landed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0))
                          .alias("_start"))
    at = F.col("_mark") - F.shiftleft(F.shiftright("_mark", 33), 33)
    return (landed.withColumn("_part", part).join(starts, "_part")
            .withColumn(into, F.col("_start") + at + 1)
            .drop("_part", "_start", "_mark"))


def mark_rows(df: DataFrame, row: str, chosen: DataFrame, into: str) -> DataFrame:
    """Add the BOOLEAN ``into``: whether a row's number ``row`` is one of ``chosen``.

    Numbers are whole, not negative and best close together, as those of
    ``monotonically_increasing_id`` are inside a partition. ``chosen`` (any column ``row``)
    becomes a bit a row in bitmaps, which are landed and meet ``df`` where it is.
    """
    place = F.col(row) + 1  # buckets count from 1
    bitmaps = land(chosen.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
                   .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmaps")
    if bitmaps.count() <= BROADCAST_BITMAPS:
        bitmaps = F.broadcast(bitmaps)
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(place)).join(bitmaps, "_bucket", "left")
    return joined.withColumn(into, F.coalesce(bit, F.lit(False))).select(*df.columns, into)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that grows with the input, whatever its files weigh.

    Spark takes a table's size from its compressed files. The hash table that a driver makes of a
    few narrow columns to broadcast them has been fifty times as large.
    """
    return df.hint("merge")


def modal_value(df: DataFrame, keys: list[str], value: str, into: str) -> DataFrame:
    """Most frequent non-null ``value`` per key; the lowest one on a tie."""
    counted = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
               .agg(F.count(F.lit(1)).alias("_n")))
    best = counted.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("_n"), F.col(value).alias("_v"))).alias("_best"))
    return best.select(*keys, F.col("_best._v").alias(into))


def _digit(column: Column, level: int, levels: int) -> Column:
    shift = _DIGIT_BITS * (levels - 1 - level)
    moved = F.shiftright(column, shift) if shift else column
    return moved if level == 0 else moved.bitwiseAND(F.lit(_DIGIT_MASK).cast("bigint"))


def _prefix(column: Column, level: int, levels: int) -> Column:
    shift = _DIGIT_BITS * (levels - 1 - level)
    return F.shiftright(column, shift) if shift else column


def order_statistic(counts: DataFrame, keys: list[str], value: str, weight: str,
                    targets: DataFrame, slot: str, rank: str, levels: int = 3) -> DataFrame:
    """The ``rank``-th smallest BIGINT ``value`` per key, for each target slot.

    ``counts`` holds (keys, value, weight) with weight the multiplicity;
    ``targets`` holds (keys, slot, rank), ranks starting at 1, a few slots per
    key. The answer is found digit by digit, 16 bits at a time: a histogram per
    (key, prefix) has at most 65,536 cells, so a key that owns a third of all
    rows costs no more than any other. Returns (keys, slot, value, below) where
    ``below`` is the number of rows strictly smaller than the value.
    """
    found = targets.select(*keys, slot, F.col(rank).alias("_left"),
                           F.lit(0).cast("bigint").alias("_below"),
                           F.lit(None).cast("bigint").alias("_pre"))
    for level in range(levels):
        cells = counts.select(*keys, F.col(weight).alias("_w"),
                              _digit(F.col(value), level, levels).alias("_d"),
                              *([_prefix(F.col(value), level - 1, levels).alias("_pre")]
                                if level else []))
        scope = keys + (["_pre"] if level else [])
        if level:
            wanted = found.select(*scope).distinct()
            cells = cells.join(wanted, scope, "left_semi")
        hist = cells.groupBy(*scope, "_d").agg(F.sum("_w").alias("_w"))
        win = (Window.partitionBy(*scope) if scope else Window.partitionBy(F.lit(0))).orderBy("_d")
        hist = hist.withColumn("_upto", F.sum("_w").over(
            win.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        f, h = found.alias("f"), hist.alias("h")
        on = [F.col(f"f.{c}") == F.col(f"h.{c}") for c in scope]
        on += [F.col("f._left") <= F.col("h._upto"),
               F.col("f._left") > F.col("h._upto") - F.col("h._w")]
        lower = F.col("h._upto") - F.col("h._w")
        pre = (F.col("h._d") if level == 0
               else F.shiftleft(F.col("f._pre"), _DIGIT_BITS).bitwiseOR(F.col("h._d")))
        if not scope:
            # One global group: the histogram is joined on a constant key.
            f = found.withColumn("_one", F.lit(1)).alias("f")
            h = hist.withColumn("_one", F.lit(1)).alias("h")
            on = [F.col("f._one") == F.col("h._one"), *on]
        found = f.join(h, on).select(
            *[F.col(f"f.{c}") for c in keys], F.col(f"f.{slot}"),
            (F.col("f._left") - lower).alias("_left"),
            (F.col("f._below") + lower).alias("_below"), pre.alias("_pre"))
    return found.select(*keys, slot, F.col("_pre").alias("value"), F.col("_below").alias("below"))


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, into: str) -> DataFrame:
    """Exact interpolated quantile of a number, per key; NULLs are ignored.

    Linear interpolation between the two neighbouring order statistics, DOUBLEs as they
    are: no digit is rounded away. The distinct values of all keys are counted, sorted over
    range partitions and landed once. Sums of a partition's part of a key say which
    partition holds a rank, and only there is counted value by value, so that a key that
    owns a third of all rows is spread like any other. Several numbers of a table are best
    asked at once, see :func:`measured`.
    """
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_w")))
    order = [*keys, "_v"]
    landed = land(counts.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_mark", F.monotonically_increasing_id()), "quantile-counts")
    # monotonically_increasing_id keeps the partition in the bits above 33.
    landed = landed.withColumn("_part", F.shiftright("_mark", 33))
    own = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("_size").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    pieces = (landed.groupBy(*keys, "_part").agg(F.sum("_w").alias("_size"))
              .withColumn("_before", before).withColumn("_n", F.sum("_size").over(own)))
    spot = (F.col("_n") - 1).cast("double") * q
    low = F.floor(spot).cast("bigint") + 1
    pieces = pieces.withColumns({"_lo": low, "_hi": F.least(low + 1, F.col("_n")), "_share": spot - F.floor(spot)})

    def inside(rank: str, start: Column, size: str) -> Column:
        return (F.col(rank) > start) & (F.col(rank) <= start + F.col(size))

    pieces = pieces.filter(inside("_lo", F.col("_before"), "_size") | inside("_hi", F.col("_before"), "_size"))
    along = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cells = landed.join(pieces, [*keys, "_part"]).withColumn("_start", F.col("_before") + F.sum("_w").over(along) - F.col("_w"))
    at = {end: F.max(F.when(inside(end, F.col("_start"), "_w"), F.col("_v"))) for end in ("_lo", "_hi")}
    return cells.groupBy(*keys).agg((at["_lo"] + (at["_hi"] - at["_lo"]) * F.max("_share")).alias(into))


def measured(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """(keys, metric, x): the named columns one below the other."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("x")) for n, c in columns.items()]))
    return df.select(*keys, cells.alias("_cell")).select(*keys, "_cell.metric", "_cell.x")


def by_metric(df: DataFrame, keys: list[str], value: str, metrics: list[str]) -> DataFrame:
    """A row a key again, with a column of the metric's name for each."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, F.col(value))).alias(m) for m in metrics])


_SEQ_BLOCK = 4096


def _block(sequence: str, block: int) -> Column:
    return F.floor(F.col(sequence) / block)


def _ordered(df: DataFrame, group: str, sequence: str) -> DataFrame:
    """Rows without a group or sequence belong to no order."""
    return df.filter(F.col(group).isNotNull() & F.col(sequence).isNotNull())


def _steps(df: DataFrame, group: str, sequence: str, value: str, block: int, *more: Column) -> DataFrame:
    """The highest value of each (group, sequence) and the block its sequence falls in."""
    steps = _ordered(df, group, sequence).groupBy(group, sequence).agg(F.max(value).alias("_v"), *more)
    return steps.withColumn("_block", _block(sequence, block))


def _prior(df: DataFrame, group: str, sequence: str, value: str, into: str, block: int) -> DataFrame:
    """(group, sequence, ``into``, _low): the highest value before each step, and its own lowest.

    Rows are reduced to one per (group, sequence); a running maximum inside blocks of
    sequences is combined with the one over blocks, so that no window holds more than a block
    or a row per block. Blocks are reduced where their rows are read, and only those with
    another block of their group before them meet their steps.
    """
    steps = _steps(df, group, sequence, value, block, F.min(value).alias("_low"))
    inside = (Window.partitionBy(group, "_block").orderBy(sequence)
              .rowsBetween(Window.unboundedPreceding, -1))
    across = (Window.partitionBy(group).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    tops = (_ordered(df, group, sequence).groupBy(group, _block(sequence, block).alias("_block"))
            .agg(F.max(value).alias("_top")))
    tops = tops.select(group, "_block", F.max("_top").over(across).alias("_before"))
    return (steps.withColumn("_inside", F.max("_v").over(inside))
            .join(tops.filter(F.col("_before").isNotNull()), [group, "_block"], "left")
            .select(group, sequence, F.greatest("_inside", "_before").alias(into), "_low"))


def prior_max(df: DataFrame, group: str, sequence: str, value: str, into: str,
              block: int = _SEQ_BLOCK) -> DataFrame:
    """Add the highest ``value`` at any lower (integer) ``sequence`` of the group; NULL for
    rows without a group or sequence."""
    prior = _prior(df, group, sequence, value, into, block).drop("_low")
    return df.join(prior, [group, sequence], "left")


def behind(df: DataFrame, group: str, sequence: str, value: str,
           block: int = _SEQ_BLOCK) -> DataFrame:
    """The rows whose ``value`` is below the highest at any lower ``sequence`` of their group.

    Only the steps that have such a row meet the rows again.
    """
    prior = _prior(df, group, sequence, value, "_prior", block).filter("_low < _prior")
    rows = df.join(prior.drop("_low"), [group, sequence])
    return rows.filter(F.col(value) < F.col("_prior")).select(*df.columns)


def previous_value(df: DataFrame, group: str, sequence: str, value: str, into: str,
                   block: int = _SEQ_BLOCK) -> DataFrame:
    """Add the highest ``value`` at the next lower sequence of the group; NULL for rows
    without a group or sequence. Cut into blocks as above."""
    steps = _steps(df, group, sequence, value, block)
    lasts = steps.groupBy(group, "_block").agg(F.max_by("_v", sequence).alias("_last"))
    across = Window.partitionBy(group).orderBy("_block")
    lasts = lasts.select(group, "_block", F.lag("_last").over(across).alias("_carry"))
    inside = Window.partitionBy(group, "_block").orderBy(sequence)
    first = F.row_number().over(inside) == 1
    previous = steps.join(lasts, [group, "_block"]).select(
        group, sequence, F.when(first, F.col("_carry")).otherwise(F.lag("_v").over(inside))
        .alias(into))
    return df.join(previous, [group, sequence], "left")


def dense_competition_rank(df: DataFrame, score: str, into: str, scale: int = 2) -> DataFrame:
    """Min-rank (1 = best) of a bounded fixed-point score; NULL scores stay unranked.

    Ranks come from the histogram of scores, whose size is bounded by the score
    range, never by the number of rows.
    """
    key = F.round(F.col(score) * 10 ** scale, 0).cast("bigint")
    cells = (df.filter(F.col(score).isNotNull()).groupBy(key.alias("_cell"))
             .agg(F.count(F.lit(1)).alias("_n")))
    better = Window.orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = cells.select("_cell", (F.coalesce(F.sum("_n").over(better), F.lit(0)) + 1)
                         .cast("bigint").alias(into))
    return df.withColumn("_cell", key).join(ranks, "_cell", "left").drop("_cell")
