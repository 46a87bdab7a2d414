"""Deterministic sampling, table differences and cascading deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.expr import hash48, lookup
from freightlens.operators.distributed import order_statistic
from freightlens.session import land


def sample_size(rate: float, eligible: Column) -> Column:
    """``rate`` of the eligible rows: at least one when any, never more than all."""
    wanted = F.round(eligible.cast("double") * rate, 0).cast("bigint")
    floor = F.least(F.lit(1 if rate > 0 else 0), eligible)
    return F.least(eligible, F.greatest(floor, wanted)).cast("bigint")


def hash_sample(ids: DataFrame, id_column: str, salt: str, rate: float,
                seed: int) -> DataFrame:
    """Exactly ``sample_size`` ids, the ones with the smallest (hash, id).

    The cut-off hash is found as an order statistic, so the sample is a plain
    filter; only ids that share the cut-off hash itself are ranked.
    """
    pool = ids.select(id_column).distinct().withColumn(
        "_h", hash48(seed, salt, F.col(id_column)))
    counts = land(pool.groupBy("_h").agg(F.count(F.lit(1)).alias("_w")), "hashes")
    target = counts.agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("_n")).select(
        F.lit("cut").alias("_slot"), sample_size(rate, F.col("_n")).alias("_rank"))
    cut = land(order_statistic(counts, [], "_h", "_w", target, "_slot", "_rank")
               .withColumn("_rank", target.select("_rank").scalar()), "cut")
    edge = cut.select("value").scalar()
    below = pool.filter(F.col("_h") < edge).select(id_column)
    ties = pool.filter(F.col("_h") == edge).withColumn(
        "_no", F.row_number().over(Window.partitionBy("_h").orderBy(id_column)))
    spare = cut.select(F.col("_rank") - F.col("below")).scalar()
    return below.unionByName(ties.filter(F.col("_no") <= spare).select(id_column))


def disjoint_samples(ids: DataFrame, id_column: str, plan: dict[str, float],
                     seed: int) -> DataFrame:
    """One hash sample per type, none sharing a record with an earlier one.

    Sizes are rates of the whole pool, as the pool stood before any pick.
    """
    left = land(ids.select(id_column).distinct(), "pool")
    size = left.count()
    parts = []
    for kind, rate in plan.items():
        remaining = left
        for taken in parts:
            remaining = remaining.join(taken.select(id_column), id_column, "left_anti")
        left_over = remaining.count()
        if not left_over:
            break
        # Re-express the rate against what remains, so that the count is the same.
        share = min(1.0, round(rate * size) / left_over) if rate else 0.0
        share = max(share, 1 / left_over) if rate else share
        pick = hash_sample(remaining, id_column, kind, share, seed)
        parts.append(land(pick.withColumn("exception_type", F.lit(kind)), "sample"))
    return reduce(DataFrame.unionByName, parts)


def _leaf(key: str) -> Column:
    """Bucket of a row: the first sixteen bits of its key's md5, the same in any engine."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("~"))), 1, 4), 16, 10).cast("int")


def bucket_fingerprints(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(leaf, row_count, content) of a table's buckets: rows and the sum of row hashes.

    Combined in every task, so that at most 65,536 rows a task travel, whatever the table's
    size.
    """
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in [key, *columns]]).cast("decimal(38,0)")
    return df.groupBy(_leaf(key).alias("leaf")).agg(F.count(F.lit(1)).alias("row_count"), F.sum(digest).alias("content"))


def unequal_buckets(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(bucket, left_rows, right_rows) of the buckets in which two tables differ.

    Only fingerprints travel and are compared, never rows.
    """
    side = lambda df, name: bucket_fingerprints(df, key, columns).select(
        F.col("leaf").alias("bucket"), F.struct("row_count", "content").alias(name))
    rows = lambda name: F.coalesce(f"{name}.row_count", F.lit(0))
    both = side(before, "l").join(side(after, "r"), "bucket", "full").filter("NOT l <=> r")
    return both.select("bucket", rows("l").alias("left_rows"), rows("r").alias("right_rows"))


def table_diff(before: DataFrame, after: DataFrame, key: str,
               columns: list[str]) -> DataFrame:
    """Cell-level changes between two versions of a table.

    A row only in ``after`` is INSERTED, one only in ``before`` DELETED; otherwise
    every differing cell is one UPDATED row. NULL equals NULL. Only rows of buckets whose
    fingerprints differ are joined: of two equal tables no row moves.
    """
    unequal = land(unequal_buckets(before, after, key, columns).select(F.col("bucket").alias("_bucket")), "unequal-buckets")
    before, after = (df.join(unequal, _leaf(key) == F.col("_bucket"), "left_semi") for df in (before, after))
    b = before.select(F.col(key).alias("_bk"), *[F.col(c).alias(f"b_{c}") for c in columns])
    a = after.select(F.col(key).alias("_ak"), *[F.col(c).alias(f"a_{c}") for c in columns])
    both = b.join(a, F.col("_bk") == F.col("_ak"), "full")
    none = F.lit(None).cast("string")

    def change(kind: str, column: Column, old: Column, new: Column) -> Column:
        return F.struct(F.lit(kind).alias("change"), column.alias("column_name"),
                        old.cast("string").alias("clean_value"),
                        new.cast("string").alias("new_value"))

    marks = [F.when(F.col("_bk").isNull(), change("INSERTED", F.lit(key), none, F.col("_ak"))),
             F.when(F.col("_ak").isNull(), change("DELETED", F.lit(key), F.col("_bk"), none))]
    paired = F.col("_bk").isNotNull() & F.col("_ak").isNotNull()
    marks += [F.when(paired & ~F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}")),
                     change("UPDATED", F.lit(c), F.col(f"b_{c}"), F.col(f"a_{c}")))
              for c in columns]
    return both.select(
        F.coalesce("_bk", "_ak").cast("string").alias("record_id"),
        F.explode(F.array_compact(F.array(*marks))).alias("m")).select("record_id", "m.*")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change", "column_name").agg(
        F.count(F.lit(1)).alias("cells"), F.countDistinct("record_id").alias("records"))


def sample_summary(manifest: DataFrame, pools: dict[str, DataFrame],
                   pool_of: dict[str, str], rates: dict[str, float]) -> DataFrame:
    """Per configured type: eligible rows of its pool, rate, expected and actual faults.

    A type without faults has an actual count of 0.
    """
    sizes = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("eligible_records")).select(F.lit(name).alias("_pool"), "eligible_records")
        for name, df in pools.items()])
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("exception_type"), F.lit(float(rates[k])).alias("configured_rate"))
                                for k, p in pool_of.items() if k in rates]))
    plan = sizes.select("_pool", "eligible_records", kinds.alias("k")).select("_pool", "eligible_records", "k.*")
    plan = plan.filter(F.col("_pool") == lookup(pool_of, F.col("exception_type")))
    wanted = F.round(F.col("eligible_records").cast("double") * F.col("configured_rate"), 0).cast("bigint")
    least = F.when(F.col("configured_rate") > 0, F.least(F.lit(1), F.col("eligible_records"))).otherwise(0)
    actual = manifest.groupBy("exception_type").agg(F.count(F.lit(1)).alias("_n"))
    return plan.join(actual, "exception_type", "left").select(
        "exception_type", "eligible_records", "configured_rate",
        F.least(F.col("eligible_records"), F.greatest(least, wanted)).cast("bigint").alias("expected_count"),
        F.coalesce("_n", F.lit(0)).alias("actual_count"))


def cascade_delete(removed: DataFrame, key: str,
                   children: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Child tables without the rows of removed parents."""
    gone = removed.select(key).filter(F.col(key).isNotNull()).distinct()
    return {name: df.join(gone, key, "left_anti") for name, df in children.items()}


def last_in_group(df: DataFrame, group: str, sequence: str, row_id: str) -> DataFrame:
    """The row with the highest sequence per group (the highest id on a tie)."""
    top = df.groupBy(group).agg(F.max(F.struct(sequence, row_id)).alias("_t"))
    return top.select(group, F.col(f"_t.{sequence}").alias(sequence),
                      F.col(f"_t.{row_id}").alias(row_id))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of a table: row count and sum of row hashes."""
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0))
                  .cast("string").alias("hash_sum"))


def same_table(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two tables and whether their fingerprints agree."""
    a = fingerprint(left).select(F.struct("row_count", "hash_sum").alias("x"))
    b = fingerprint(right).select(F.struct("row_count", "hash_sum").alias("x")).scalar()
    return a.select("x", b.alias("y")).select(
        F.col("x.row_count").alias("left_rows"), F.col("y.row_count").alias("right_rows"),
        (F.col("x") == F.col("y")).cast("int").alias("identical"))

