"""Queries behind the dashboards: recent periods, top lists, distributions, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """The ``n`` most recent periods in ascending order."""
    return df.orderBy(F.desc(period)).limit(n).orderBy(period)


def top_overdue(fact_shipment: DataFrame, n: int = 5) -> DataFrame:
    return (fact_shipment.filter("overdue_git_flag = 1")
            .select("shipment_id", "carrier_id", "lane_id", "git_age_days",
                    "shipment_value_usd")
            .orderBy(F.desc("shipment_value_usd"), "shipment_id").limit(n))


def distribution(df: DataFrame, column: str, into: str) -> DataFrame:
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(into))
            .orderBy(F.desc(into), column))


def top_manifest_types(performance: DataFrame, n: int = 9) -> DataFrame:
    return (performance.filter("manifest_count > 0")
            .orderBy(F.desc("manifest_count"), "exception_type").limit(n))


def exposure_waterfall(recoverable: DataFrame) -> DataFrame:
    """Exposure components with the running total they step up to, and the total."""
    parts = [("Overcharge", "overcharge_recoverable"), ("Duplicate", "duplicate_invoice_exposure"),
             ("Accessorial", "accessorial_recoverable")]
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("component"),
                               F.col(c).alias("amount")) for i, (n, c) in enumerate(parts)])
    order = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = recoverable.select(F.explode(steps).alias("s")).select("s.*")
    return rows.withColumn("running_total", F.round(F.sum("amount").over(order), 2))


def reconciliation_ledger(shown: DataFrame, recomputed: DataFrame) -> DataFrame:
    """(metric, shown, recomputed, match) for two long-form metric tables."""
    a = shown.select("metric", F.col("value").alias("displayed_value"))
    b = recomputed.select("metric", F.col("value").alias("source_value"))
    close = F.abs(F.col("displayed_value") - F.col("source_value")) < 0.005
    return a.join(b, "metric", "full").select(
        "metric", "displayed_value", "source_value",
        F.when(close, "PASS").otherwise("FAIL").alias("match"))


def long_form(row: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A one-row table as (metric, value); ``columns`` maps metric to column."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
             for m, c in columns.items()]
    return row.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def most_flagged_lane(lane_score: DataFrame) -> DataFrame:
    flags = ["high_cost_flag", "low_service_flag", "high_variance_flag",
             "high_accessorial_flag"]
    total = reduce(lambda a, b: a + b, [F.col(c) for c in flags])
    return (lane_score.filter("insufficient_volume_flag = 0").withColumn("flag_count", total)
            .orderBy(F.desc("flag_count"), F.desc("shipment_count"), "lane_id").limit(1)
            .select("lane_id", "flag_count", "shipment_count", "service_classification"))
