"""Delivery-service KPIs over the shipment analytics base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.expr import (
    bucket, count_if, mean, money_sum, money_sum_if, pct, pct_of_flag,
)


def _delivered(base: DataFrame) -> DataFrame:
    return base.filter(F.col("is_delivered") == 1)


def _moving(base: DataFrame) -> DataFrame:
    return base.filter(F.col("git_flag") == 1)


def _otif_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("shipment_count"),
        F.sum("is_delivered").alias("delivered_count"),
        F.sum("git_flag").alias("in_transit_count"),
        pct_of_flag("otif_flag").alias("otif_pct"),
        pct_of_flag("on_time_flag").alias("on_time_pct"),
        pct_of_flag("in_full_flag").alias("in_full_pct"),
        F.sum("late_flag").alias("late_shipment_count"),
        F.sum("partial_flag").alias("partial_shipment_count"),
        mean("delay_days").alias("avg_delay_days")]


def otif_summary(base: DataFrame) -> DataFrame:
    return base.agg(*_otif_columns())


_OTIF_PARTS = {
    "on_time": lambda: pct_of_flag("on_time_flag").alias("on_time_pct"),
    "in_full": lambda: pct_of_flag("in_full_flag").alias("in_full_pct"),
    "delay": lambda: mean("delay_days").alias("avg_delay_days"),
    "late": lambda: F.sum("late_flag").alias("late_count"),
}


def otif_by(base: DataFrame, keys: list[str], parts: tuple[str, ...] = ()) -> DataFrame:
    """Delivered count and OTIF share by ``keys``, plus the optional ``parts``.

    A NULL key is a group of its own.
    """
    return _delivered(base).groupBy(*keys).agg(
        F.sum("is_delivered").alias("delivered_count"),
        pct_of_flag("otif_flag").alias("otif_pct"),
        *[_OTIF_PARTS[p]() for p in parts])


def _git_columns(of: str = "") -> list[Column]:
    """Over rows in transit; or over all, with the others' values NULL in a struct ``of``."""
    return [
        F.count(f"{of}git_flag").alias("git_shipment_count"),
        money_sum(f"{of}shipment_value_usd").alias("git_value_usd"),
        money_sum(f"{of}shipment_weight_kg").alias("git_weight_kg"),
        mean(f"{of}git_age_days", 1).alias("avg_git_age_days"),
        F.sum(f"{of}overdue_git_flag").alias("overdue_git_count"),
        money_sum_if(F.col(f"{of}overdue_git_flag") == 1, f"{of}shipment_value_usd")
        .alias("overdue_git_value_usd")]


_GIT_INPUTS = ["git_flag", "shipment_value_usd", "shipment_weight_kg", "git_age_days", "overdue_git_flag"]


def git_summary(base: DataFrame) -> DataFrame:
    return _moving(base).agg(*_git_columns())


def git_aging(base: DataFrame, bounds: list[int]) -> DataFrame:
    return (_moving(base)
            .groupBy(bucket(F.col("git_age_days"), bounds).alias("aging_bucket"))
            .agg(F.count(F.lit(1)).alias("git_count"),
                 money_sum("shipment_value_usd").alias("git_value_usd")))


def git_by_carrier(base: DataFrame) -> DataFrame:
    return _moving(base).groupBy("carrier_id", "carrier_name").agg(
        F.count(F.lit(1)).alias("git_count"),
        money_sum("shipment_value_usd").alias("git_value_usd"),
        mean("git_age_days", 1).alias("avg_age_days"))


def transit_by_mode(base: DataFrame) -> DataFrame:
    return _delivered(base).groupBy("shipment_mode").agg(
        F.count(F.lit(1)).alias("delivered_count"),
        mean("planned_transit_days", 1).alias("avg_planned_transit_days"),
        mean("actual_transit_days", 1).alias("avg_actual_transit_days"),
        mean("transit_variance_days", 1).alias("avg_transit_variance_days"),
        pct_of_flag("within_standard_flag", 1).alias("within_standard_pct"))


def transit_by_lane(base: DataFrame) -> DataFrame:
    return _delivered(base).groupBy("lane_id").agg(
        F.count(F.lit(1)).alias("delivered_count"),
        mean("actual_transit_days", 1).alias("avg_actual_transit_days"),
        pct_of_flag("within_standard_flag", 1).alias("within_standard_pct"))


def _pod_columns() -> list[Column]:
    delivered = F.col("is_delivered") == 1
    with_pod = count_if(delivered & (F.col("has_pod") == 1))
    return [
        F.sum("is_delivered").alias("delivered_count"),
        with_pod.alias("pod_count"),
        pct(with_pod, F.sum("is_delivered")).alias("pod_compliance_pct"),
        count_if(delivered & (F.col("has_pod") == 0)).alias("missing_pod_count")]


def pod_compliance(base: DataFrame) -> DataFrame:
    return base.agg(*_pod_columns())


def shipment_summaries(base: DataFrame) -> DataFrame:
    """The one-row summaries of the base side by side, as structs, in one scan of it:
    ``otif``, ``git``, ``pod`` and ``transit``."""
    moving = F.col("git_flag") == 1
    both = base.select("*", F.struct(*[F.when(moving, F.col(c)).alias(c) for c in _GIT_INPUTS]).alias("_git"))
    transit = F.round(F.avg(F.when(F.col("is_delivered") == 1, F.col("actual_transit_days"))), 4)
    return both.agg(
        F.struct(*_otif_columns()).alias("otif"), F.struct(*_git_columns("_git.")).alias("git"),
        F.struct(*_pod_columns()).alias("pod"), F.struct(transit.alias("avg_transit_days")).alias("transit"))
