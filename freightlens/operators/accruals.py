"""Freight accruals: building them and reporting on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.expr import (
    bucket, bucket_order, count_if, days_between, flag, money_sum, money_sum_if, month_key,
)


def build_accruals(expected: DataFrame, shipment: DataFrame, invoice: DataFrame,
                   as_of: dt.date, lag_days: int) -> DataFrame:
    """One accrual per rated shipment, released once its invoice is in and approved.

    ``invoice`` holds at most one (original) invoice per shipment. An invoice
    counts as received when dated within the lag after period end, or by as-of.
    """
    rated = expected.filter(F.col("expected_base").isNotNull()).select(
        "shipment_id", (F.col("expected_base") + F.col("expected_fuel"))
        .cast("decimal(14,2)").alias("expected_freight_cost"))
    dates = shipment.select("shipment_id", "shipment_status", "actual_delivery_date",
                            "planned_delivery_date")
    bills = invoice.select("shipment_id", "invoice_date", "invoice_total", "approval_status")
    rows = rated.join(dates, "shipment_id").join(bills, "shipment_id", "left")
    service = F.when(F.col("shipment_status") == "DELIVERED", F.col("actual_delivery_date")) \
        .otherwise(F.col("planned_delivery_date"))
    closes = F.last_day(service)
    billed = F.col("invoice_date")
    received = F.coalesce((billed <= F.date_add(closes, lag_days)) | (billed <= F.lit(as_of)),
                          F.lit(False))
    released = received & F.coalesce(F.col("approval_status") == "APPROVED", F.lit(False))
    cost = F.when(received, F.col("invoice_total"))
    return rows.select(
        F.col("shipment_id").alias("accrual_id"), "shipment_id",
        month_key(service).alias("accounting_period"), "expected_freight_cost",
        flag(received).alias("invoice_received_flag"), cost.alias("actual_invoice_cost"),
        F.when(released, "RELEASED").otherwise("ACCRUED").alias("accrual_status"),
        closes.alias("accrual_created_date"),
        F.when(released, billed).alias("accrual_release_date"),
        (cost - F.col("expected_freight_cost")).cast("decimal(14,2)").alias("accrual_variance"))


_OPEN = "accrual_status <> 'RELEASED'"


def accrual_summary(accrual: DataFrame) -> DataFrame:
    return accrual.agg(
        F.count(F.lit(1)).alias("accrual_count"),
        money_sum("expected_freight_cost").alias("total_expected_freight"),
        money_sum("actual_invoice_cost").alias("total_actual_invoice"),
        money_sum_if(F.expr(_OPEN), "expected_freight_cost").alias("open_accrual_balance"),
        count_if(F.col("invoice_received_flag") == 0).alias("uninvoiced_shipment_count"),
        money_sum("accrual_variance").alias("total_accrual_variance"),
        count_if(F.col("accrual_status") == "RELEASED").alias("released_count"),
        count_if(F.col("accrual_status") == "ACCRUED").alias("open_count"))


def accrual_by_status(accrual: DataFrame) -> DataFrame:
    return accrual.groupBy("accrual_status", "invoice_received_flag").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        money_sum("expected_freight_cost").alias("expected_freight"),
        money_sum("actual_invoice_cost").alias("actual_invoice"))


def accrual_by_period(accrual: DataFrame) -> DataFrame:
    received = F.col("invoice_received_flag") == 1
    return accrual.groupBy("accounting_period").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        money_sum("expected_freight_cost").alias("expected_freight"),
        money_sum_if(received, "actual_invoice_cost").alias("actual_invoice"),
        money_sum_if(F.expr(_OPEN), "expected_freight_cost").alias("open_accrual"),
        count_if(F.col("invoice_received_flag") == 0).alias("uninvoiced_count"))


def accrual_by_carrier(accrual: DataFrame, shipment: DataFrame) -> DataFrame:
    rows = accrual.join(shipment.select("shipment_id", "carrier_id"), "shipment_id")
    return rows.groupBy("carrier_id").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        money_sum("expected_freight_cost").alias("expected_freight"),
        money_sum_if(F.expr(_OPEN), "expected_freight_cost").alias("open_accrual"))


def plan_vs_actual(accrual: DataFrame) -> DataFrame:
    received = F.col("invoice_received_flag") == 1
    zero = F.lit(0).cast("decimal(1,0)")
    actual = F.sum(F.when(received, F.col("actual_invoice_cost")).otherwise(zero))
    plan = F.sum("expected_freight_cost")
    return accrual.groupBy(F.col("accounting_period").alias("period")).agg(
        F.round(plan, 2).cast("double").alias("simulated_plan_expected_freight"),
        F.round(actual, 2).cast("double").alias("actual_invoiced_freight"),
        F.round(actual - plan, 2).cast("double").alias("variance_vs_plan"))


def open_accrual_aging(accrual: DataFrame, as_of: dt.date, bounds: list[int]) -> DataFrame:
    age = F.greatest(F.lit(0), days_between(F.lit(as_of), F.col("accrual_created_date")))
    top = f"{bounds[-1] + 1}+"
    return (accrual.filter(_OPEN)
            .groupBy(bucket_order(age, bounds).alias("bucket_order"),
                     bucket(age, bounds, top).alias("aging_bucket"))
            .agg(F.count(F.lit(1)).alias("accrual_count"),
                 money_sum("expected_freight_cost").alias("open_accrual")))
