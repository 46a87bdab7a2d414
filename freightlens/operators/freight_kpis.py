"""Freight spend, claims and capacity KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.expr import count_if, mean_of_hundredths, money_sum, pct, ratio


def _billed(invoice: DataFrame, shipment: DataFrame, columns: list[str]) -> DataFrame:
    """Invoices of existing shipments with the shipment columns asked for."""
    return invoice.select("shipment_id", "invoice_total").join(
        shipment.select("shipment_id", *columns), "shipment_id")


def freight_summary(invoice: DataFrame, shipment: DataFrame) -> DataFrame:
    valid = invoice.join(shipment.select("shipment_id"), "shipment_id", "left_semi")
    return valid.agg(
        F.count(F.lit(1)).alias("invoice_count"),
        money_sum("invoice_total").alias("invoiced_freight_usd"),
        money_sum("base_charge").alias("base_freight_usd"),
        money_sum("fuel_surcharge").alias("fuel_surcharge_usd"),
        money_sum("accessorial_charge").alias("accessorial_usd"),
        pct(F.sum("fuel_surcharge"), F.sum("base_charge")).alias("fuel_pct_of_base"),
        pct(F.sum("accessorial_charge"), F.sum("invoice_total"))
        .alias("accessorial_pct_of_total"))


def cost_per_kg() -> Column:
    """Billed total per kilogram; a shipment weighs in once per invoice row."""
    return F.round(ratio(F.sum("invoice_total"), F.sum("shipment_weight_kg")), 4)


def freight_by_carrier(invoice: DataFrame, shipment: DataFrame) -> DataFrame:
    rows = _billed(invoice, shipment,
                   ["carrier_id", "shipment_weight_kg", "shipment_value_usd"])
    return rows.groupBy("carrier_id").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        money_sum("invoice_total").alias("invoiced_freight_usd"),
        cost_per_kg().alias("cost_per_kg"),
        pct(F.sum("invoice_total"), F.sum("shipment_value_usd")).alias("freight_pct_of_value"))


def freight_by_mode(invoice: DataFrame, shipment: DataFrame) -> DataFrame:
    return (_billed(invoice, shipment, ["shipment_mode", "shipment_weight_kg"])
            .groupBy("shipment_mode").agg(
                F.count(F.lit(1)).alias("invoice_count"),
                money_sum("invoice_total").alias("invoiced_freight_usd"),
                cost_per_kg().alias("cost_per_kg")))


def freight_by_month(invoice: DataFrame, base: DataFrame) -> DataFrame:
    return (_billed(invoice, base, ["reporting_month"]).groupBy("reporting_month")
            .agg(money_sum("invoice_total").alias("invoiced_freight_usd")))


def claims_totals(claim: DataFrame) -> DataFrame:
    return claim.agg(
        F.count(F.lit(1)).alias("claim_count"),
        money_sum("claim_amount").alias("claim_cost_usd"),
        count_if(F.col("claim_status") == "OPEN").alias("open_claims"))


def claims_rate(claims: Column, delivered: Column) -> Column:
    """Claims against the number of *delivered* shipments."""
    return pct(claims, delivered, 3)


def claims_summary(claim: DataFrame, base: DataFrame) -> DataFrame:
    delivered = base.agg(F.sum("is_delivered").alias("n")).scalar()
    return claims_totals(claim).select(
        "claim_count", "claim_cost_usd",
        claims_rate(F.col("claim_count"), delivered).alias("claims_rate_pct"), "open_claims")


def capacity_summary(capacity: DataFrame) -> DataFrame:
    return capacity.agg(
        mean_of_hundredths("capacity_utilization_pct").alias("avg_utilization_pct"),
        F.max("capacity_utilization_pct").cast("double").alias("max_utilization_pct"),
        count_if(F.col("capacity_utilization_pct") > 100).alias("over_capacity_count"))
