"""Reporting star: date dimension, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import lookup
from freightlens.operators.rules import Tables
from freightlens.operators.shipments import BASE_COLUMNS

FACT_SHIPMENT_COLUMNS = [c for c in BASE_COLUMNS if c not in (
    "carrier_name", "product_category", "destination_country", "destination_region",
    "standard_transit_days")]


def date_dimension(base: DataFrame) -> DataFrame:
    """One row per day from the first planned ship to the last planned delivery."""
    span = base.agg(F.min("planned_ship_date").alias("lo"),
                    F.max("planned_delivery_date").alias("hi"))
    day = F.col("date")
    return span.filter("lo <= hi").select(
        F.explode(F.sequence("lo", "hi")).alias("date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), "date",
        F.year(day).alias("year"), F.format_string("Q%d", F.quarter(day)).alias("quarter"),
        F.month(day).alias("month_number"), F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"), F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_sub(day, F.weekday(day)).alias("week_start_date"),
        (day == F.last_day(day)).cast("int").alias("month_end_flag"),
        (F.weekday(day) >= 5).cast("int").alias("weekend_flag"))


def dim_carrier(t: Tables) -> DataFrame:
    return t["dim_carrier"].select(
        "carrier_id", "carrier_name", "carrier_type", "primary_mode", "operating_region",
        "payment_terms", "default_currency", "active_flag", "data_class")


def dim_lane(t: Tables) -> DataFrame:
    return t["dim_lane"].select(
        "lane_id", "origin_location_id", "destination_location_id", "origin_name",
        "destination_name", "transport_mode", "lane_region", "standard_transit_days",
        "transit_derivation_method", "active_flag", "data_class")


def dim_product(t: Tables) -> DataFrame:
    return t["dim_product"].select(
        "product_id", "product_sku", "product_category", "product_description",
        "unit_of_measure", "hts_code", "hazardous_material_flag",
        "temperature_controlled_flag", "active_flag", "data_class")


def dim_location(t: Tables) -> DataFrame:
    return t["dim_location"].select("location_id", "location_name", "country", "region",
                                    "location_type", "active_flag", "data_class")


def fact_shipment(t: Tables) -> DataFrame:
    return t["analytics_shipment"].select(*FACT_SHIPMENT_COLUMNS)


def fact_milestone(t: Tables) -> DataFrame:
    return t["fact_shipment_milestone"].select(
        "milestone_id", "shipment_id", "milestone_type", "milestone_sequence",
        "planned_timestamp", "actual_timestamp", "milestone_status", "exception_reason")


def fact_freight_audit(t: Tables) -> DataFrame:
    """Every audited invoice, orphans included."""
    return t["freight_audit"].join(t["fact_shipment"].select(
        "shipment_id", "product_id", "origin_location_id", "destination_location_id",
        "shipment_weight_kg", "shipment_value_usd"), "shipment_id", "left")


def fact_data_quality(t: Tables, registry: DataFrame, settings: Settings) -> DataFrame:
    rules = registry.select("rule_id", "rule_category", "expected_resolution_sla_hours")
    return t["dq_detected_exception"].join(F.broadcast(rules), "rule_id").withColumn(
        "severity_weight", lookup(settings.severity_weights, F.col("severity"))).filter(
        F.col("severity_weight").isNotNull())


def _with_shipment_keys(df: DataFrame, t: Tables) -> DataFrame:
    return df.join(t["fact_shipment"].select("shipment_id", "carrier_id", "lane_id",
                                             "product_id"), "shipment_id")


def fact_accrual(t: Tables) -> DataFrame:
    return _with_shipment_keys(t["fact_accrual"], t)


def fact_claim(t: Tables) -> DataFrame:
    return _with_shipment_keys(t["fact_claim"], t)
