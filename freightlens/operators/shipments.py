"""Shipment analytics base: one row per shipment with service flags and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.expr import days_between, flag, flag_if, month_key
from freightlens.operators.distributed import by_shuffle

BASE_COLUMNS = [
    "shipment_id", "source_record_id", "carrier_id", "carrier_name", "lane_id", "product_id",
    "product_category", "origin_location_id", "destination_location_id", "destination_country",
    "destination_region", "warehouse_id", "shipment_mode", "incoterm", "shipment_status",
    "is_delivered", "hazmat_flag", "customs_required_flag", "planned_quantity",
    "delivered_quantity", "shipment_weight_kg", "shipment_value_usd", "planned_ship_date",
    "actual_ship_date", "planned_delivery_date", "actual_delivery_date",
    "standard_transit_days", "on_time_flag", "in_full_flag", "otif_flag", "late_flag",
    "partial_flag", "delay_days", "planned_transit_days", "actual_transit_days",
    "transit_variance_days", "within_standard_flag", "git_flag", "git_age_days",
    "overdue_git_flag", "reporting_month", "has_pod", "has_invoice",
]


def _present(keys: DataFrame, name: str, into: str) -> DataFrame:
    return (keys.select(name).filter(F.col(name).isNotNull()).distinct()
            .withColumn(into, F.lit(1)))


def analytics_base(shipment: DataFrame, lane: DataFrame, location: DataFrame,
                   product: DataFrame, carrier: DataFrame, pod: DataFrame, invoice: DataFrame,
                   as_of: dt.date) -> DataFrame:
    """Shipments enriched with dimensions, delivery flags, durations and ages.

    Delivery flags are 0/1 for delivered shipments and NULL in transit; a
    comparison with a missing date counts as 0.
    """
    place = location.select(F.col("location_id").alias("destination_location_id"),
                            F.col("country").alias("destination_country"),
                            F.col("region").alias("destination_region"))
    wide = (shipment
            .join(lane.select("lane_id", "standard_transit_days"), "lane_id", "left")
            .join(place, "destination_location_id", "left")
            .join(by_shuffle(product.select("product_id", "product_category")), "product_id", "left")
            .join(carrier.select("carrier_id", "carrier_name"), "carrier_id", "left")
            .join(_present(pod, "shipment_id", "has_pod"), "shipment_id", "left")
            .join(_present(invoice, "shipment_id", "has_invoice"), "shipment_id", "left"))
    today = F.lit(as_of)
    delivered = F.col("shipment_status") == "DELIVERED"
    moving = F.col("shipment_status") == "IN_TRANSIT"
    done, due = F.col("actual_delivery_date"), F.col("planned_delivery_date")
    got, ordered = F.col("delivered_quantity"), F.col("planned_quantity")
    left_on = F.col("actual_ship_date")
    planned_days = days_between(due, F.col("planned_ship_date"))
    actual_days = F.when(delivered, days_between(done, left_on))
    standard = F.col("standard_transit_days")
    return wide.select(
        *[c for c in BASE_COLUMNS if c in wide.columns and not c.startswith("has_")],
        flag(delivered).alias("is_delivered"),
        flag_if(delivered, done <= due).alias("on_time_flag"),
        flag_if(delivered, got >= ordered).alias("in_full_flag"),
        flag_if(delivered, (done <= due) & (got >= ordered)).alias("otif_flag"),
        flag_if(delivered, done > due).alias("late_flag"),
        flag_if(delivered, got < ordered).alias("partial_flag"),
        F.when(delivered, days_between(done, due)).alias("delay_days"),
        planned_days.alias("planned_transit_days"),
        actual_days.alias("actual_transit_days"),
        (actual_days - planned_days).alias("transit_variance_days"),
        flag_if(delivered & standard.isNotNull(), actual_days <= standard)
        .alias("within_standard_flag"),
        flag(moving).alias("git_flag"),
        F.when(moving, F.greatest(F.lit(0), days_between(today, left_on))).alias("git_age_days"),
        flag_if(moving, due < today).alias("overdue_git_flag"),
        month_key(F.when(delivered, done).otherwise(due)).alias("reporting_month"),
        F.coalesce("has_pod", F.lit(0)).alias("has_pod"),
        F.coalesce("has_invoice", F.lit(0)).alias("has_invoice"),
    ).select(*BASE_COLUMNS)
