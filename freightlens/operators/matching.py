"""Three-way match of purchase order, shipment and freight invoice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.expr import money_sum_if

_CHARGE_ABOVE = ("POTENTIAL_OVERCHARGE", "INCORRECT_FUEL_SURCHARGE")


def match_components(invoice: DataFrame, shipment: DataFrame, purchase_order: DataFrame,
                     audit: DataFrame, contract_currency: str) -> DataFrame:
    """Status of every component of the match, one row per invoice."""
    bills = invoice.select("invoice_id", "invoice_number", "shipment_id",
                           F.col("carrier_id").alias("_bill_carrier"),
                           F.col("currency").alias("_currency"))
    moves = shipment.select("shipment_id", "po_id", F.col("product_id").alias("_product"),
                            F.col("carrier_id").alias("_carrier"), "planned_quantity",
                            "delivered_quantity", F.lit(1).alias("_moved"))
    orders = purchase_order.select("po_id", F.col("product_id").alias("_po_product"),
                                   F.lit(1).alias("_ordered"))
    checks = audit.select("invoice_id", "rate_status", "audit_status", "variance_amount")
    rows = (bills.join(moves, "shipment_id", "left").join(orders, "po_id", "left")
            .join(checks, "invoice_id", "left"))
    got, planned = F.col("delivered_quantity"), F.col("planned_quantity")
    moved = F.when(F.col("_moved").isNull(), "MISSING").otherwise("MATCH")
    return rows.select(
        "invoice_id", "invoice_number", "shipment_id", "po_id",
        F.when(F.col("_ordered").isNull(), "MISSING").otherwise("MATCH").alias("po_match_status"),
        moved.alias("shipment_match_status"), moved.alias("invoice_match_status"),
        F.when(F.col("_po_product").isNull() | F.col("_product").isNull(), "UNKNOWN")
        .when(F.col("_po_product") == F.col("_product"), "MATCH")
        .otherwise("MULTI_PRODUCT_PO").alias("product_match_status"),
        F.when(got.isNull(), "PENDING").when(got > planned, "EXCEPTION")
        .when(got < planned, "WARNING").otherwise("MATCH").alias("quantity_match_status"),
        F.when(F.col("_carrier").isNull(), "UNKNOWN")
        .when(F.col("_bill_carrier") == F.col("_carrier"), "MATCH")
        .otherwise("MISMATCH").alias("carrier_match_status"),
        F.when(F.col("_currency") == contract_currency, "MATCH").otherwise("MISMATCH")
        .alias("currency_match_status"),
        F.when(F.col("rate_status") == "RATED", "MATCH")
        .otherwise(F.coalesce("rate_status", F.lit("NO_RATE"))).alias("rate_match_status"),
        F.when(F.col("audit_status") == "DUPLICATE_INVOICE", "DUPLICATE").otherwise("OK")
        .alias("duplicate_check_status"),
        "variance_amount", "audit_status")


def three_way_match(components: DataFrame) -> DataFrame:
    """Overall status, reason and recommended action on top of the components."""
    no_shipment = F.col("shipment_match_status") == "MISSING"
    no_order = F.col("po_match_status") == "MISSING"
    duplicate = F.col("duplicate_check_status") == "DUPLICATE"
    other_carrier = F.col("carrier_match_status") == "MISMATCH"
    bad_rate = F.col("rate_match_status") != "MATCH"
    above_quantity = F.col("quantity_match_status") == "EXCEPTION"
    other_currency = F.col("currency_match_status") == "MISMATCH"
    above_charge = F.col("audit_status").isin(*_CHARGE_ABOVE)
    blocked = duplicate | other_carrier | (F.col("audit_status") == "SHIPMENT_MISMATCH")
    overall = (F.when(no_shipment | no_order, "MISSING_RECORD")
               .when(blocked, "BLOCK_PAYMENT")
               .when(bad_rate | above_quantity | other_currency | above_charge,
                     "REVIEW_REQUIRED")
               .when((F.col("quantity_match_status") == "WARNING")
                     | (F.col("audit_status") == "POTENTIAL_UNDERCHARGE"),
                     "MATCHED_WITH_WARNING")
               .otherwise("MATCHED"))
    reason = (F.when(no_shipment, "Invoice has no matching shipment")
              .when(no_order, "Shipment has no matching purchase order")
              .when(duplicate, "Duplicate invoice number")
              .when(other_carrier, "Invoice carrier differs from shipment carrier")
              .when(bad_rate, F.concat(F.lit("Rate issue: "), F.col("rate_match_status")))
              .when(above_quantity, "Delivered quantity exceeds ordered")
              .when(other_currency, "Currency differs from contract")
              .when(above_charge, "Charge above expected")
              .otherwise(""))
    action = (F.when(no_shipment | no_order, "Return to carrier - do not pay")
              .when(duplicate, "Block - verify not already paid")
              .when(other_carrier, "Block - confirm billing entity")
              .when(bad_rate, "Route to Procurement for rate validation")
              .when(above_charge, "Short-pay to expected - dispute variance")
              .when(above_quantity, "Reconcile delivery with Warehouse")
              .otherwise("Approve for payment"))
    return components.withColumns({"overall_match_status": overall, "exception_reason": reason,
                                   "recommended_action": action})


def match_summary(match: DataFrame) -> DataFrame:
    return match.groupBy("overall_match_status").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        money_sum_if(F.col("variance_amount") > 0, "variance_amount")
        .alias("total_positive_variance"))
