"""Freight rating, invoice audit and accessorial audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import count_if, flag, lookup, money_sum, money_sum_if
from freightlens.operators.effective import effective_join

_RATE_COLUMNS = ["carrier_id", "lane_id", "rate_id", "rate_basis", "rate_per_kg",
                 "minimum_charge", "fuel_percentage", "currency", "effective_start_date",
                 "effective_end_date"]


def expected_charges(weight: Column, per_kg: Column, minimum: Column,
                     fuel: Column) -> tuple[Column, Column]:
    """(base, fuel) a rate yields for a weight: minimum enforced, cents rounded."""
    gross = F.greatest(per_kg * weight, minimum)
    return F.round(gross, 2).cast("decimal(14,2)"), F.round(gross * fuel, 2).cast("decimal(14,2)")


def expected_freight(shipment: DataFrame, rate_card: DataFrame,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Expected base and fuel per shipment with its rating status.

    RATED when a version covers the ship date, EXPIRED_RATE when the carrier and
    lane have versions but none covers it, MISSING_RATE otherwise. ``keep`` names
    further shipment columns to carry along.
    """
    facts = shipment.select("shipment_id", "carrier_id", "lane_id", "actual_ship_date",
                            "shipment_weight_kg", *keep)
    rated = effective_join(facts, rate_card.select(*_RATE_COLUMNS), ["carrier_id", "lane_id"],
                           "actual_ship_date", "effective_start_date", "effective_end_date",
                           "rate_id")
    base, fuel = expected_charges(F.col("shipment_weight_kg"), F.col("rate_per_kg"),
                                  F.col("minimum_charge"), F.col("fuel_percentage"))
    has_rate = F.col("rate_id").isNotNull()
    return rated.select(
        "shipment_id", "carrier_id", "lane_id", "actual_ship_date", "shipment_weight_kg",
        "rate_id", "rate_basis", "rate_per_kg", "minimum_charge", "fuel_percentage",
        F.col("currency").alias("rate_currency"),
        F.when(has_rate, "RATED").when(F.col("has_version"), "EXPIRED_RATE")
        .otherwise("MISSING_RATE").alias("rate_status"),
        F.when(has_rate, base).alias("expected_base"),
        F.when(has_rate, fuel).alias("expected_fuel"), *keep)


def band_limit(charge_type: Column, bands: dict[str, str]) -> Column:
    return lookup(bands, charge_type, "decimal(12,2)")


def approved_accessorials(accessorial: DataFrame, bands: dict[str, str]) -> DataFrame:
    """Per invoice, the accessorial total that is allowed, documented and in band."""
    ok = ((F.col("contractually_allowed_flag") == 1) & (F.col("supporting_document_flag") == 1)
          & (F.col("charge_amount") <= band_limit(F.col("charge_type"), bands)))
    return (accessorial.filter(ok).groupBy("invoice_id")
            .agg(F.sum("charge_amount").cast("decimal(14,2)").alias("expected_accessorial")))


def repeated(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Keys on more than one row with the row that counts as the original."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("_copies"), F.min(row_id).alias("_original"))
            .filter(F.col("_copies") > 1))


def audit_invoices(invoice: DataFrame, expected: DataFrame, accessorial: DataFrame,
                   settings: Settings) -> DataFrame:
    """One audited row per invoice: expected total, variance, status, exposure.

    ``expected`` is :func:`expected_freight`. A variance is material only when it
    breaches both the absolute and the relative threshold; an unrated invoice has
    no expected total at all.
    """
    rates = expected.select(
        "shipment_id", F.col("carrier_id").alias("shipment_carrier"), "lane_id", "rate_id",
        "rate_status", "rate_currency", "expected_base", "expected_fuel",
        F.lit(1).alias("_matched"))
    bills = invoice.select(
        "invoice_id", "invoice_number", "shipment_id", F.col("carrier_id").alias("invoice_carrier"),
        "base_charge", "fuel_surcharge", "accessorial_charge", "tax_amount",
        F.col("invoice_total").alias("invoiced_total"), "currency")
    joined = (bills.join(rates, "shipment_id", "left")
              .join(approved_accessorials(accessorial, settings.accessorial_bands),
                    "invoice_id", "left")
              .join(repeated(invoice, "invoice_number", "invoice_id"), "invoice_number", "left"))
    extra = F.coalesce("expected_accessorial", F.lit("0.00").cast("decimal(14,2)"))
    total = (F.col("expected_base") + F.coalesce("expected_fuel", F.lit("0.00").cast("decimal(14,2)"))
             + extra + F.col("tax_amount"))
    floor = F.lit(settings.abs_threshold).cast("decimal(12,2)")
    share = F.lit(settings.pct_threshold).cast("decimal(6,4)")

    def material(gap: Column, reference: Column) -> Column:
        return (F.abs(gap) > floor) & (F.abs(gap) > share * reference)

    scored = (joined.withColumn("expected_accessorial", extra)
              .withColumn("expected_total", total.cast("decimal(16,2)"))
              .withColumn("variance_amount", F.col("invoiced_total") - F.col("expected_total"))
              .withColumn("fuel_variance", F.col("fuel_surcharge") - F.col("expected_fuel"))
              .withColumn("is_material", F.when(
                  F.col("expected_total").isNotNull(),
                  flag(material(F.col("variance_amount"), F.col("expected_total"))))))
    fuel_off = flag(material(F.col("fuel_variance"), F.col("expected_fuel"))) == 1
    over = (F.col("is_material") == 1) & (F.col("variance_amount") > 0)
    under = (F.col("is_material") == 1) & (F.col("variance_amount") < 0)
    duplicate = F.coalesce(F.col("invoice_id") > F.col("_original"), F.lit(False))
    status = (F.when(F.col("_matched").isNull(), "SHIPMENT_MISMATCH")
              .when(duplicate, "DUPLICATE_INVOICE")
              .when(F.col("rate_status") == "MISSING_RATE", "MISSING_RATE")
              .when(F.col("rate_status") == "EXPIRED_RATE", "EXPIRED_RATE")
              .when(F.col("invoice_carrier") != F.col("shipment_carrier"), "CARRIER_MISMATCH")
              .when(F.col("currency") != F.col("rate_currency"), "INCORRECT_CURRENCY")
              .when(fuel_off, "INCORRECT_FUEL_SURCHARGE")
              .when(over, "POTENTIAL_OVERCHARGE")
              .when(under, "POTENTIAL_UNDERCHARGE")
              .otherwise("MATCHED"))
    nothing = F.lit("0.00").cast("decimal(16,2)")
    gap = F.col("variance_amount").cast("decimal(16,2)")
    return scored.select(
        "invoice_id", "invoice_number", "shipment_id", "invoice_carrier", "shipment_carrier",
        "lane_id", "rate_id", "rate_status", "currency", "rate_currency", "expected_base",
        "expected_fuel", "expected_accessorial", "expected_total", "base_charge",
        "fuel_surcharge", "accessorial_charge", "tax_amount", "invoiced_total",
        gap.alias("variance_amount"),
        F.round(gap * F.lit(100).cast("decimal(3,0)")
                / F.nullif(F.col("expected_total"), F.lit("0.00").cast("decimal(16,2)")), 2)
        .cast("double").alias("variance_pct"),
        "is_material", F.col("fuel_variance").cast("decimal(16,2)").alias("fuel_variance"),
        status.alias("audit_status"),
        F.when(over, gap).otherwise(nothing).alias("overcharge_amount"),
        F.when(under, -gap).otherwise(nothing).cast("decimal(16,2)").alias("undercharge_amount"))


def audit_accessorials(accessorial: DataFrame, bands: dict[str, str]) -> DataFrame:
    limit = F.col("max_allowed")
    barred = F.col("contractually_allowed_flag") == 0
    above = F.col("charge_amount") > limit
    return accessorial.withColumn(
        "max_allowed", band_limit(F.col("charge_type"), bands)).select(
        "accessorial_id", "invoice_id", "shipment_id", "charge_type", "charge_amount",
        "contractually_allowed_flag", "supporting_document_flag", "max_allowed",
        F.when(barred, "UNAUTHORIZED").when(above, "EXCESSIVE")
        .when(F.col("supporting_document_flag") == 0, "UNSUPPORTED")
        .otherwise("ALLOWED").alias("accessorial_status"),
        F.when(barred, F.col("charge_amount")).when(above, F.col("charge_amount") - limit)
        .otherwise(F.lit("0.00").cast("decimal(12,2)")).cast("decimal(13,2)")
        .alias("recoverable_amount"))


def audit_by_status(audit: DataFrame) -> DataFrame:
    return audit.groupBy("audit_status").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        money_sum("overcharge_amount").alias("total_overcharge"),
        money_sum("undercharge_amount").alias("total_undercharge"))


def overcharge_by_carrier(audit: DataFrame) -> DataFrame:
    return (audit.filter(F.col("audit_status") != "MATCHED")
            .groupBy(F.col("invoice_carrier").alias("carrier_id"))
            .agg(F.count(F.lit(1)).alias("flagged_invoices"),
                 money_sum("overcharge_amount").alias("total_overcharge")))


def recoverable_summary(audit: DataFrame, accessorial_audit: DataFrame) -> DataFrame:
    """Overcharge, duplicate-invoice and accessorial exposure in one row."""
    hit = F.col("audit_status").isin("POTENTIAL_OVERCHARGE", "INCORRECT_FUEL_SURCHARGE")
    bad = F.col("accessorial_status").isin("UNAUTHORIZED", "EXCESSIVE")
    none = F.lit(0.0)
    side = accessorial_audit.agg(
        F.coalesce(money_sum_if(bad, "recoverable_amount"), none).alias("x")).scalar()
    return audit.agg(
        F.coalesce(money_sum_if(hit, "overcharge_amount"), none).alias("overcharge_recoverable"),
        F.coalesce(money_sum_if(F.col("audit_status") == "DUPLICATE_INVOICE", "invoiced_total"),
                   none).alias("duplicate_invoice_exposure"),
    ).select("overcharge_recoverable", "duplicate_invoice_exposure",
             side.alias("accessorial_recoverable"))


def rated_totals(audit: DataFrame) -> DataFrame:
    """Expected total and variance over rated invoices only."""
    rated = F.col("expected_total").isNotNull()
    return audit.agg(
        count_if(rated).alias("rated_invoices"),
        money_sum("expected_total").alias("rated_expected_total"),
        money_sum("variance_amount").alias("rated_variance"))
