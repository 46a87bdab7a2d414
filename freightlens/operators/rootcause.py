"""Root-cause evidence: trends, drill-downs, drivers and case summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import dollars, lookup, money_sum, money_sum_if, pct_of_flag

_LATE = "late_flag = 1"


def _late_days() -> Column:
    return F.round(F.avg(F.when(F.expr(_LATE), F.col("delay_days").cast("double"))), 2)


def monthly_otif(base: DataFrame) -> DataFrame:
    return base.filter("is_delivered = 1").groupBy("reporting_month").agg(
        F.sum("is_delivered").alias("delivered_count"), F.sum("late_flag").alias("late_count"),
        pct_of_flag("otif_flag").alias("otif_pct"),
        pct_of_flag("on_time_flag").alias("on_time_pct"),
        _late_days().alias("avg_late_days"),
        money_sum_if(F.expr(_LATE), "shipment_value_usd").alias("late_shipment_value_usd"))


def delay_drilldown(base: DataFrame, lane: DataFrame, claim: DataFrame) -> DataFrame:
    """Delays by month, carrier and lane. Claims are totalled per shipment first, so
    a shipment with several claims still counts once."""
    claims = claim.groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("_claims"), F.sum("claim_amount").alias("_cost"))
    names = lane.select("lane_id", "origin_name", "destination_name", "transport_mode")
    rows = (base.filter("is_delivered = 1").join(names, "lane_id", "left")
            .join(claims, "shipment_id", "left"))
    return rows.groupBy("reporting_month", "carrier_id", "carrier_name", "lane_id",
                        "origin_name", "destination_name", "transport_mode").agg(
        F.count(F.lit(1)).alias("delivered_count"), F.sum("late_flag").alias("late_count"),
        pct_of_flag("otif_flag").alias("otif_pct"), _late_days().alias("avg_late_days"),
        money_sum_if(F.expr(_LATE), "shipment_value_usd").alias("late_shipment_value_usd"),
        F.coalesce(F.sum("_claims"), F.lit(0)).alias("claim_count"),
        F.coalesce(money_sum("_cost"), F.lit(0.0)).alias("claim_cost_usd"))


def freight_pattern(audit: DataFrame, carrier: DataFrame, shipment: DataFrame) -> DataFrame:
    """Non-matched invoices by billing carrier and audit status."""
    rows = (audit.filter("audit_status <> 'MATCHED'")
            .withColumnRenamed("invoice_carrier", "carrier_id")
            .join(carrier.select("carrier_id", "carrier_name"), "carrier_id", "left")
            .join(shipment.select("shipment_id", "shipment_value_usd"), "shipment_id", "left"))
    # One row per shipment and group first: the distinct count then needs no Expand.
    part = rows.groupBy("carrier_id", "carrier_name", "audit_status", "shipment_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("invoiced_total").alias("billed"),
        F.sum("overcharge_amount").alias("over"), F.sum("shipment_value_usd").alias("worth"))
    duplicate = F.col("audit_status") == "DUPLICATE_INVOICE"
    return part.groupBy("carrier_id", "carrier_name", "audit_status").agg(
        F.sum("n").alias("affected_invoice_count"),
        money_sum("billed").alias("invoiced_amount_usd"),
        money_sum("over").alias("overcharge_exposure_usd"),
        money_sum_if(duplicate, "billed").alias("duplicate_exposure_usd"),
        F.count("shipment_id").alias("affected_shipment_count"),
        F.coalesce(money_sum("worth"), F.lit(0.0)).alias("affected_shipment_value_usd"))


def dq_pattern(detected: DataFrame, registry: DataFrame, performance: DataFrame,
               settings: Settings) -> DataFrame:
    """Severity-weighted points per rule with the detection quality of its type."""
    names = registry.select("rule_id", "rule_name")
    scores = performance.select(
        "exception_type", "manifest_count", "true_positive_count", "false_positive_count",
        "false_negative_count", "precision_pct", "recall_pct", "notes")
    weight = lookup(settings.severity_weights, F.col("severity"))
    counted = detected.groupBy("rule_id", "exception_type", "severity", "business_owner").agg(
        F.count(F.lit(1)).alias("detected_count"))
    return (counted.withColumn("weighted_exception_points",
                               (F.col("detected_count") * weight).cast("double"))
            .filter(F.col("weighted_exception_points").isNotNull())
            .join(F.broadcast(names), "rule_id").join(scores, "exception_type", "left")
            .select("rule_id", "rule_name", "exception_type", "severity", "business_owner",
                    "detected_count", "weighted_exception_points", "manifest_count",
                    "true_positive_count", "false_positive_count", "false_negative_count",
                    "precision_pct", "recall_pct", "notes"))


def otif_trend(monthly: DataFrame, settings: Settings) -> DataFrame:
    """Month-over-month OTIF change over months with enough volume.

    The window holds one row per calendar month.
    """
    order = Window.orderBy("reporting_month")
    busy = monthly.filter(F.col("delivered_count") >= settings.min_month_volume)
    return busy.withColumn("prior_otif_pct", F.lag("otif_pct").over(order)).withColumn(
        "otif_change_pp", F.round(F.col("otif_pct") - F.col("prior_otif_pct"), 2))


def worst_month(trend: DataFrame) -> DataFrame:
    return (trend.filter(F.col("otif_change_pp").isNotNull())
            .orderBy("otif_change_pp", "reporting_month").limit(1))


def month_drivers(drill: DataFrame, worst: DataFrame, settings: Settings) -> DataFrame:
    month = worst.select("reporting_month").scalar()
    return drill.filter((F.col("reporting_month") == month)
                        & (F.col("delivered_count") >= settings.min_driver_volume))


def top_delay_driver(drivers: DataFrame) -> DataFrame:
    return drivers.orderBy(F.desc("late_count"), F.desc("late_shipment_value_usd"),
                           F.asc_nulls_last("carrier_id"), "lane_id").limit(1)


def freight_exposure(pattern: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return pattern.withColumn("recoverable_exposure_usd", F.round(
        F.coalesce("overcharge_exposure_usd", zero)
        + F.coalesce("duplicate_exposure_usd", zero), 2))


def top_freight_driver(exposure: DataFrame) -> DataFrame:
    return exposure.orderBy(F.desc("recoverable_exposure_usd"), F.desc("affected_invoice_count"),
                            F.asc_nulls_last("carrier_id"), "audit_status").limit(1)


def top_dq_driver(pattern: DataFrame) -> DataFrame:
    return pattern.orderBy(F.desc("weighted_exception_points"), F.desc("detected_count"),
                           "rule_id").limit(1)


def _case(row: DataFrame, case_id: str, title: str, owner: Column, **texts: Column) -> DataFrame:
    return row.select(F.lit(case_id).alias("case_id"), F.lit(title).alias("case_title"),
                      *[t.alias(n) for n, t in texts.items()], owner.alias("business_owner"))


def _say(template: str, *columns) -> Column:
    return F.format_string(template, *columns)


def case_studies(worst: DataFrame, delay: DataFrame, freight: DataFrame,
                 rule: DataFrame) -> DataFrame:
    """One summary row per top driver; causal wording stays conservative."""
    segment = delay.select(F.struct(*delay.columns).alias("d"))
    month = worst.join(segment, F.col("reporting_month") == F.col("d.reporting_month"), "left")
    one = _case(
        month, "RCA-01", "Monthly OTIF deterioration", F.lit("Transportation Operations"),
        problem=_say("OTIF fell in %s against the month before.", "reporting_month"),
        observation=_say("OTIF went from %.2f%% to %.2f%% (%.2f pp).", "prior_otif_pct",
                         "otif_pct", "otif_change_pp"),
        evidence=_say("%d late shipments, %.2f days late on average, worth %s.", "late_count",
                      "avg_late_days", dollars(F.col("late_shipment_value_usd"))),
        drill_down=_say("Most late: %s, %s to %s, %d late shipments, %d claims.",
                        "d.carrier_name", "d.origin_name", "d.destination_name", "d.late_count",
                        "d.claim_count"),
        possible_cause=F.lit("Delays concentrate in this carrier, lane and month; "
                             "the data shows where, not why."),
        business_impact=_say("Late value %s and claims %s in the segment.",
                             dollars(F.col("d.late_shipment_value_usd")),
                             dollars(F.col("d.claim_cost_usd"))),
        corrective_action=F.lit("Review milestones and capacity of the lane with the carrier."),
        follow_up_kpi=F.lit("Monthly OTIF, late shipments, late days, claim cost."))
    two = _case(
        freight, "RCA-02", "Freight invoice control exposure", F.lit("Accounts Payable"),
        problem=_say("%s carries the largest recoverable exposure.", "audit_status"),
        observation=_say("%d invoices of %s carry %s.", "affected_invoice_count",
                         F.coalesce("carrier_name", F.col("carrier_id").cast("string")),
                         dollars(F.col("recoverable_exposure_usd"))),
        evidence=_say("%s billed on %d shipments.", dollars(F.col("invoiced_amount_usd")),
                      "affected_shipment_count"),
        drill_down=_say("Overcharge %s, duplicates %s.",
                        dollars(F.col("overcharge_exposure_usd")),
                        dollars(F.col("duplicate_exposure_usd"))),
        possible_cause=F.lit("Consistent with a billing or rate control gap; "
                             "intent is not shown by the records."),
        business_impact=_say("Up to %s before dispute.",
                             dollars(F.col("recoverable_exposure_usd"))),
        corrective_action=F.lit("Block or dispute the invoices and validate their rates."),
        follow_up_kpi=F.lit("Recoverable exposure, disputes, invoice accuracy."))
    three = _case(
        rule, "RCA-03", "Data-quality control concentration", F.col("business_owner"),
        problem=_say("%s has the largest severity-weighted volume.", "rule_name"),
        observation=_say("%d detections (%s), %s weighted points.", "detected_count", "severity",
                         F.format_number("weighted_exception_points", 0)),
        evidence=_say("Planted %d, found %d, missed %d.",
                      *[F.coalesce(c, F.lit(0)) for c in (
                          "manifest_count", "true_positive_count", "false_negative_count")]),
        drill_down=F.when(F.coalesce("notes", F.lit("")) == "", "No further note.")
        .otherwise(F.col("notes")),
        possible_cause=F.lit("Consistent with shared master data; a process cause is not shown."),
        business_impact=F.lit("More manual review and unreliable expected freight."),
        corrective_action=F.lit("Tighten the master data behind the rule."),
        follow_up_kpi=F.lit("Detections of the rule, recall, precision."))
    return one.unionByName(two).unionByName(three)


def evidence(trend: DataFrame, drivers: DataFrame, exposure: DataFrame,
             pattern: DataFrame) -> DataFrame:
    """All evidence rows in one table, absent columns NULL."""
    parts = [(trend, "RCA-01", "monthly_trend"), (drivers, "RCA-01", "carrier_lane_drilldown"),
             (exposure, "RCA-02", "carrier_audit_status"), (pattern, "RCA-03", "dq_rule")]
    tagged = [df.withColumns({"case_id": F.lit(c), "evidence_level": F.lit(level)})
              for df, c, level in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
