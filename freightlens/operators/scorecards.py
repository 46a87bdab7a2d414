"""Carrier and lane metrics, peer scores and classifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import (
    count_if, flag, lookup, mean, mean_of_hundredths, money_sum, pct, pct_of_flag, ratio,
    spread_of_whole,
)
from freightlens.operators.distributed import by_metric, by_shuffle, dense_competition_rank, exact_quantile, measured
from freightlens.operators.rules import Tables


def _billing(audit: DataFrame, shipment: DataFrame, key: str) -> DataFrame:
    """Spend, cost per kilogram and audit outcome by a shipment attribute, one pass."""
    rows = audit.select("shipment_id", "invoiced_total", "audit_status").join(
        shipment.select("shipment_id", key, "shipment_weight_kg"), "shipment_id")
    matched = count_if(F.col("audit_status") == "MATCHED")
    all_rows = F.count(F.lit(1))
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        money_sum("invoiced_total").alias("invoiced_freight_usd"),
        F.round(ratio(F.sum("invoiced_total"), F.sum("shipment_weight_kg")), 4)
        .alias("cost_per_kg"),
        all_rows.alias("invoice_count"),
        pct(matched, all_rows).alias("invoice_accuracy_pct"),
        (all_rows - matched).alias("invoice_exception_count"),
        pct(all_rows - matched, all_rows).alias("invoice_exception_pct"))


def _claims(claim: DataFrame, shipment: DataFrame, key: str) -> DataFrame:
    rows = by_shuffle(claim.select("shipment_id")).join(shipment.select("shipment_id", key), "shipment_id")
    return (rows.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("claim_count")))


def carrier_metrics(base: DataFrame, shipment: DataFrame, audit: DataFrame,
                    claim: DataFrame) -> DataFrame:
    delivered = F.col("is_delivered") == 1
    service = base.filter(F.col("carrier_id").isNotNull()).groupBy(
        "carrier_id", "carrier_name").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        F.sum("is_delivered").alias("delivered_count"),
        pct_of_flag("otif_flag").alias("otif_pct"),
        pct_of_flag("within_standard_flag").alias("transit_reliability_pct"),
        pct(count_if(delivered & (F.col("has_pod") == 1)), F.sum("is_delivered"))
        .alias("pod_compliance_pct"),
        mean("delay_days").alias("avg_delay_days"),
        mean("actual_transit_days").alias("avg_actual_transit_days"))
    bills = _billing(audit, shipment, "carrier_id").select(
        "carrier_id", "invoiced_freight_usd", "cost_per_kg", "invoice_count",
        "invoice_accuracy_pct")
    return (service.join(bills, "carrier_id", "left")
            .join(_claims(claim, shipment, "carrier_id"), "carrier_id", "left")
            .withColumn("claim_count", F.coalesce("claim_count", F.lit(0)))
            .withColumn("claims_rate_pct", F.coalesce(
                pct(F.col("claim_count"), F.col("shipment_count"), 3), F.lit(0.0))))


_OWNERS_OF_RECORDS = {
    "invoice": ("fact_freight_invoice", "invoice_id"),
    "claim": ("fact_claim", "claim_id"),
    "accessorial": ("fact_accessorial_charge", "accessorial_id"),
    "milestone": ("fact_shipment_milestone", "milestone_id"),
}


def exceptions_by_lane(detected: DataFrame, tables: Tables) -> DataFrame:
    """Number of detections per lane, whatever kind of record they point at.

    Each kind is first traced to a shipment id; all kinds then meet the shipment
    table in one join. Capacity records name their lane themselves.
    """
    hits = detected.select("record_type", "record_id")

    def of(kind: str) -> DataFrame:
        return hits.filter(F.col("record_type") == kind)

    traced = [of("shipment").select(F.col("record_id").alias("sid"))]
    for kind, (table, id_column) in _OWNERS_OF_RECORDS.items():
        links = tables[table].select(F.col(id_column).cast("string").alias("record_id"),
                                     F.col("shipment_id").cast("string").alias("sid"))
        traced.append(by_shuffle(of(kind)).join(links, "record_id").select("sid"))
    lanes = tables["fact_shipment"].select(F.col("shipment_id").cast("string").alias("sid"),
                                           "lane_id")
    by_shipment = by_shuffle(reduce(DataFrame.unionByName, traced)).join(lanes, "sid").select("lane_id")
    slots = tables["fact_carrier_capacity"].select(F.col("capacity_id").alias("record_id"),
                                                   "lane_id")
    by_slot = by_shuffle(of("capacity")).join(slots, "record_id").select("lane_id")
    return (by_shipment.unionByName(by_slot).filter(F.col("lane_id").isNotNull())
            .groupBy("lane_id").agg(F.count(F.lit(1)).alias("dq_exception_count")))


def accessorial_incidence(shipment: DataFrame, accessorial: DataFrame) -> DataFrame:
    """Per lane, shipments with any accessorial and their share."""
    charged = accessorial.select("shipment_id").distinct().withColumn("_hit", F.lit(1))
    rows = shipment.select("shipment_id", "lane_id").distinct().join(
        charged, "shipment_id", "left")
    hit = F.count("_hit")
    return rows.groupBy("lane_id").agg(
        hit.alias("accessorial_shipment_count"),
        pct(hit, F.count(F.lit(1))).alias("accessorial_rate_pct"))


def lane_metrics(tables: Tables, base: DataFrame, audit: DataFrame,
                 detected: DataFrame) -> DataFrame:
    lane, shipment = tables["dim_lane"], tables["fact_shipment"]
    known = base.join(lane.select("lane_id"), "lane_id", "left_semi")
    service = known.groupBy("lane_id").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        F.sum("is_delivered").alias("delivered_count"),
        pct_of_flag("otif_flag").alias("otif_pct"),
        mean("delay_days").alias("avg_delay_days"),
        mean("actual_transit_days").alias("avg_actual_transit_days"),
        pct_of_flag("within_standard_flag").alias("transit_reliability_pct"))
    bills = _billing(audit, shipment, "lane_id").select(
        "lane_id", "invoiced_freight_usd", "cost_per_kg", "invoice_exception_count",
        "invoice_exception_pct")
    load = tables["fact_carrier_capacity"].groupBy("lane_id").agg(
        mean_of_hundredths("capacity_utilization_pct").alias("avg_capacity_utilization_pct"))
    names = lane.select("lane_id", "origin_name", "destination_name", "transport_mode",
                        "lane_region")
    wide = (service.join(names, "lane_id", "left").join(bills, "lane_id", "left")
            .join(_claims(tables["fact_claim"], shipment, "lane_id"), "lane_id", "left")
            .join(accessorial_incidence(shipment, tables["fact_accessorial_charge"]),
                  "lane_id", "left")
            .join(load, "lane_id", "left")
            .join(exceptions_by_lane(detected, tables), "lane_id", "left"))

    def filled(name: str, zero=0) -> Column:
        return F.coalesce(name, F.lit(zero)).alias(name)

    def rate(name: str, digits: int) -> Column:
        return F.coalesce(pct(F.col(name), F.col("shipment_count"), digits), F.lit(0.0))

    return wide.select(
        "lane_id", "origin_name", "destination_name", "transport_mode", "lane_region",
        "shipment_count", "delivered_count", "otif_pct", "avg_delay_days",
        "avg_actual_transit_days", "transit_reliability_pct", "invoiced_freight_usd",
        "cost_per_kg", filled("claim_count"), rate("claim_count", 3).alias("claims_rate_pct"),
        filled("invoice_exception_count"), filled("invoice_exception_pct", 0.0),
        filled("accessorial_shipment_count"), filled("accessorial_rate_pct", 0.0),
        "avg_capacity_utilization_pct", filled("dq_exception_count"),
        rate("dq_exception_count", 2).alias("dq_exception_rate_pct"))


def peer_scores(df: DataFrame, eligible: Column, spec: dict[str, tuple[str, bool]]) -> DataFrame:
    """Min-max scores (0..100) among eligible rows: ``spec`` maps the score column to
    (metric column, higher is better). Equal peers score 100, others get NULL."""
    bounds = df.filter(eligible).agg(F.struct(*[
        fn(F.col(metric).cast("double")).alias(f"{side}_{score}")
        for score, (metric, _) in spec.items()
        for side, fn in (("lo", F.min), ("hi", F.max))]).alias("b")).scalar()
    out = df.withColumn("_b", bounds)
    for score, (metric, upward) in spec.items():
        x = F.col(metric).cast("double")
        lo, hi = F.col(f"_b.lo_{score}"), F.col(f"_b.hi_{score}")
        equal = F.abs(lo - hi) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(hi)
        scaled = (x - lo) / F.nullif(hi - lo, F.lit(0.0)) * 100
        value = F.round(scaled if upward else 100 - scaled, 2)
        out = out.withColumn(score, F.when(eligible & x.isNotNull(),
                                           F.when(equal, 100.0).otherwise(value)))
    return out.drop("_b")


# Score column -> (metric, higher is better, weight key).
CARRIER_SCORES = {
    "otif_score": ("otif_pct", True, "otif"),
    "transit_reliability_score": ("transit_reliability_pct", True, "transit_reliability"),
    "cost_competitiveness_score": ("cost_per_kg", False, "cost_competitiveness"),
    "invoice_accuracy_score": ("invoice_accuracy_pct", True, "invoice_accuracy"),
    "pod_compliance_score": ("pod_compliance_pct", True, "pod_compliance"),
    "claims_score": ("claims_rate_pct", False, "claims"),
}
# Action recommended for each carrier class.
CARRIER_ACTIONS = {
    "Preferred": "Prioritize for strategic awards; monitor quarterly",
    "Acceptable": "Maintain allocation; target weakest score component",
    "Improvement required": "Agree a 90-day corrective-action plan",
    "Critical review": "Escalate sourcing review and contingency planning",
    "Insufficient volume": "Collect more volume before ranking",
}


def carrier_scorecard(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Weighted peer score, rank, class and action of every carrier.

    Carriers under the volume gate are neither peers nor ranked.
    """
    weights = settings.score_weights
    if abs(sum(weights.values()) - 1.0) > 1e-8:
        raise ValueError(f"carrier score weights sum to {sum(weights.values()):.6f}, not 1")
    enough = F.col("shipment_count") >= settings.min_carrier_shipments
    scored = peer_scores(metrics, enough, {s: (m, up) for s, (m, up, _) in CARRIER_SCORES.items()})
    total = reduce(lambda a, b: a + b, [
        F.col(s) * F.lit(float(weights[w])) for s, (_, _, w) in CARRIER_SCORES.items()])
    scored = scored.withColumn("total_score", F.round(total, 2))
    ranked = dense_competition_rank(scored, "total_score", "carrier_rank")
    bands, points = settings.score_bands, F.col("total_score")
    label = (F.when(~enough, "Insufficient volume")
             .when(points >= bands["preferred"], "Preferred")
             .when(points >= bands["acceptable"], "Acceptable")
             .when(points >= bands["improvement"], "Improvement required")
             .otherwise("Critical review"))
    return ranked.withColumn("classification", label).withColumns({
        "recommended_action": lookup(CARRIER_ACTIONS, F.col("classification")),
        "minimum_shipment_threshold": F.lit(settings.min_carrier_shipments)})


def _sentence(parts: list[Column], empty: str) -> Column:
    text = F.concat_ws("; ", *parts)
    return F.when(text == "", empty).otherwise(text)


def lane_scorecard(metrics: DataFrame, base: DataFrame, settings: Settings) -> DataFrame:
    """Lane flags against the upper quartile of eligible peers, labels and actions."""
    spread = (base.filter(F.col("is_delivered") == 1).groupBy("lane_id")
              .agg(spread_of_whole(F.col("actual_transit_days")).alias("_sd")))
    rows = metrics.join(spread, "lane_id", "left").withColumn(
        "transit_time_variability_days", F.round(F.coalesce("_sd", F.lit(0.0)), 2)).drop("_sd")
    enough = F.col("shipment_count") >= settings.min_lane_shipments
    asked = {"cost": "cost_per_kg", "variability": "transit_time_variability_days",
             "accessorial": "accessorial_rate_pct"}
    cuts = exact_quantile(measured(rows.filter(enough), [], asked), ["metric"], "x", 0.75, "p75")
    cut = by_metric(cuts, [], "p75", list(asked)).select(F.struct(*asked).alias("p")).scalar()
    rows = rows.withColumn("_p", cut)

    def above(name: str) -> Column:
        return flag(enough & (F.col(asked[name]) >= F.col(f"_p.{name}")))

    rows = rows.withColumns({
        "high_cost_flag": above("cost"),
        "low_service_flag": flag(enough & (F.col("otif_pct") < settings.low_service_pct)),
        "high_variance_flag": above("variability"),
        "high_accessorial_flag": above("accessorial"),
        "insufficient_volume_flag": flag(~enough)})

    def said(column: str, text: str) -> Column:
        return F.when(F.col(column) == 1, text)

    thin = F.col("insufficient_volume_flag") == 1
    labels = _sentence([
        said("high_cost_flag", "High cost"), said("low_service_flag", "Low service"),
        said("high_variance_flag", "High variance"),
        said("high_accessorial_flag", "High accessorial")], "Stable")
    actions = _sentence([
        said("high_cost_flag", "benchmark or rebid rate"),
        said("low_service_flag", "carrier service recovery plan"),
        said("high_variance_flag", "review schedule and milestone variability"),
        said("high_accessorial_flag", "audit accessorial root causes")],
        "Maintain and monitor")
    opened = F.concat(F.upper(F.substring(actions, 1, 1)),
                      F.substr(actions, F.lit(2)))
    return rows.withColumns({
        "service_classification": F.when(thin, "Insufficient volume").otherwise(labels),
        "recommended_action": F.when(
            thin, "Monitor until the minimum volume threshold is met").otherwise(opened),
        "minimum_shipment_threshold": F.lit(settings.min_lane_shipments),
        "cost_p75_threshold": F.round("_p.cost", 4),
        "variability_p75_threshold": F.round("_p.variability", 2),
        "accessorial_p75_threshold": F.round("_p.accessorial", 2)}).drop("_p")
