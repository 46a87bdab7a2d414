"""Named measures with a grouping of choice, executive metrics, detail extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import count_if, ratio
from freightlens.operators.freight_kpis import claims_rate


def _n(condition: str) -> Column:
    return count_if(F.expr(condition))


def _usd(column: str) -> Column:
    return F.sum(column).cast("double")


def shipment_measures() -> dict[str, Column]:
    """Measures over the shipment fact (grain: one row per shipment)."""
    delivered = _n("is_delivered = 1")
    on_time, in_full, otif = (_n(f"is_delivered = 1 AND {f} = 1") for f in
                              ("on_time_flag", "in_full_flag", "otif_flag"))
    return {
        "shipment_count": F.count("shipment_id"), "delivered_shipments": delivered,
        "on_time_shipments": on_time, "in_full_shipments": in_full, "otif_shipments": otif,
        "otif_share": ratio(otif, delivered), "on_time_share": ratio(on_time, delivered),
        "in_full_share": ratio(in_full, delivered), "git_count": _n("git_flag = 1"),
        "git_value": F.sum(F.when(F.col("git_flag") == 1, F.col("shipment_value_usd")))
        .cast("double"),
        "overdue_git": _n("git_flag = 1 AND overdue_git_flag = 1"),
        "average_transit_days": F.avg(F.when(F.col("is_delivered") == 1,
                                             F.col("actual_transit_days"))),
        "average_delay_days": F.avg(F.when(F.col("is_delivered") == 1, F.col("delay_days"))),
        "missing_pod_rate": ratio(_n("is_delivered = 1 AND has_pod = 0"), delivered),
    }


def audit_measures() -> dict[str, Column]:
    """Measures over the freight-audit fact with shipment weight attached."""
    spend, plan = _usd("invoiced_total"), _usd("expected_total")
    return {
        "freight_spend": spend, "expected_freight": plan, "freight_variance": spend - plan,
        "potential_overcharge": _usd("overcharge_amount"),
        "freight_cost_per_kilogram": ratio(F.sum("invoiced_total"), F.sum("shipment_weight_kg")),
        "accessorial_spend": _usd("accessorial_charge"),
        "invoice_accuracy": ratio(_n("audit_status = 'MATCHED'"), F.count(F.lit(1))),
    }


def accrual_measures() -> dict[str, Column]:
    return {
        "open_accrual": F.sum(F.when(F.col("accrual_status") != "RELEASED",
                                     F.col("expected_freight_cost"))).cast("double"),
        "accrual_variance": _usd("accrual_variance"),
    }


def claim_measures() -> dict[str, Column]:
    return {"claims_count": F.count("claim_id"), "claims_cost": _usd("claim_amount")}


def measure(df: DataFrame, measures: dict[str, Column], by: list[str] | None = None,
            how: str = "group") -> DataFrame:
    """Evaluate measures grouped by ``by``; ``how`` is group, rollup or cube."""
    keys = by or []
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[how](*keys)
    extra = [F.grouping_id().cast("int").alias("grouping_level")] if how != "group" else []
    return grouped.agg(*extra, *[c.alias(n) for n, c in measures.items()])


def all_measures(shipment: DataFrame, audit: DataFrame, claim: DataFrame, accrual: DataFrame,
                 dq: DataFrame, performance: DataFrame, lane_score: DataFrame,
                 carrier_score: DataFrame, settings: Settings) -> DataFrame:
    """All 31 measures over the whole star, in long form (measure, value)."""
    def one(df: DataFrame, measures: dict[str, Column]) -> Column:
        return df.agg(F.struct(*[c.alias(n) for n, c in measures.items()]).alias("x")).scalar()

    weight = max(settings.severity_weights.values())
    tp, fp, fn = (F.sum(f"{x}_count") for x in
                  ("true_positive", "false_positive", "false_negative"))
    parts = {
        "a": one(audit, audit_measures()), "c": one(claim, claim_measures()),
        "l": one(accrual, accrual_measures()),
        "d": one(dq, {"points": F.sum(F.when(F.col("resolution_status") == "OPEN",
                                             F.col("severity_weight")))}),
        "p": one(performance, {"detection_precision": ratio(tp, tp + fp),
                               "detection_recall": ratio(tp, tp + fn)}),
        "r": one(lane_score, {"capacity_utilization":
                              F.avg("avg_capacity_utilization_pct") / 100}),
        "k": one(carrier_score, {"carrier_score": F.avg("total_score")}),
    }
    row = shipment.agg(F.struct(*[c.alias(n) for n, c in shipment_measures().items()])
                       .alias("s")).select("s", *[v.alias(k) for k, v in parts.items()])
    ships = F.col("s.shipment_count")
    values = {n: F.col(f"s.{n}") for n in shipment_measures()}
    values |= {n: F.col(f"a.{n}") for n in audit_measures()}
    values |= {n: F.col(f"c.{n}") for n in claim_measures()}
    values["claims_rate"] = ratio(F.col("c.claims_count"), F.col("s.delivered_shipments"))
    values["capacity_utilization"] = F.col("r.capacity_utilization")
    values |= {n: F.col(f"l.{n}") for n in accrual_measures()}
    values["data_quality_score"] = F.greatest(
        F.lit(0.0), 1 - ratio(F.coalesce("d.points", F.lit(0)), ships * weight))
    values["detection_precision"] = F.col("p.detection_precision")
    values["detection_recall"] = F.col("p.detection_recall")
    values["carrier_score"] = F.col("k.carrier_score")
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("measure"), F.round(v.cast("double"), 4).alias("value"))
        for n, v in values.items()])).alias("m")).select("m.*")


def _status(value: Column, spec: tuple | None) -> Column:
    """Pass/Watch/Action of a value: spec is (test, limit, if true, if false)."""
    if spec is None:
        return F.lit("Informational")
    test, limit, yes, no = spec
    hit = {"ge": value >= limit, "lt": value < limit, "gt": value > limit,
           "eq": value == limit}[test]
    return F.when(hit, yes).otherwise(no)


# Executive metrics as (name, source, unit, status test). "Action"
# as a bare string is unconditional.
EXECUTIVE_METRICS = [
    ("Shipment count", "otif.shipment_count", "count", None),
    ("Delivered shipments", "otif.delivered_count", "count", None),
    ("Goods in transit", "otif.in_transit_count", "count", None),
    ("OTIF", "otif.otif_pct", "percent", ("ge", 85, "Pass", "Action")),
    ("On-time rate", "otif.on_time_pct", "percent", ("ge", 85, "Pass", "Action")),
    ("In-full rate", "otif.in_full_pct", "percent", ("ge", 95, "Pass", "Action")),
    ("Average transit time", "transit.avg_transit_days", "days", None),
    ("Average delay", "otif.avg_delay_days", "days", None),
    ("GIT value", "git.git_value_usd", "USD", None),
    ("Overdue GIT", "git.overdue_git_count", "count", ("gt", 0, "Action", "Pass")),
    ("Freight spend", "freight.invoiced_freight_usd", "USD", None),
    ("Expected freight", "rated.rated_expected_total", "USD", None),
    ("Recoverable overcharge", "recover.overcharge_recoverable", "USD", "Action"),
    ("Total recoverable exposure", "recover.total", "USD", "Action"),
    ("Invoice accuracy", "rated.invoice_accuracy_pct", "percent",
     ("lt", 95, "Action", "Pass")),
    ("Open accrual", "accrual.open_accrual_balance", "USD", None),
    ("Claims rate", "claims.claims_rate_pct", "percent", ("ge", 2, "Watch", "Pass")),
    ("POD compliance", "pod.pod_compliance_pct", "percent", ("ge", 95, "Pass", "Action")),
    ("Data-quality score", "dq.dq_score_pct", "percent", ("lt", 95, "Watch", "Pass")),
    ("Detection precision", "gates.precision_pct", "percent", None),
    ("Detection recall", "gates.overall_recall_pct", "percent",
     ("ge", 95, "Pass", "Action")),
    ("Critical recall", "gates.critical_recall_pct", "percent",
     ("eq", 100, "Pass", "Action")),
]


def executive_metrics(shipments: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """The executive metric table.

    ``shipments`` is the row of :func:`service_kpis.shipment_summaries`, one scan of the
    base; ``others`` are one-row summaries of further tables, claims without their rate.
    """
    row = shipments.select("*", *[
        df.select(F.struct("*").alias("x")).scalar().alias(n) for n, df in others.items()])
    rate = claims_rate(F.col("claims.claim_count"), F.col("otif.delivered_count"))
    row = row.withColumn("claims", F.col("claims").withField("claims_rate_pct", rate))
    entries = []
    for name, source, unit, spec in EXECUTIVE_METRICS:
        value = F.col(source).cast("double")
        status = F.lit(spec) if isinstance(spec, str) else _status(value, spec)
        entries.append(F.struct(F.lit(name).alias("metric"), value.alias("value"),
                                F.lit(unit).alias("unit"), status.alias("status")))
    return row.select(F.explode(F.array(*entries)).alias("m")).select("m.*")


# What each reported metric means and its grain.
METRIC_DEFINITIONS = [
    ("OTIF", "Delivered by the planned date and in the planned quantity", "Shipment"),
    ("GIT", "Shipment in transit at the reporting date", "Shipment"),
    ("GIT age", "Days since the actual ship date, not below zero", "Shipment"),
    ("Freight spend", "Invoiced total of invoices with an existing shipment", "Invoice"),
    ("Expected freight", "Rated base, fuel, allowed accessorials and tax", "Invoice"),
    ("Recoverable overcharge", "Material positive variance of overcharge and fuel cases",
     "Invoice"),
    ("Invoice accuracy", "Share of audited invoices that match", "Invoice"),
    ("Open accrual", "Expected freight of accruals not released", "Accrual"),
    ("Claims rate", "Claims per delivered shipment", "Claim"),
    ("POD compliance", "Share of delivered shipments with proof of delivery", "Shipment"),
    ("DQ score", "One less the weighted share of open detections", "Detection"),
    ("Precision", "Share of detections that are planted faults", "Exception type"),
    ("Recall", "Share of planted faults that are detected", "Exception type"),
    ("Carrier score", "Weighted min-max score among peers with enough volume", "Carrier"),
    ("Lane classification", "Volume gate and upper-quartile flags", "Lane"),
]


def metric_definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRIC_DEFINITIONS,
                                 "metric string, definition string, grain string")


def shipment_exceptions(fact_shipment: DataFrame) -> DataFrame:
    """Late, partial, overdue or undocumented shipments."""
    return fact_shipment.filter(
        "late_flag = 1 OR partial_flag = 1 OR overdue_git_flag = 1 "
        "OR (is_delivered = 1 AND has_pod = 0)").orderBy("shipment_id")


def carrier_ranking(scorecard: DataFrame) -> DataFrame:
    """Carriers by rank, unranked ones last."""
    return scorecard.orderBy(F.col("carrier_rank").asc_nulls_last(), "carrier_id")


def lane_listing(scorecard: DataFrame) -> DataFrame:
    """Lanes by number of shipments, busiest first."""
    return scorecard.orderBy(F.desc("shipment_count"), "lane_id")


def audit_exceptions(fact_audit: DataFrame) -> DataFrame:
    return fact_audit.filter("audit_status <> 'MATCHED'").orderBy("audit_status", "invoice_id")


def open_claims(fact_claim: DataFrame) -> DataFrame:
    return fact_claim.filter("claim_status = 'OPEN'").orderBy("created_date", "claim_id")
