"""Detections: registry join, materialised exceptions, scoring against a truth set."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.config import (
    DEFAULT_OWNER, EXCEPTION_OWNERS, SEVERITY_ORDER, SEVERITY_SLA_HOURS, Settings,
)
from freightlens.functions.expr import count_if, days_between, lookup, pct
from freightlens.operators.distributed import number_rows
from freightlens.operators.rules import RULES, Rule, Tables, violations

_REGISTRY_SCHEMA = (
    "rule_id string, rule_name string, rule_category string, target_table string, "
    "target_column string, severity string, business_description string, "
    "exception_description string, check_kind string, business_owner string, "
    "exception_type string, expected_resolution_sla_hours int, active_flag int")

CONTROL_ONLY = "CONTROL_RULE (no injected records)"


def registry(spark: SparkSession, rules: list[Rule] = RULES) -> DataFrame:
    """The rule registry as a table: one row per rule, a fixed handful of them."""
    rows = [(r.rule_id, r.rule_name, r.rule_category, r.target_table, r.target_column,
             r.severity, r.business_description, r.exception_description, r.check.kind,
             EXCEPTION_OWNERS.get(r.exception_type, DEFAULT_OWNER), r.exception_type,
             SEVERITY_SLA_HOURS.get(r.severity, 168), int(r.active)) for r in rules]
    return spark.createDataFrame(rows, _REGISTRY_SCHEMA)


def detect(tables: Tables, settings: Settings, rules: list[Rule] = RULES) -> DataFrame:
    """Every violation with the classification of its rule."""
    hits = violations(tables, settings, rules)
    known = registry(hits.sparkSession, rules).filter("active_flag = 1")
    return hits.join(F.broadcast(known), "rule_id").select(
        "rule_id", "rule_name", "rule_category", "severity", "business_owner",
        "exception_type", "expected_resolution_sla_hours", "record_id", "record_type",
        "reference_date", "exception_description",
        F.lit("operational").alias("source_layer"))


def materialize(detected: DataFrame, as_of: dt.date) -> DataFrame:
    """Detections with a dense id in (rule, record) order, age and open status."""
    numbered = number_rows(detected, ["rule_id", "record_type", "record_id"])
    return numbered.select(
        F.format_string("DE-%06d", "row_no").alias("detected_exception_id"),
        "rule_id", "exception_type", "record_id", "record_type",
        F.lit(as_of).alias("detected_date"), "severity", "exception_description",
        "business_owner", F.lit("OPEN").alias("resolution_status"),
        days_between(F.lit(as_of), F.col("reference_date")).alias("exception_age_days"),
        "source_layer")


def reconcile(manifest: DataFrame, detected: DataFrame,
              notes: dict[str, str] | None = None) -> DataFrame:
    """Detection quality per exception type against the manifest of known faults.

    Works on distinct record ids; the types are those of either side.
    """
    truth = (manifest.groupBy("exception_type", "record_id")
             .agg(F.min("severity").alias("severity")).withColumn("_m", F.lit(1)))
    seen = (detected.select("exception_type", "record_id").distinct()
            .withColumn("_d", F.lit(1)))
    both = truth.join(seen, ["exception_type", "record_id"], "full")
    m, d = F.col("_m").isNotNull(), F.col("_d").isNotNull()
    counts = both.groupBy("exception_type").agg(
        F.min("severity").alias("severity"),
        count_if(m).alias("manifest_count"), count_if(d).alias("detected_count"),
        count_if(m & d).alias("true_positive_count"),
        count_if(d & ~m).alias("false_positive_count"),
        count_if(m & ~d).alias("false_negative_count"))
    tp, fp, fn = (F.col(f"{x}_count") for x in
                  ("true_positive", "false_positive", "false_negative"))
    none = F.lit(0.0)
    precision = tp / F.nullif((tp + fp).cast("double"), none)
    recall = tp / F.nullif((tp + fn).cast("double"), none)
    harmonic = F.when((precision == 0) | (recall == 0), 0.0).otherwise(
        2 * precision * recall / F.nullif(precision + recall, none))
    status = (F.when(F.col("manifest_count") == 0, CONTROL_ONLY)
              .when(recall == 1.0, "FULL").when(recall >= 0.95, "NEAR_FULL").otherwise("GAP"))
    remark = (F.coalesce(lookup(notes, F.col("exception_type")), F.lit(""))
              if notes else F.lit(""))
    return counts.select(
        "exception_type", "severity", "manifest_count", "detected_count",
        "true_positive_count", "false_positive_count", "false_negative_count",
        F.round(precision * 100, 2).alias("precision_pct"),
        F.round(recall * 100, 2).alias("recall_pct"),
        F.round(harmonic, 4).alias("f1_score"), status.alias("coverage_status"),
        remark.alias("notes"))


def recall_gates(performance: DataFrame, settings: Settings) -> DataFrame:
    """Precision, overall and critical recall of manifest-backed types, with gates."""
    backed = performance.filter(F.col("manifest_count") > 0)
    tp, fp, fn = (F.sum(f"{x}_count") for x in
                  ("true_positive", "false_positive", "false_negative"))
    crit = F.col("severity") == "CRITICAL"
    ctp = F.coalesce(F.sum(F.when(crit, F.col("true_positive_count"))), F.lit(0))
    cfn = F.coalesce(F.sum(F.when(crit, F.col("false_negative_count"))), F.lit(0))
    row = backed.agg(
        F.coalesce(tp, F.lit(0)).cast("double").alias("tp"),
        F.coalesce(fp, F.lit(0)).cast("double").alias("fp"),
        F.coalesce(fn, F.lit(0)).cast("double").alias("fn"),
        ctp.cast("double").alias("ctp"), cfn.cast("double").alias("cfn"))
    zero = F.lit(0.0)
    overall = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), zero), zero)
    critical = F.col("ctp") / F.greatest(F.lit(1.0), F.col("ctp") + F.col("cfn"))
    return row.select(
        pct(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision_pct"),
        F.round(overall * 100, 2).alias("overall_recall_pct"),
        F.round(critical * 100, 2).alias("critical_recall_pct"),
        (overall >= settings.overall_recall_gate).cast("int").alias("overall_gate"),
        (critical >= settings.critical_recall_gate).cast("int").alias("critical_gate"))


def require_recall(performance: DataFrame, settings: Settings) -> None:
    """Stop the run when a detection gate is missed."""
    row = recall_gates(performance, settings).first()
    if not (row["overall_gate"] and row["critical_gate"]):
        raise RuntimeError(
            f"detection gates missed: overall {row['overall_recall_pct']} %, "
            f"critical {row['critical_recall_pct']} %")


def quality_score(detected: DataFrame, shipment: DataFrame, settings: Settings) -> DataFrame:
    """1 - severity-weighted open detections / (shipments x top weight), floored at 0."""
    top = max(settings.severity_weights.values())
    weight = F.coalesce(lookup(settings.severity_weights, F.col("severity")), F.lit(0))
    shipments = shipment.agg(F.count(F.lit(1)).alias("n")).scalar()
    open_points = detected.filter("resolution_status = 'OPEN'").agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("weighted_open"))
    share = F.col("weighted_open") / F.nullif((F.col("shipment_count") * top).cast("double"),
                                             F.lit(0.0))
    return (open_points.withColumn("shipment_count", shipments)
            .select("weighted_open", "shipment_count",
                    F.round(F.greatest(F.lit(0.0), 1 - share) * 100, 2).alias("dq_score_pct")))


def sla_by_owner(fact_dq: DataFrame) -> DataFrame:
    late = F.col("exception_age_days") * 24 > F.col("expected_resolution_sla_hours")
    return fact_dq.groupBy("business_owner").agg(
        F.count(F.lit(1)).alias("exception_count"), count_if(late).alias("sla_breach_count"))


def severity_distribution(fact_dq: DataFrame) -> DataFrame:
    """Detections by severity, with the order the severities are shown in."""
    order = lookup({s: i + 1 for i, s in enumerate(SEVERITY_ORDER)}, F.col("severity"))
    return (fact_dq.groupBy("severity").agg(F.count(F.lit(1)).alias("detected_count"))
            .withColumn("severity_order", F.coalesce(order, F.lit(len(SEVERITY_ORDER))))
            .orderBy("severity_order"))
