"""Baseline and output validation: every check is a small aggregate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import count_if, lookup
from freightlens.operators.distributed import previous_value
from freightlens.operators.freight_audit import expected_charges
from freightlens.operators.rules import Tables
from freightlens.session import land


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    tested: Column
    failures: Column


# Primary key of each table.
PRIMARY_KEYS = {
    "dim_location": "location_id", "dim_product": "product_id", "dim_carrier": "carrier_id",
    "dim_lane": "lane_id", "dim_supplier": "supplier_id", "dim_warehouse": "warehouse_id",
    "dim_rate_card": "rate_id", "dim_hts_code": "hts_code",
    "dim_business_partner": "partner_id", "fact_purchase_order": "po_id",
    "fact_shipment": "shipment_id", "fact_shipment_milestone": "milestone_id",
    "fact_freight_invoice": "invoice_id", "fact_invoice_line": "invoice_line_id",
    "fact_accessorial_charge": "accessorial_id", "fact_proof_of_delivery": "pod_id",
    "fact_claim": "claim_id", "fact_carrier_capacity": "capacity_id",
    "fact_invoice_approval": "approval_id", "fact_accrual": "accrual_id",
}
# Fixed values: (check, child, column, parent, severity).
FOREIGN_KEYS = [
    ("fk_shipment_carrier", "fact_shipment", "carrier_id", "dim_carrier", "CRITICAL"),
    ("fk_shipment_lane", "fact_shipment", "lane_id", "dim_lane", "CRITICAL"),
    ("fk_shipment_product", "fact_shipment", "product_id", "dim_product", "CRITICAL"),
    ("fk_shipment_po", "fact_shipment", "po_id", "fact_purchase_order", "CRITICAL"),
    ("fk_shipment_origin", "fact_shipment", "origin_location_id", "dim_location", "HIGH"),
    ("fk_shipment_destination", "fact_shipment", "destination_location_id", "dim_location",
     "HIGH"),
    ("fk_invoice_shipment", "fact_freight_invoice", "shipment_id", "fact_shipment", "CRITICAL"),
    ("fk_invoice_line_invoice", "fact_invoice_line", "invoice_id", "fact_freight_invoice",
     "CRITICAL"),
    ("fk_accessorial_invoice", "fact_accessorial_charge", "invoice_id", "fact_freight_invoice",
     "HIGH"),
    ("fk_pod_shipment", "fact_proof_of_delivery", "shipment_id", "fact_shipment", "CRITICAL"),
    ("fk_claim_shipment", "fact_claim", "shipment_id", "fact_shipment", "HIGH"),
    ("fk_accrual_shipment", "fact_accrual", "shipment_id", "fact_shipment", "HIGH"),
    ("fk_milestone_shipment", "fact_shipment_milestone", "shipment_id", "fact_shipment",
     "CRITICAL"),
    ("fk_approval_invoice", "fact_invoice_approval", "invoice_id", "fact_freight_invoice",
     "HIGH"),
]


def _all() -> Column:
    return F.count(F.lit(1))


def report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate checks in one aggregation of ``df``: one row per check."""
    row = df.agg(*[c.tested.cast("bigint").alias(f"t{i}") for i, c in enumerate(checks)],
                 *[F.coalesce(c.failures, F.lit(0)).cast("bigint").alias(f"f{i}")
                   for i, c in enumerate(checks)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("validation_name"),
                 F.col(f"t{i}").alias("records_tested"), F.col(f"f{i}").alias("failures"),
                 F.lit(c.severity).alias("severity"))
        for i, c in enumerate(checks)])).alias("c")).select("c.*")


def grade(lines: DataFrame) -> DataFrame:
    """Add pass rate and status to (validation_name, records_tested, failures, ...)."""
    tested = F.col("records_tested")
    return lines.withColumns({
        "pass_rate": F.when(tested == 0, 1.0).otherwise(
            F.round(1 - F.col("failures") / F.nullif(tested.cast("double"), F.lit(0.0)), 4)),
        "status": F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")})


def _keys(df: DataFrame, column: str, as_name: str, mark: str) -> DataFrame:
    return (df.select(F.col(column).alias(as_name)).filter(F.col(as_name).isNotNull())
            .distinct().withColumn(mark, F.lit(1)))


def _key_counts(t: Tables) -> DataFrame:
    """(table, key, n) of every primary key: one aggregation over all tables, a row with
    n = 0 for each table so that an empty one is told of, too."""
    parts = []
    for table, key in PRIMARY_KEYS.items():
        if table in t:
            parts.append(t[table].select(F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.lit(1).alias("n")))
    spark = parts[0].sparkSession
    names = F.explode(F.array(*[F.lit(table) for table in PRIMARY_KEYS if table in t])).alias("table")
    parts.append(spark.range(1).select(names, F.lit(None).cast("string").alias("key"), F.lit(0).alias("n")))
    return reduce(DataFrame.unionByName, parts).groupBy("table", "key").agg(F.sum("n").alias("n"))


def primary_key_checks(key_counts: DataFrame) -> list[DataFrame]:
    counts = key_counts.groupBy("table").agg(
        F.sum("n").alias("records_tested"), (F.sum("n") - F.count("key")).alias("failures"))
    return [counts.select(F.concat(F.lit("pk_unique["), "table", F.lit("]")).alias("validation_name"),
                          "records_tested", "failures", F.lit("CRITICAL").alias("severity"))]


def foreign_key_checks(t: Tables, key_counts: DataFrame) -> list[DataFrame]:
    """All references in one join: a child's keys are counted by value before they meet
    the keys of its parents, so that what is shuffled is distinct values."""
    specs = [s for s in FOREIGN_KEYS if s[1] in t and s[3] in t]
    cell = lambda s, value, n: F.struct(F.lit(s[0]).alias("check"), F.lit(s[3]).alias("table"), value.alias("key"), F.lit(n).alias("n"))
    parts = []
    for child in dict.fromkeys(s[1] for s in specs):
        cells = F.explode(F.array(*[cell(s, F.col(s[2]).cast("string"), 1) for s in specs if s[1] == child]))
        parts.append(t[child].select(cells.alias("c")).select("c.*"))
    none = F.lit(None).cast("string")
    parts.append(parts[0].sparkSession.range(1).select(F.explode(F.array(*[cell(s, none, 0) for s in specs])).alias("c")).select("c.*"))
    used = reduce(DataFrame.unionByName, parts).groupBy("check", "table", "key").agg(F.sum("n").alias("n"))
    held = key_counts.filter("key is not null").select("table", "key", F.lit(True).alias("_held"))
    lost = F.sum(F.when(F.col("key").isNotNull() & F.col("_held").isNull(), F.col("n")).otherwise(0))
    found = used.join(held, ["table", "key"], "left").groupBy("check").agg(F.sum("n").alias("records_tested"), lost.alias("failures"))
    severity = {s[0]: s[4] for s in specs}
    return [found.select(F.col("check").alias("validation_name"), "records_tested", "failures",
                         lookup(severity, F.col("check")).alias("severity"))]


def shipment_checks(t: Tables) -> list[DataFrame]:
    """Required fields, date order, quantities, lane mode, carrier pool and children."""
    ship = t["fact_shipment"]
    done = F.col("shipment_status") == "DELIVERED"
    lane = t["dim_lane"].select("lane_id", F.col("transport_mode").alias("_mode"))
    pool = t["dim_carrier"].select("carrier_id", F.col("primary_mode").alias("_pool"))
    billed = _keys(t["fact_freight_invoice"], "shipment_id", "shipment_id", "_billed")
    proven = _keys(t["fact_proof_of_delivery"], "shipment_id", "shipment_id", "_proven")
    rated = t["expected_freight"].select("shipment_id", "rate_status")
    source = _keys(t["stg_shipment"], "source_record_id", "source_record_id", "_staged")
    rows = (ship.join(lane, "lane_id", "left").join(pool, "carrier_id", "left")
            .join(billed, "shipment_id", "left").join(proven, "shipment_id", "left")
            .join(rated, "shipment_id", "left").join(source, "source_record_id", "left"))

    def missing(column: str) -> Column:
        return count_if(F.col(column).isNull())

    def unlike(left: str, right: str) -> Column:
        return count_if(~F.coalesce(F.col(left) == F.col(right), F.lit(False)))

    delivered = count_if(done)
    got = F.col("delivered_quantity")
    return [report(rows, [
        Check("required_shipment_carrier", "CRITICAL", _all(), missing("carrier_id")),
        Check("required_shipment_lane", "CRITICAL", _all(), missing("lane_id")),
        Check("required_shipment_product", "HIGH", _all(), missing("product_id")),
        Check("date_booking_le_ship", "HIGH", _all(),
              count_if(F.col("booking_date") > F.col("actual_ship_date"))),
        Check("date_ship_le_delivery", "CRITICAL", delivered,
              count_if(done & (F.col("actual_ship_date") > F.col("actual_delivery_date")))),
        Check("date_planned_ship_le_planned_delivery", "HIGH", _all(),
              count_if(F.col("planned_ship_date") > F.col("planned_delivery_date"))),
        Check("delivered_le_shipped", "MEDIUM", F.count("delivered_quantity"),
              count_if(got > F.col("shipped_quantity"))),
        Check("carrier_in_lane_mode_pool", "HIGH", _all(), unlike("_pool", "_mode")),
        Check("shipment_mode_matches_lane", "MEDIUM", _all(), unlike("shipment_mode", "_mode")),
        Check("delivered_shipment_has_invoice", "CRITICAL", delivered,
              count_if(done & F.col("_billed").isNull())),
        Check("pod_for_delivered", "HIGH", delivered,
              count_if(done & F.col("_proven").isNull())),
        Check("rate_covers_ship_date", "HIGH", _all(),
              count_if(~F.coalesce(F.col("rate_status") == "RATED", F.lit(False)))),
        Check("shipment_lineage_to_source", "CRITICAL", _all(),
              count_if(F.col("_staged").isNull())),
    ])]


def quantity_checks(t: Tables) -> list[DataFrame]:
    moved = t["fact_shipment"].filter(F.col("po_id").isNotNull()).groupBy("po_id").agg(
        F.sum("shipped_quantity").alias("shipped"))
    rows = moved.join(t["fact_purchase_order"].select("po_id", "ordered_quantity"),
                      "po_id", "left")
    return [report(rows, [Check("shipped_qty_le_po_qty", "HIGH", _all(), count_if(
        F.col("shipped") > F.col("ordered_quantity")))])]


def milestone_checks(t: Tables) -> list[DataFrame]:
    done = t["fact_shipment_milestone"].filter("milestone_status = 'COMPLETED'")
    rows = done.select("shipment_id", "milestone_sequence", "actual_timestamp")
    steps = previous_value(rows, "shipment_id", "milestone_sequence", "actual_timestamp",
                           "_prev")
    return [report(steps, [Check("milestone_timestamp_monotonic", "HIGH", _all(), count_if(
        F.col("actual_timestamp") < F.col("_prev")))])]


def invoice_checks(t: Tables, settings: Settings) -> list[DataFrame]:
    inv = t["fact_freight_invoice"]
    cent = F.lit("0.01").cast("decimal(4,2)")
    parts = (F.col("base_charge") + F.col("fuel_surcharge") + F.col("accessorial_charge")
             + F.col("tax_amount"))
    paid = F.col("payment_status") == "PAID"
    lines = t["fact_invoice_line"].groupBy("invoice_id").agg(F.sum("amount").alias("_lines"))
    own = inv.join(lines, "invoice_id", "left")
    zero = F.lit("0.00").cast("decimal(14,2)")
    gap = F.abs(F.col("invoice_total") - F.coalesce("_lines", zero))
    first = report(own, [
        Check("required_invoice_number", "CRITICAL", _all(),
              count_if(F.col("invoice_number").isNull())),
        Check("invoice_total_reconciles", "CRITICAL", _all(),
              count_if(F.abs(parts - F.col("invoice_total")) > cent)),
        Check("invoice_lines_sum_to_total", "HIGH", _all(), count_if(gap > cent)),
        Check("paid_invoice_is_approved", "CRITICAL", count_if(paid),
              count_if(paid & (F.col("approval_status") != "APPROVED"))),
    ])
    moved = t["fact_shipment"].select("shipment_id", F.col("carrier_id").alias("_carrier"))
    rate = t["expected_freight"].select("shipment_id", "shipment_weight_kg", "rate_per_kg",
                                        "minimum_charge", "fuel_percentage", "rate_id")
    base, _ = expected_charges(F.col("shipment_weight_kg"), F.col("rate_per_kg"),
                               F.col("minimum_charge"), F.col("fuel_percentage"))
    gross = F.greatest(F.col("rate_per_kg") * F.col("shipment_weight_kg"),
                       F.col("minimum_charge"))
    due = (gross + gross * F.col("fuel_percentage")).cast("double")
    billed = (F.col("base_charge") + F.col("fuel_surcharge")).cast("double")
    room = F.greatest(F.lit(float(settings.abs_threshold)),
                      F.lit(float(settings.pct_threshold)) * due)
    close = F.coalesce(F.abs(billed - due) <= room, F.lit(False))
    second = report(inv.join(moved, "shipment_id").join(rate, "shipment_id"), [
        Check("invoice_carrier_matches_shipment", "HIGH", _all(), count_if(
            ~F.coalesce(F.col("carrier_id") == F.col("_carrier"), F.lit(False)))),
        Check("invoice_within_rate_tolerance", "HIGH", _all(), count_if(~close)),
    ])
    return [first, second]


def other_checks(t: Tables) -> list[DataFrame]:
    released = F.col("accrual_status") == "RELEASED"
    received = F.col("invoice_received_flag") == 1
    source = t["stg_shipment"].agg(F.countDistinct("source_record_id").alias("n")).scalar()
    return [
        report(t["fact_proof_of_delivery"], [Check(
            "pod_after_delivery", "MEDIUM", _all(),
            count_if(F.col("received_timestamp") < F.col("delivery_timestamp")))]),
        report(t["fact_carrier_capacity"], [Check(
            "capacity_utilization_le_100", "HIGH", _all(),
            count_if(F.col("capacity_utilization_pct") > 100.0001))]),
        report(t["fact_accrual"], [
            Check("accrual_released_has_invoice", "HIGH", count_if(released),
                  count_if(released & ~received)),
            Check("accrual_variance_when_received", "MEDIUM", count_if(received),
                  count_if(received & F.col("actual_invoice_cost").isNull()))]),
        report(t["fact_shipment"].agg(_all().alias("n")).select(
            "n", source.alias("s")), [Check(
                "shipment_count_matches_source", "CRITICAL", _all(),
                count_if(F.col("n") != F.col("s")))]),
    ]


def baseline_checks(t: Tables, settings: Settings) -> DataFrame:
    """The whole baseline report: (validation_name, records_tested, failures, ...)."""
    keys = land(_key_counts(t), "key-counts")
    parts = (primary_key_checks(keys) + foreign_key_checks(t, keys) + shipment_checks(t)
             + quantity_checks(t) + milestone_checks(t) + invoice_checks(t, settings)
             + other_checks(t))
    return grade(reduce(DataFrame.unionByName, parts))


def require_baseline(checks: DataFrame) -> None:
    """Stop a run whose baseline fails a critical check."""
    failed = [r["validation_name"] for r in checks.filter(
        "severity = 'CRITICAL' AND status = 'FAIL'").collect()]
    if failed:
        raise RuntimeError("critical baseline checks failed: " + ", ".join(sorted(failed)))


def _gate(df: DataFrame, name: str, passed: Column) -> DataFrame:
    return df.agg(F.coalesce(passed, F.lit(False)).alias("p")).select(
        F.lit(name).alias("validation_name"), F.lit("CRITICAL").alias("severity"),
        F.when(F.col("p"), "PASS").otherwise("FAIL").alias("status"))


def output_gates(t: Tables, carrier_score: DataFrame, lane_score: DataFrame,
                 cases: DataFrame, dates: DataFrame, exports: DataFrame,
                 settings: Settings) -> DataFrame:
    """Gates over the analytical outputs of a run.

    ``exports``: (table_name, row_count, rows_found, identical) of the exported tables, as
    written and as their files are found (``sources.files.check_layer``).
    """
    perf = t["dq_detection_performance"].filter("manifest_count > 0")
    tp, fn = F.sum("true_positive_count"), F.sum("false_negative_count")
    critical = perf.filter("severity = 'CRITICAL'")
    base, audit, dq = t["analytics_shipment"], t["freight_audit"], t["dq_detected_exception"]
    source = t["fact_shipment"].agg(_all().alias("n")).scalar()
    shipped = exports.filter("table_name = 'rpt_fact_shipment'")
    thin = F.col("shipment_count") < settings.min_carrier_shipments
    wanted = {"shipment_count", "invoiced_freight_usd", "cost_per_kg", "otif_pct",
              "avg_delay_days", "transit_time_variability_days", "claims_rate_pct",
              "accessorial_rate_pct", "invoice_exception_pct", "avg_capacity_utilization_pct",
              "dq_exception_rate_pct", "service_classification", "recommended_action"}
    rows = [
        _gate(perf, "overall_detection_recall", tp / (tp + fn) >= settings.overall_recall_gate),
        _gate(critical, "critical_detection_recall",
              tp / (tp + fn) >= settings.critical_recall_gate),
        _gate(base, "git_age_nonnegative", F.min("git_age_days") >= 0),
        _gate(base, "shipment_rows_preserved", _all() == F.max(source)),
        _gate(base, "full_shipment_lineage",
              (F.countDistinct("source_record_id") == _all())
              & (F.count("source_record_id") == _all())),
        _gate(carrier_score, "insufficient_carriers_unranked",
              count_if(thin & F.col("carrier_rank").isNotNull()) == 0),
        _gate(carrier_score, "eligible_carrier_ranks_unique",
              F.countDistinct("carrier_rank") == F.count("carrier_rank")),
        _gate(lane_score, "lane_scorecard_required_metrics",
              F.lit(wanted <= set(lane_score.columns)) & (_all() > 0)),
        _gate(dates, "date_dimension_complete",
              _all() == F.datediff(F.max("date"), F.min("date")) + 1),
        _gate(cases, "three_root_cause_cases", _all() == 3),
        _gate(audit, "unrated_expected_total_null", count_if(
            (F.coalesce("rate_status", F.lit("")) != "RATED")
            & F.col("expected_total").isNotNull()) == 0),
        _gate(audit, "invoice_audit_one_row_per_invoice",
              F.countDistinct("invoice_id") == _all()),
        _gate(dq, "dq_detection_ids_unique", F.countDistinct("detected_exception_id") == _all()),
        _gate(shipped, "shipment_export_reconciles", (F.sum("rows_found") == F.max(source)) & (F.min("identical") == 1)),
        _gate(exports, "exports_as_written", (_all() > 0) & (F.min("identical") == 1)),
    ]
    weights = abs(sum(settings.score_weights.values()) - 1.0) < 1e-9
    rows.append(_gate(carrier_score, "carrier_weights_sum_to_one", F.lit(weights) & (_all() >= 0)))
    return reduce(DataFrame.unionByName, rows)


def required_outputs(spark: SparkSession, names: list[str]) -> list[str]:
    """Tables or views of ``names`` the catalog does not hold."""
    return [n for n in names if not spark.catalog.tableExists(n)]
