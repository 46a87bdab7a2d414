"""The query registry: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.config import EXCEPTION_POOLS, EXCEPTION_RATES
from freightlens.functions.expr import hash48, uniform
from freightlens.operators import (
    accruals, dashboards, detection, dimensions, facts, freight_audit, freight_kpis, marts,
    matching, measures, profiling, rootcause, rules, sampling, service_kpis, scorecards,
    staging, validation,
)
from freightlens.plans.raw_text import STAGING, Staged, faulty_lines
from freightlens.plans.results import Results
from freightlens.plans.tower import AS_OF, MODES, SETTINGS, Tower
from freightlens.session import release, shared_dir, tune
from freightlens.sources import files
from freightlens.sources.records import MALFORMED

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _tower(name: str):
    """Register a query over the derived model."""
    def add(fn: Callable[[Tower, Results], DataFrame]):
        QUERIES[name] = lambda spark, folder: (
            lambda t: fn(t, Results(t)))(Tower(tune(spark), folder))
        return fn
    return add


def _staged(name: str):
    """Register a query over the staged raw text."""
    def add(fn: Callable[[Staged], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Staged(Tower(tune(spark), folder)))
        return fn
    return add


def _doubles(df: DataFrame) -> DataFrame:
    """Hand decimals out as DOUBLE, the form results are compared in."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# -- sources and sinks --------------------------------------------------------
def _table_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = files.folder_names(tune(spark), folder)
    return files.table_counts(files.read_folder(spark, folder, names))


def _orders_in_month(spark: SparkSession, folder: str) -> DataFrame:
    files.read_folder(tune(spark), folder, ["orders"])["orders"].createOrReplaceTempView(
        "freightlens_orders")
    return files.parameterised(
        spark, "SELECT o_orderstatus, count(*) AS order_count FROM freightlens_orders "
               "WHERE o_orderdate >= :first AND o_orderdate < :after GROUP BY o_orderstatus",
        first=dt.datetime(1998, 10, 1), after=dt.datetime(1998, 11, 1))


def _coerced_dates(spark: SparkSession, folder: str) -> DataFrame:
    events = files.read_folder(tune(spark), folder, ["events"])["events"]
    text = events.select("event_id", F.when(F.col("event_id") % 7 == 3, "not a date").otherwise(
        F.date_format("ts", "yyyy-MM-dd")).alias("event_date"))
    return files.coerce_dates(text)


def _provenance(spark: SparkSession, folder: str) -> DataFrame:
    tables = files.read_folder(tune(spark), folder, ["orders", "customer", "part"])
    return reduce(DataFrame.unionByName, [files.provenance(n, df) for n, df in tables.items()])


def _own_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/freightlens/{name}-{uuid.uuid4().hex[:12]}"


def _typed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written out as CSV and read back with their types."""
    customers = files.read_folder(tune(spark), folder, ["customer"])["customer"]
    at = _own_folder(spark, "typed")
    files.write_layer({"customer": customers}, at, "csv")
    return files.read_layer(spark, at)["customer"]


def _refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """A layer of several tables written twice: the second time replaces the first."""
    tables, at = files.read_folder(tune(spark), folder, ["nation", "region", "supplier"]), _own_folder(spark, "layer")
    files.write_layer({n: df.limit(1) for n, df in tables.items()}, at)
    files.write_layer(tables, at)
    back = files.read_layer(spark, at)
    return reduce(DataFrame.unionByName, [files.provenance(n, df) for n, df in back.items()])


QUERIES |= {"table_counts": _table_counts, "parameterised_query": _orders_in_month,
            "coerce_date_columns": _coerced_dates, "source_provenance": _provenance,
            "typed_csv": _typed_csv, "refreshed_layer": _refreshed}


@_tower("csv_export")
def _csv_export(t, r):
    """Every mart written as CSV and read back: rows, and whether the content is the same.

    CSV has no empty text apart from a missing one: both come back as NULL.
    """
    at = _export(t, r, list(r.marts()))
    return files.check_layer(t.spark, at).select("table_name", "row_count", "identical")


def _export(t, r, names: list[str]) -> str:
    """The marts of these names written as a CSV layer; its folder."""
    at, marts_ = _own_folder(t.spark, "export"), r.marts()
    files.write_layer({n: _doubles(marts_[n]) for n in names}, at, "csv")
    return at


def _flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Audit by status from the raw tables in one lazy plan, nothing landed."""
    lazy = Tower(tune(spark), folder, landed=False)
    return _doubles(freight_audit.audit_by_status(lazy["freight_audit"]))


QUERIES["audit_by_status_lazy"] = _flagship


@_tower("layer_rerun_identical")
def _rerun(t, r):
    fresh = Tower(t.spark, t.folder, landed=False)
    return sampling.same_table(t["fact_shipment"], fresh["fact_shipment"])


# -- staging, profiling, conforming --------------------------------------------
@_staged("raw_sample")
def _raw_sample(s):
    return files.first_rows(s.raw.select("ID", "Country", "Vendor", "Line Item Quantity",
                                         "Weight (Kilograms)"),
                            ["ID", "Country", "Vendor", "Line Item Quantity",
                             "Weight (Kilograms)"])


@_staged("raw_csv")
def _raw_csv(s):
    """The raw text written as CSV with a byte-order mark and read back."""
    at = _own_folder(s.tower.spark, "raw")
    files.write_raw(s.raw, at)
    back = files.read_raw(s.tower.spark, at)
    return back.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


@_staged("malformed_records")
def _malformed(s):
    """The raw text as files with faulty records and line breaks: rows by reason, none lost."""
    at, spark, began = _own_folder(s.tower.spark, "faulty"), s.tower.spark, time.monotonic()
    files.write_lines(faulty_lines(s.raw), at, "opened")
    release(spark, began)
    judged = staging.judge(files.read_raw(spark, at, header=False))
    ledger = staging.reject_ledger(judged, STAGING.as_of)
    broken = F.count(F.when(F.col("Item Description").contains("\n"), 1))
    good = staging.accepted(judged).agg(F.lit("accepted").alias("rejection_reason"), F.count(F.lit(1)).alias("row_count"),
                                        broken.alias("line_breaks"))
    return good.unionByName(ledger.groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(F.when(F.col("raw_payload").contains("\\n"), 1)).alias("line_breaks")))


@_staged("reject_split")
def _reject_split(s):
    reason = F.coalesce("rejection_reason", F.lit("accepted")).alias("rejection_reason")
    return s.judged.groupBy(reason).agg(F.count(F.lit(1)).alias("row_count"))


@_staged("reject_ledger")
def _reject_ledger(s):
    return staging.reject_ledger(s.judged, STAGING.as_of)


@_staged("staged_shipments")
def _staged_shipments(s):
    return _doubles(s.staged)


@_staged("reference_provenance")
def _reference_provenance(s):
    return s.staged.groupBy("weight_source", "freight_cost_source").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("weight_kg").cast("double").alias("weight_kg"),
        F.sum("freight_cost_usd").cast("double").alias("freight_cost_usd"))


@_staged("category_map")
def _category_map(s):
    return s.staged.groupBy("product_group_raw", "sub_classification_raw", "product_category").agg(
        F.count(F.lit(1)).alias("row_count"))


@_staged("column_profile")
def _column_profile(s):
    return profiling.profile(s.raw)


@_staged("site_country")
def _site_country(s):
    site = F.col("manufacturing_site")
    return s.staged.groupBy("manufacturing_site", dimensions.site_country(site).alias("country")) \
        .agg(F.count(F.lit(1)).alias("row_count"))


@_staged("regional_warehouse")
def _regional_warehouse(s):
    country = F.col("destination_country")
    return s.staged.groupBy(
        "destination_country", dimensions.region_of(country).alias("region"),
        dimensions.warehouse_for(country).alias("warehouse_id")).agg(
        F.count(F.lit(1)).alias("row_count"))


_STAGED_TABLES: dict[str, Callable[[Staged], DataFrame]] = {
    "location_dim": lambda s: s.location,
    "location_xref": lambda s: s.xref,
    "product_dim": lambda s: s.product,
    "supplier_dim": lambda s: s.supplier,
    "partner_registry": lambda s: dimensions.business_partners(s.supplier, s.stg),
    "shipment_resolution": lambda s: s.routed,
    "lane_dim": lambda s: s.lane,
    "rate_card_grid": lambda s: s.rate_card,
    "shipment_fact": lambda s: s.shipment,
    "purchase_orders": lambda s: s.purchase_order,
    "milestone_schedule": lambda s: facts.milestone_schedule(s.shipment, STAGING),
    "staged_expected_freight": lambda s: s.expected,
    "capacity_build": lambda s: facts.carrier_capacity(s.shipment, STAGING),
    "lane_derivation": lambda s: facts.lane_derivation(s.shipment, s.stg, s.lane, STAGING),
    "rate_reconciliation": lambda s: facts.rate_reconciliation(
        s.expected.filter("expected_base IS NOT NULL AND shipment_status = 'DELIVERED'")
        .withColumn("expected_freight_cost", F.col("expected_base") + F.col("expected_fuel")),
        s.stg),
}
for _name, _build in _STAGED_TABLES.items():
    QUERIES[_name] = (lambda b: lambda spark, folder: _doubles(
        b(Staged(Tower(tune(spark), folder)))))(_build)


@_tower("invoice_lines")
def _invoice_lines(t, r):
    return _doubles(t["fact_invoice_line"])


@_tower("accrual_build")
def _accrual_build(t, r):
    return _doubles(t["fact_accrual"])


@_tower("hash_draw")
def _hash_draw(t, r):
    key = F.col("shipment_id")
    return t["fact_shipment"].select("shipment_id", hash48(42, "audit", key).alias("hash"),
                                     uniform(42, "audit", key).alias("draw"))


# -- sampling and manifest -------------------------------------------------------
@_tower("hash_sample")
def _hash_sample(t, r):
    pool = t["fact_shipment"].filter("shipment_status = 'DELIVERED'").select("shipment_id")
    return sampling.hash_sample(pool, "shipment_id", "missing_carrier_id", 0.01, 42)


@_tower("disjoint_samples")
def _disjoint(t, r):
    pool = t["fact_shipment"].filter("shipment_status = 'DELIVERED'").select("shipment_id")
    return sampling.disjoint_samples(
        pool, "shipment_id", {"missing_carrier_id": 0.010, "invalid_lane": 0.008}, 42)


def _clean_layer(t):
    """The shipment table before two columns were damaged and rows added."""
    mode = F.array_position(F.array(*map(F.lit, MODES)), F.col("shipment_mode")) - 1
    return t["fact_shipment"].filter("shipment_id % 500 <> 3").withColumns({
        "carrier_id": F.coalesce("carrier_id", F.col("supplier_id") % 12),
        "lane_id": F.when(F.col("lane_id") == 9999, F.col("destination_location_id") * 4 + mode)
        .otherwise(F.col("lane_id"))})


def _versions(t):
    return _clean_layer(t), t["fact_shipment"].filter("shipment_id % 700 <> 5"), "shipment_id", ["carrier_id", "lane_id"]


def _diff(t):
    return sampling.table_diff(*_versions(t))


@_tower("unequal_buckets")
def _unequal(t, r):
    return sampling.unequal_buckets(*_versions(t))


@_tower("table_diff")
def _table_diff(t, r):
    return _diff(t)


@_tower("diff_summary")
def _diff_summary(t, r):
    return sampling.diff_summary(_diff(t))


@_tower("fault_summary")
def _fault_summary(t, r):
    done = t["fact_shipment"].filter("shipment_status = 'DELIVERED'")
    mode = lambda *names: done.filter(F.col("shipment_mode").isin(*names))
    pools = {"shipment": done, "customs": mode("AIR", "AIR_CHARTER", "OCEAN", "MULTIMODAL").filter("customs_required_flag = 1"),
             "invoice": t["fact_freight_invoice"], "detention": mode("TRUCK", "OCEAN", "MULTIMODAL"),
             "demurrage": mode("OCEAN", "MULTIMODAL"), "product": t["dim_product"]}
    return sampling.sample_summary(t["meta_exception_manifest"], pools, EXCEPTION_POOLS, EXCEPTION_RATES)


@_tower("cascade_delete")
def _cascade(t, r):
    gone = t["fact_freight_invoice"].filter("shipment_id % 33 = 2")
    kept = sampling.cascade_delete(gone, "invoice_id", {
        n: t[n] for n in ("fact_invoice_line", "fact_invoice_approval",
                          "fact_accessorial_charge")})
    return files.table_counts(kept)


@_tower("last_customs_milestone")
def _last_customs(t, r):
    customs = t["fact_shipment_milestone"].filter(
        "milestone_type IN ('EXPORT_CUSTOMS', 'IMPORT_CUSTOMS')")
    return sampling.last_in_group(customs, "shipment_id", "milestone_sequence", "milestone_id")


# -- data quality -------------------------------------------------------------------
for _rule in rules.RULES:
    _tower(f"{_rule.rule_id.lower()}_{_rule.exception_type}")(
        (lambda x: lambda t, r: rules.violations(t, SETTINGS, [x]))(_rule))


@_tower("dq_detected")
def _dq_detected(t, r):
    return detection.detect(t, SETTINGS)


@_tower("dq_materialized")
def _dq_materialized(t, r):
    return t["dq_detected_exception"]


@_tower("dq_reconcile")
def _dq_reconcile(t, r):
    return t["dq_detection_performance"]


@_tower("dq_recall_gates")
def _dq_gates(t, r):
    return detection.recall_gates(t["dq_detection_performance"], SETTINGS)


@_tower("dq_score")
def _dq_score(t, r):
    return detection.quality_score(t["dq_detected_exception"], t["fact_shipment"], SETTINGS)


@_tower("dq_sla_by_owner")
def _dq_sla(t, r):
    return detection.sla_by_owner(r.fact_dq())


@_tower("dq_severity")
def _dq_severity(t, r):
    return detection.severity_distribution(r.fact_dq())


@_tower("baseline_checks")
def _baseline(t, r):
    return validation.baseline_checks(t, SETTINGS)


@_tower("output_gates")
def _gates(t, r):
    return validation.output_gates(
        t, r.carrier_scorecard(), r.lane_scorecard(), r.cases(), r.mart("rpt_dim_date"),
        files.check_layer(t.spark, _export(t, r, ["rpt_fact_shipment", "rpt_fact_accrual"])), SETTINGS)


# -- shipment base and service KPIs -----------------------------------------------
_KPIS: dict[str, Callable[[Tower, Results], DataFrame]] = {
    "analytics_base": lambda t, r: r.base,
    "otif_summary": lambda t, r: service_kpis.otif_summary(r.base),
    "otif_by_carrier": lambda t, r: service_kpis.otif_by(
        r.base, ["carrier_id", "carrier_name"], ("on_time", "in_full", "delay")),
    "otif_by_mode": lambda t, r: service_kpis.otif_by(
        r.base, ["shipment_mode"], ("on_time", "in_full")),
    "otif_by_lane": lambda t, r: service_kpis.otif_by(r.base, ["lane_id"], ("delay",)),
    "otif_by_category": lambda t, r: service_kpis.otif_by(r.base, ["product_category"]),
    "otif_by_region": lambda t, r: service_kpis.otif_by(r.base, ["destination_region"]),
    "otif_by_month": lambda t, r: service_kpis.otif_by(r.base, ["reporting_month"], ("late",)),
    "git_summary": lambda t, r: service_kpis.git_summary(r.base),
    "git_aging": lambda t, r: service_kpis.git_aging(r.base, SETTINGS.git_age_bounds),
    "git_by_carrier": lambda t, r: service_kpis.git_by_carrier(r.base),
    "transit_by_mode": lambda t, r: service_kpis.transit_by_mode(r.base),
    "transit_by_lane": lambda t, r: service_kpis.transit_by_lane(r.base),
    "pod_compliance": lambda t, r: service_kpis.pod_compliance(r.base),
    "freight_summary": lambda t, r: freight_kpis.freight_summary(
        t["fact_freight_invoice"], t["fact_shipment"]),
    "freight_by_carrier": lambda t, r: freight_kpis.freight_by_carrier(
        t["fact_freight_invoice"], t["fact_shipment"]),
    "freight_by_mode": lambda t, r: freight_kpis.freight_by_mode(
        t["fact_freight_invoice"], t["fact_shipment"]),
    "freight_by_month": lambda t, r: freight_kpis.freight_by_month(
        t["fact_freight_invoice"], r.base),
    "claims_summary": lambda t, r: freight_kpis.claims_summary(t["fact_claim"], r.base),
    "capacity_summary": lambda t, r: freight_kpis.capacity_summary(t["fact_carrier_capacity"]),
    # -- rating, audit, match
    "expected_freight": lambda t, r: t["expected_freight"],
    "freight_audit": lambda t, r: r.audit,
    "accessorial_audit": lambda t, r: r.accessorial_audit(),
    "audit_by_status": lambda t, r: freight_audit.audit_by_status(r.audit),
    "overcharge_by_carrier": lambda t, r: freight_audit.overcharge_by_carrier(r.audit),
    "recoverable_summary": lambda t, r: r.recoverable(),
    "rated_totals": lambda t, r: freight_audit.rated_totals(r.audit),
    "approved_accessorials": lambda t, r: freight_audit.approved_accessorials(
        t["fact_accessorial_charge"], SETTINGS.accessorial_bands),
    "match_components": lambda t, r: _components(t, r),
    "three_way_match": lambda t, r: matching.three_way_match(_components(t, r)),
    "three_way_match_summary": lambda t, r: matching.match_summary(
        matching.three_way_match(_components(t, r))),
    # -- accruals
    "accrual_summary": lambda t, r: accruals.accrual_summary(t["fact_accrual"]),
    "accrual_by_status": lambda t, r: accruals.accrual_by_status(t["fact_accrual"]),
    "accrual_by_period": lambda t, r: accruals.accrual_by_period(t["fact_accrual"]),
    "accrual_by_carrier": lambda t, r: accruals.accrual_by_carrier(
        t["fact_accrual"], t["fact_shipment"]),
    "plan_vs_actual": lambda t, r: accruals.plan_vs_actual(t["fact_accrual"]),
    "open_accrual_aging": lambda t, r: r.open_aging(),
    # -- scorecards
    "carrier_metrics": lambda t, r: r.carrier_metrics(),
    "lane_metrics": lambda t, r: r.lane_metrics(),
    "exceptions_by_lane": lambda t, r: scorecards.exceptions_by_lane(
        t["dq_detected_exception"], t),
    "accessorial_incidence": lambda t, r: scorecards.accessorial_incidence(
        t["fact_shipment"], t["fact_accessorial_charge"]),
    "carrier_scorecard": lambda t, r: r.carrier_scorecard(),
    "lane_scorecard": lambda t, r: r.lane_scorecard(),
    # -- root cause
    "rca_monthly_otif": lambda t, r: rootcause.monthly_otif(r.base),
    "rca_delay_drilldown": lambda t, r: r.drilldown(),
    "rca_freight_pattern": lambda t, r: rootcause.freight_pattern(
        r.audit, t["dim_carrier"], t["fact_shipment"]),
    "rca_dq_pattern": lambda t, r: r.dq_pattern(),
    "rca_otif_trend": lambda t, r: r.trend(),
    "rca_worst_month": lambda t, r: r.worst(),
    "rca_top_delay_driver": lambda t, r: rootcause.top_delay_driver(r.month_drivers()),
    "rca_top_freight_driver": lambda t, r: rootcause.top_freight_driver(r.exposure()),
    "rca_top_dq_driver": lambda t, r: rootcause.top_dq_driver(r.dq_pattern()),
    "rca_cases": lambda t, r: r.cases(),
    "rca_evidence": lambda t, r: r.evidence(),
    # -- measures and dashboards
    "executive_metrics": lambda t, r: r.executive(),
    "measures_by_mode": lambda t, r: measures.measure(
        r.base, measures.shipment_measures(), ["shipment_mode"]),
    "measures_rollup": lambda t, r: measures.measure(
        r.base, measures.shipment_measures(), ["destination_region", "shipment_mode"],
        "rollup"),
    "audit_measures_cube": lambda t, r: measures.measure(
        marts.fact_freight_audit(t), measures.audit_measures(),
        ["audit_status", "invoice_carrier"], "cube"),
    "accrual_measures_by_carrier": lambda t, r: measures.measure(
        marts.fact_accrual(t), measures.accrual_measures(), ["carrier_id"]),
    "claim_measures_by_lane": lambda t, r: measures.measure(
        marts.fact_claim(t), measures.claim_measures(), ["lane_id"]),
    "all_measures": lambda t, r: measures.all_measures(
        marts.fact_shipment(t), marts.fact_freight_audit(t), marts.fact_claim(t),
        marts.fact_accrual(t), r.fact_dq(), t["dq_detection_performance"],
        r.lane_scorecard(), r.carrier_scorecard(), SETTINGS),
    "shipment_exceptions": lambda t, r: measures.shipment_exceptions(marts.fact_shipment(t)),
    "audit_exceptions": lambda t, r: measures.audit_exceptions(marts.fact_freight_audit(t)),
    "open_claims": lambda t, r: measures.open_claims(marts.fact_claim(t)),
    "latest_otif_months": lambda t, r: dashboards.latest_periods(
        service_kpis.otif_by(r.base, ["reporting_month"], ("late",)), "reporting_month", 36),
    "latest_accrual_periods": lambda t, r: dashboards.latest_periods(
        accruals.accrual_by_period(t["fact_accrual"]), "accounting_period", 18),
    "top_overdue": lambda t, r: dashboards.top_overdue(marts.fact_shipment(t)),
    "audit_distribution": lambda t, r: dashboards.distribution(
        r.audit, "audit_status", "invoice_count"),
    "match_distribution": lambda t, r: dashboards.distribution(
        matching.three_way_match(_components(t, r)), "overall_match_status", "invoice_count"),
    "top_manifest_types": lambda t, r: dashboards.top_manifest_types(
        t["dq_detection_performance"]),
    "exposure_waterfall": lambda t, r: dashboards.exposure_waterfall(r.recoverable()),
    "carrier_ranking": lambda t, r: measures.carrier_ranking(r.carrier_scorecard()),
    "lane_listing": lambda t, r: measures.lane_listing(r.lane_scorecard()),
    "most_flagged_lane": lambda t, r: dashboards.most_flagged_lane(r.lane_scorecard()),
}


def _components(t: Tower, r: Results) -> DataFrame:
    return matching.match_components(t["fact_freight_invoice"], t["fact_shipment"],
                                     t["fact_purchase_order"], r.audit,
                                     SETTINGS.contract_currency)


for _name, _fn in _KPIS.items():
    _tower(_name)((lambda f: lambda t, r: _doubles(f(t, r)))(_fn))

for _mart in ("rpt_dim_date", "rpt_dim_carrier", "rpt_dim_lane", "rpt_dim_product",
              "rpt_dim_location", "rpt_fact_shipment", "rpt_fact_milestone",
              "rpt_fact_freight_audit", "rpt_fact_data_quality", "rpt_fact_accrual",
              "rpt_fact_claim", "rpt_carrier_scorecard", "rpt_lane_scorecard",
              "rpt_dq_detection_performance"):
    _tower(_mart)((lambda m: lambda t, r: _doubles(r.mart(m)))(_mart))


@_tower("dashboard_reconciliation")
def _ledger(t, r):
    """Dashboard figures against the same figures recomputed from the fact tables."""
    shipments = service_kpis.shipment_summaries(r.base).select("otif.*", "git.git_value_usd", "git.overdue_git_count")
    shown = dashboards.long_form(shipments, {
        "Total shipments": "shipment_count", "Delivered shipments": "delivered_count",
        "Goods in transit": "in_transit_count", "OTIF": "otif_pct", "On-time": "on_time_pct",
        "In-full": "in_full_pct", "GIT value at risk": "git_value_usd",
        "Overdue GIT": "overdue_git_count"}).unionByName(dashboards.long_form(r.summaries()["accrual"], {
            "Open accrual": "open_accrual_balance", "Accrual variance": "total_accrual_variance",
            "Uninvoiced shipments": "uninvoiced_shipment_count",
            "Released accruals": "released_count"}))
    done = F.col("shipment_status") == "DELIVERED"
    moving = F.col("shipment_status") == "IN_TRANSIT"
    on_time = F.col("actual_delivery_date") <= F.col("planned_delivery_date")
    in_full = F.col("delivered_quantity") >= F.col("planned_quantity")
    n = lambda c: F.count(F.when(c, 1))
    share = lambda c: F.round(n(done & c) * 100.0 / n(done), 2)
    ship = t["fact_shipment"].agg(
        F.count(F.lit(1)).alias("all"), n(done).alias("done"), n(moving).alias("moving"),
        share(on_time & in_full).alias("otif"), share(on_time).alias("on_time"),
        share(in_full).alias("in_full"),
        F.round(F.sum(F.when(moving, F.col("shipment_value_usd"))), 2).alias("git_value"),
        n(moving & (F.col("planned_delivery_date") < F.lit(AS_OF))).alias("overdue"))
    open_ = F.col("accrual_status") != "RELEASED"
    books = t["fact_accrual"].agg(
        F.round(F.sum(F.when(open_, F.col("expected_freight_cost"))), 2).alias("open"),
        F.round(F.sum(F.col("actual_invoice_cost") - F.col("expected_freight_cost")), 2)
        .alias("variance"),
        n(F.col("actual_invoice_cost").isNull()).alias("uninvoiced"),
        n(~open_).alias("released"))
    source = dashboards.long_form(ship, {
        "Total shipments": "all", "Delivered shipments": "done", "Goods in transit": "moving",
        "OTIF": "otif", "On-time": "on_time", "In-full": "in_full",
        "GIT value at risk": "git_value", "Overdue GIT": "overdue"}).unionByName(
        dashboards.long_form(books, {
            "Open accrual": "open", "Accrual variance": "variance",
            "Uninvoiced shipments": "uninvoiced", "Released accruals": "released"}))
    return dashboards.reconciliation_ledger(shown, source)
