"""Derived results over a :class:`Tower`, shared by the query registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.operators import (
    accruals, detection, freight_audit, freight_kpis, marts, measures, rootcause, scorecards,
    service_kpis,
)
from freightlens.plans.tower import AS_OF, SETTINGS, Tower
from freightlens.session import land, still_landed

_kept: dict[tuple[str, ...], DataFrame] = {}


def forget() -> None:
    """Compute every kept result anew on its next use."""
    _kept.clear()


class Results:
    """Lazy results; the ones other results build on are landed once per session."""

    def __init__(self, tower: Tower):
        self.t = tower

    def _keep(self, name: str, build) -> DataFrame:
        slot = (self.t.spark.sparkContext.applicationId, self.t.folder, self.t.state, name)
        if not still_landed(_kept.get(slot)):
            _kept[slot] = land(build(), name)
        return _kept[slot]

    @property
    def base(self) -> DataFrame:
        return self.t["analytics_shipment"]

    @property
    def audit(self) -> DataFrame:
        return self.t["freight_audit"]

    def registry(self) -> DataFrame:
        return detection.registry(self.t.spark)

    def accessorial_audit(self) -> DataFrame:
        return freight_audit.audit_accessorials(
            self.t["fact_accessorial_charge"], SETTINGS.accessorial_bands)

    def recoverable(self) -> DataFrame:
        return freight_audit.recoverable_summary(self.audit, self.accessorial_audit())

    def fact_dq(self) -> DataFrame:
        return marts.fact_data_quality(self.t, self.registry(), SETTINGS)

    def carrier_metrics(self) -> DataFrame:
        return self._keep("carrier_metrics", lambda: scorecards.carrier_metrics(
            self.base, self.t["fact_shipment"], self.audit, self.t["fact_claim"]))

    def carrier_scorecard(self) -> DataFrame:
        return scorecards.carrier_scorecard(self.carrier_metrics(), SETTINGS)

    def lane_metrics(self) -> DataFrame:
        return self._keep("lane_metrics", lambda: scorecards.lane_metrics(
            self.t, self.base, self.audit, self.t["dq_detected_exception"]))

    def lane_scorecard(self) -> DataFrame:
        return self._keep("lane_scorecard", lambda: scorecards.lane_scorecard(
            self.lane_metrics(), self.base, SETTINGS))

    def drilldown(self) -> DataFrame:
        return rootcause.delay_drilldown(self.base, self.t["dim_lane"], self.t["fact_claim"])

    def trend(self) -> DataFrame:
        return rootcause.otif_trend(rootcause.monthly_otif(self.base), SETTINGS)

    def worst(self) -> DataFrame:
        return rootcause.worst_month(self.trend())

    def month_drivers(self) -> DataFrame:
        return rootcause.month_drivers(self.drilldown(), self.worst(), SETTINGS)

    def exposure(self) -> DataFrame:
        return rootcause.freight_exposure(rootcause.freight_pattern(
            self.audit, self.t["dim_carrier"], self.t["fact_shipment"]))

    def dq_pattern(self) -> DataFrame:
        return rootcause.dq_pattern(self.t["dq_detected_exception"], self.registry(),
                                    self.t["dq_detection_performance"], SETTINGS)

    def cases(self) -> DataFrame:
        return rootcause.case_studies(
            self.worst(), rootcause.top_delay_driver(self.month_drivers()),
            rootcause.top_freight_driver(self.exposure()),
            rootcause.top_dq_driver(self.dq_pattern()))

    def evidence(self) -> DataFrame:
        return rootcause.evidence(self.trend(), self.month_drivers(), self.exposure(),
                                  self.dq_pattern())

    def summaries(self) -> dict[str, DataFrame]:
        """The one-row summaries behind the executive metric table, but for the shipments'."""
        t = self.t
        total = F.round(F.col("overcharge_recoverable") + F.col("duplicate_invoice_exposure")
                        + F.col("accessorial_recoverable"), 2)
        matched = F.count(F.when(F.col("audit_status") == "MATCHED", 1))
        rated = self.audit.agg(
            F.round(F.sum("expected_total"), 2).cast("double").alias("rated_expected_total"),
            F.round(matched * 100.0 / F.count(F.lit(1)), 2).alias("invoice_accuracy_pct"))
        return {
            "freight": freight_kpis.freight_summary(t["fact_freight_invoice"],
                                                    t["fact_shipment"]),
            "claims": freight_kpis.claims_totals(t["fact_claim"]),
            "accrual": accruals.accrual_summary(t["fact_accrual"]),
            "recover": self.recoverable().withColumn("total", total),
            "rated": rated,
            "dq": detection.quality_score(t["dq_detected_exception"], t["fact_shipment"],
                                          SETTINGS),
            "gates": detection.recall_gates(t["dq_detection_performance"], SETTINGS),
        }

    def executive(self) -> DataFrame:
        return measures.executive_metrics(service_kpis.shipment_summaries(self.base), self.summaries())

    MARTS = {
        "rpt_dim_date": lambda r: marts.date_dimension(r.base),
        "rpt_dim_carrier": lambda r: marts.dim_carrier(r.t),
        "rpt_dim_lane": lambda r: marts.dim_lane(r.t),
        "rpt_dim_product": lambda r: marts.dim_product(r.t),
        "rpt_dim_location": lambda r: marts.dim_location(r.t),
        "rpt_fact_shipment": lambda r: marts.fact_shipment(r.t),
        "rpt_fact_milestone": lambda r: marts.fact_milestone(r.t),
        "rpt_fact_freight_audit": lambda r: marts.fact_freight_audit(r.t),
        "rpt_fact_data_quality": lambda r: r.fact_dq(),
        "rpt_fact_accrual": lambda r: marts.fact_accrual(r.t),
        "rpt_fact_claim": lambda r: marts.fact_claim(r.t),
        "rpt_carrier_scorecard": lambda r: r.carrier_scorecard(),
        "rpt_lane_scorecard": lambda r: r.lane_scorecard(),
        "rpt_dq_detection_performance": lambda r: r.t["dq_detection_performance"],
    }

    def mart(self, name: str) -> DataFrame:
        """One view of the reporting star."""
        return self.MARTS[name](self)

    def marts(self) -> dict[str, DataFrame]:
        """The whole reporting star, by view name."""
        return {name: self.mart(name) for name in self.MARTS}

    def open_aging(self) -> DataFrame:
        return accruals.open_accrual_aging(self.t["fact_accrual"], AS_OF,
                                           SETTINGS.accrual_age_bounds)
