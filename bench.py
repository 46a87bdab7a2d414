"""Benchmark: land the model, then time the headline queries. Prints one JSON line.

``$BENCH_SF_DIR`` names the source folder, ``$BENCH_CPUS`` the local cores. Each
query is run to completion on executors (a no-op sink, every column computed);
the reported time is the median of ``$BENCH_RUNS`` runs (3), the first of them cold.
Landing the layers is timed the same way, from the raw tables each time; results that
queries share are dropped before every run, so that each query pays for its own.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from freightlens.plans.queries import QUERIES
from freightlens.plans import raw_text, results, tower as model
from freightlens.plans.raw_text import Staged
from freightlens.plans.tower import Tower
from freightlens.session import tune

HEADLINE = [
    "audit_by_status", "three_way_match", "three_way_match_summary", "otif_by_mode", "otif_by_carrier", "otif_by_month",
    "git_aging", "freight_summary", "freight_by_carrier", "claims_summary",
    "accrual_by_period", "open_accrual_aging", "dq_detected",
    "baseline_checks", "carrier_metrics", "carrier_scorecard", "lane_scorecard",
    "exceptions_by_lane", "rca_delay_drilldown", "rca_cases", "measures_rollup",
    "executive_metrics", "rpt_fact_freight_audit", "column_profile", "purchase_orders", "milestone_schedule",
    "rate_reconciliation", "hash_sample", "table_diff",
]
MODEL = ["fact_shipment", "expected_freight", "fact_freight_invoice",
         "fact_shipment_milestone", "analytics_shipment", "freight_audit", "fact_accrual",
         "dq_detected_exception", "dq_detection_performance"]

STAGED = ["judged", "stg", "location", "product", "supplier", "resolved", "lane", "routed",
          "rate_card", "shipment", "expected"]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (SparkSession.builder.master(f"local[{cpus}]").appName("freightlens-bench")
            .config("spark.sql.shuffle.partitions", cpus)
            .config("spark.driver.memory", "16g")
            .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/freightlens-bench"))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = tune(session())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    landing: dict[str, list[float]] = {n: [] for n in [*MODEL, *STAGED, "model", "staged"]}
    for _ in range(runs):
        model.forget()
        raw_text.forget()
        tower = Tower(spark, folder)
        start = time.perf_counter()
        for name in MODEL:
            t0 = time.perf_counter()
            tower[name]
            landing[name].append(time.perf_counter() - t0)
        landing["model"].append(time.perf_counter() - start)
        staged, start = Staged(tower), time.perf_counter()
        for name in STAGED:
            t0 = time.perf_counter()
            getattr(staged, name)
            landing[name].append(time.perf_counter() - t0)
        landing["staged"].append(time.perf_counter() - start)
    for name, taken in landing.items():
        times[f"land_{name}"] = round(statistics.median(taken), 3)
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            results.forget()
            t0 = time.perf_counter()
            run(QUERIES[name](spark, folder))
            taken.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(taken), 3)
    total = round(sum(times[n] for n in [*HEADLINE, "land_model", "land_staged"]), 3)
    print(json.dumps({
        "metric": "landing the layers + headline queries, median of runs", "value": total,
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")),
        "cores": spark.sparkContext.defaultParallelism, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
