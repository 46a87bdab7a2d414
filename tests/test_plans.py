"""What the physical plans must and must not hold."""

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as entry_points
from freightlens.operators import profiling, staging
from freightlens.plans.raw_text import Staged
from freightlens.plans.tower import Tower
from freightlens.session import land, still_landed

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["otif_by_mode", "three_way_match", "audit_by_status",
                                  "dq_detected", "rca_delay_drilldown", "lane_metrics",
                                  "exceptions_by_lane", "rpt_fact_freight_audit"])
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(entry_points.queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_only_needed_columns_are_read(spark):
    text = plan(entry_points.queries()["otif_by_mode"](spark, FOLDER))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "in_full_flag", "is_delivered", "on_time_flag", "otif_flag", "shipment_mode"]
    assert "EqualTo(is_delivered,1)" in text


def test_executive_metrics_scan_the_base_once(spark):
    text = plan(entry_points.queries()["executive_metrics"](spark, FOLDER))
    scans = re.findall(r"\+- FileScan parquet \[[^\]]*otif_flag[^\]]*\]", text)
    assert len(scans) == 1 and len(re.findall(r"is_delivered#\d+[^\n]*analytics_shipment", text)) <= 1


def test_top_values_are_limited_before_the_shuffle(spark):
    raw = spark.range(10).selectExpr("cast(id as string) AS a", "'x' AS b")
    assert "WindowGroupLimit" in plan(profiling.profile(raw))


def test_landing_is_memoised_and_in_the_shared_folder(spark):
    a, b = Tower(spark, FOLDER)["dim_lane"], Tower(spark, FOLDER)["dim_lane"]
    assert a.inputFiles() == b.inputFiles() and "freightlens" in a.inputFiles()[0]
    assert still_landed(a) and not still_landed(None)
    again = land(a, "copy")
    assert again.count() == a.count() and again.schema == a.schema


def test_a_changed_source_gives_a_new_answer(spark, tmp_path):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    for name in names:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    query = entry_points.queries()["rpt_dim_location"]
    before = query(spark, str(tmp_path)).count()
    spark.read.parquet(f"{FOLDER}/nation.parquet").filter("n_nationkey < 5").write.mode("overwrite").parquet(f"{tmp_path}/nation.parquet")
    assert query(spark, str(tmp_path)).count() < before


def scanned(df) -> Counter:
    """How often each landed table is read in a plan."""
    found, todo = Counter(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "LogicalRelation":
            found[node.relation().location().rootPaths().head().getName().split("-")[0]] += 1
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_checks_and_rules_scan_each_table_a_few_times(spark):
    rules, checks = (scanned(entry_points.queries()[name](spark, FOLDER)) for name in ("dq_detected", "baseline_checks"))
    assert rules["fact_shipment"] <= 2 and rules["fact_freight_invoice"] <= 4, rules
    assert checks["fact_shipment"] <= 5 and sum(checks.values()) <= 45, checks


def test_judged_rows_are_not_shuffled_and_read_by_column(spark):
    staged = Staged(Tower(spark, FOLDER))
    assert "hashpartitioning" not in plan(staged.judged)
    text = plan(entry_points.queries()["category_map"](spark, FOLDER))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and not any("Item Description" in columns or "Brand" in columns for columns in read)


def test_rows_are_judged_once_where_they_land(spark):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(Staged(Tower(spark, FOLDER)).judged.select("rejection_reason")))
    assert read and not any("Delivery Date" in columns or "Quantity" in columns for columns in read)


def test_pointers_meet_one_row_a_target(spark):
    rows = [("1", "5.0", "7"), ("2", "See DN-1 (ID#:1)", "See ASN-1 (ID#:1)"), ("1", "6.0", None)]
    good = spark.createDataFrame(rows, "ID string, `Weight (Kilograms)` string, `Freight Cost (USD)` string")
    resolved = staging.resolve_references(good, *staging.REFERENCES)
    assert plan(resolved).count("explode") == 1
    assert [(float(r["weight_kg"]), float(r["freight_cost_usd"])) for r in resolved.filter("ID = '2'").collect()] == [(6.0, 7.0)]


def test_milestone_ids_use_no_formatter(spark):
    assert "format_string" not in plan(entry_points.queries()["milestone_schedule"](spark, FOLDER))


def test_only_rows_with_a_pointer_are_joined(spark):
    rows = [("1", "5.0", None), ("2", "See DN-1 (ID#:1)", "2"), ("3", "See DN-9 (ID#:9)", "See ASN-2 (ID#:2)"), (None, "4", None)]
    good = spark.createDataFrame(rows, "ID string, `Weight (Kilograms)` string, `Freight Cost (USD)` string")
    resolved = staging.resolve_references(good, *staging.REFERENCES)
    assert "Union" in plan(resolved)
    found = {r["ID"]: (r["weight_kg"] and float(r["weight_kg"]), r["weight_source"], r["freight_cost_usd"] and float(r["freight_cost_usd"]))
             for r in resolved.collect()}
    assert found == {"1": (5.0, "direct", None), "2": (5.0, "resolved_reference", 2.0),
                     "3": (None, "missing_unresolved_reference", 2.0), None: (4.0, "direct", None)}
