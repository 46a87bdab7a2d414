"""What a large input must not do to the driver's memory and the disk."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from freightlens import session
from freightlens.operators import scorecards, shipments, staging
from freightlens.session import land
from freightlens.sources import files
from freightlens.sources.records import MALFORMED, read_records


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark) -> dict:
    """Landed tables, of which Spark knows how small their files are."""
    frames = {
        "fact_freight_invoice": spark.createDataFrame([(10, 1), (20, 2), (20, 3)], "invoice_id bigint, shipment_id bigint"),
        "fact_claim": spark.createDataFrame([(1, 1), (4, None)], "claim_id bigint, shipment_id bigint"),
        "fact_accessorial_charge": spark.createDataFrame([(11, 2)], "accessorial_id bigint, shipment_id bigint"),
        "fact_shipment_milestone": spark.createDataFrame([(31, 3)], "milestone_id bigint, shipment_id bigint"),
        "fact_shipment": spark.createDataFrame([(1, 7), (2, 7), (3, 8), (5, None)], "shipment_id bigint, lane_id bigint"),
        "fact_carrier_capacity": spark.createDataFrame([("a-8", 8), ("a-9", None)], "capacity_id string, lane_id bigint")}
    return {name: land(df, name) for name, df in frames.items()}


def test_products_are_not_gathered_for_the_base(spark):
    text = "shipment_status string, shipment_mode string, incoterm string"
    dates = ", ".join(f"{c} date" for c in ("booking_date", "planned_ship_date", "actual_ship_date", "planned_delivery_date", "actual_delivery_date"))
    numbers = ", ".join(f"{c} bigint" for c in (
        "shipment_id", "source_record_id", "carrier_id", "lane_id", "product_id", "origin_location_id", "destination_location_id",
        "warehouse_id", "hazmat_flag", "customs_required_flag", "planned_quantity", "delivered_quantity", "shipment_weight_kg", "shipment_value_usd"))
    day = [dt.date(2025, 1, 2)] * 5
    rows = [("DELIVERED", "AIR", None, *day, i, i, 1, 7, product, *[1] * 9) for i, product in ((1, 5), (2, None), (2, 6), (None, 9))]
    frames = {"ship": (rows, f"{text}, {dates}, {numbers}"), "lane": ([(7, 4)], "lane_id bigint, standard_transit_days int"),
              "place": ([(1, "Kenya", "AFRICA")], "location_id bigint, country string, region string"),
              "product": ([(5, "INVERTER"), (6, "BATTERY_ESS"), (None, "X")], "product_id bigint, product_category string"),
              "carrier": ([(1, "One")], "carrier_id bigint, carrier_name string"), "keys": ([(2,), (None,)], "shipment_id bigint")}
    t = {name: land(spark.createDataFrame(*frame), name) for name, frame in frames.items()}
    base = shipments.analytics_base(t["ship"], t["lane"], t["place"], t["product"], t["carrier"], t["keys"], t["keys"], dt.date(2025, 6, 1))
    assert "SortMergeJoin [product_id" in plan(base) and "BroadcastHashJoin [lane_id" in plan(base)
    found = {(r["shipment_id"], r["product_id"], r["product_category"], r["has_pod"]) for r in base.collect()}
    assert found == {(1, 5, "INVERTER", 0), (2, None, None, 1), (2, 6, "BATTERY_ESS", 1), (None, 9, None, 0)}


def test_detections_and_claims_are_not_gathered_for_lanes(spark):
    tables = _tables(spark)
    hits = [("shipment", "1"), ("invoice", "20"), ("claim", "1"), ("claim", "4"), ("accessorial", "11"), ("milestone", "31"),
            ("capacity", "a-8"), ("capacity", "a-9"), ("shipment", "5"), ("shipment", None), ("invoice", "99")]
    lanes = scorecards.exceptions_by_lane(spark.createDataFrame(hits, "record_type string, record_id string"), tables)
    claims = scorecards._claims(tables["fact_claim"], tables["fact_shipment"], "lane_id")
    for df in (lanes, claims):
        assert "Broadcast" not in plan(df)
    assert {r["lane_id"]: r["dq_exception_count"] for r in lanes.collect()} == {7: 4, 8: 3}
    assert {r["lane_id"]: r["claim_count"] for r in claims.collect()} == {7: 1}


def test_lines_are_compressed_in_files_of_a_task_each(spark, tmp_path):
    texts = ["1,a,b", '2,"x', 'y",b', "3,a", '4,"""q""",b', "5,ä,b", "6,a,b"]
    lines = spark.createDataFrame([(t == "3,a", t) for t in texts], "opened boolean, line string").coalesce(1)
    files.write_lines(lines, str(tmp_path / "out"), "opened", most=3)
    names = [n for _, _, found in os.walk(tmp_path / "out") for n in found if n.startswith("part-")]
    assert len(names) == 3 and all(n.endswith(".lz4") for n in names)
    rows = {r["id"]: (r["a"], r["b"], r[MALFORMED]) for r in read_records(spark, str(tmp_path / "out"), ["id", "a", "b"], header=False).collect()}
    assert rows == {"1": ("a", "b", None), "2": ("x\ny", "b", None), "3": ("a", None, "3,a"), "4": ('"q"', "b", None),
                    "5": ("ä", "b", None), "6": ("a", "b", None)}


def test_shuffle_files_of_a_long_step_do_not_stay(spark, monkeypatch):
    folders = [f.toString() for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def shuffled() -> set:
        return {n for top in folders for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}

    before = shuffled()
    monkeypatch.setattr(session, "RELEASE_AFTER_S", 0)
    landed = land(spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count(), "counts")
    left, until = shuffled() - before, time.monotonic() + 20
    while left and time.monotonic() < until:
        time.sleep(0.2)
        left = shuffled() - before
    assert not left and landed.count() == 500


def test_rows_with_a_pointer_move_as_staged_columns(spark):
    cells = {"ID": "2", "Scheduled Delivery Date": "2-Jun-06", "Delivered to Client Date": "31-Feb-98", "Line Item Quantity": "7",
             "Weight (Kilograms)": "See DN-1 (ID#:1)", "Freight Cost (USD)": "3.5"}
    rows = [tuple(cells.get(c) for c in staging.RAW_COLUMNS), tuple({"ID": "1", "Weight (Kilograms)": "4"}.get(c) for c in staging.RAW_COLUMNS)]
    staged = staging.stage(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in staging.RAW_COLUMNS)), 20)
    text = plan(staged)
    assert "AS missing_mode_flag" in text[text.index("LeftOuter"):]
    assert staged.columns == [t.name for t in staging.TARGETS]
    found = staged.filter("source_record_id = 2").first()
    assert found["reporting_scheduled_delivery_date"] == dt.date(2026, 6, 2) and found["reporting_actual_delivery_date"] is None
    assert (float(found["weight_kg"]), found["weight_source"], float(found["freight_cost_usd"])) == (4.0, "resolved_reference", 3.5)
    assert found["line_item_quantity"] == 7 and found["missing_mode_flag"] == 1
