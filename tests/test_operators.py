"""Semantics on tiny frames: nulls, ties, thresholds, orders of precedence."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.functions.expr import bucket, hash48, padded, parse_short_date, uniform
from freightlens.operators import (
    accruals, dashboards, detection, freight_audit, marts, matching, measures, rules, sampling,
    scorecards, service_kpis, shipments, staging, validation,
)
from freightlens.operators.dimensions import region_of, site_country, warehouse_for
from freightlens.operators.rootcause import otif_trend, worst_month
from freightlens.sources import files
from freightlens.sources.records import read_records

D = dt.date
CFG = Settings(as_of=D(2025, 7, 1))


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


# -- staging ------------------------------------------------------------------------
def test_short_dates_and_sentinels(spark):
    texts = ["2-Jun-06", "02-JUN-06", "5-jan-99", "Date Not Captured", "Pre-PQ Process", None,
             "31-Feb-10", "2006-06-02"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in df.orderBy("i").select(staging.parse_date(F.col("t")).alias("d"))
           .collect()]
    assert got == [D(2006, 6, 2), D(2006, 6, 2), D(1999, 1, 5), None, None, None, None, None]


def test_short_dates_read_whole_month_names_only(spark):
    texts = ["1-anf-05", "1-n f-05", "1-Sept-05", "00-Jan-05", "0012-DEC-68", " 3-Mar-69 ", "1-Jan-05\n", "1--Jan-05"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in df.orderBy("i").select(parse_short_date(F.col("t")).alias("d")).collect()]
    assert got == [None, None, None, None, D(2068, 12, 12), D(1969, 3, 3), None, None]


@pytest.mark.parametrize("width", [2, 7])
def test_padded_numbers_are_those_of_a_formatter(spark, width):
    numbers = [None, 0, 7, -1, -12, 999_999, -999_999, 1_234_567, -1_234_567, 12_345_678, 2**63 - 1, -2**63]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    rows = df.select(padded(F.col("n"), width).alias("ours"), F.format_string(f"%0{width}d", "n").alias("theirs")).collect()
    assert [r["ours"] for r in rows] == [r["theirs"] for r in rows]


def test_calendar_shift_clamps_leap_day(spark):
    df = spark.createDataFrame([("29-Feb-16",)], "t string")
    got = df.select(F.add_months(parse_short_date(F.col("t")), 120).alias("d")).first()["d"]
    assert got == D(2026, 2, 28)


def test_references_resolve_one_hop_only(spark):
    rows = [("1", "100.5"), ("2", "See DN-9 (ID#:1)"), ("3", "Weight Captured Separately"),
            ("4", "See ASN-7 (ID#:3)"), ("5", "See DN-2 (ID#:2)"), ("6", "See DN-2 (ID#:77)")]
    df = spark.createDataFrame([(*r, "See DN-1 (ID#:1)" if r[0] == "2" else "7.5") for r in rows], ["ID", "Weight (Kilograms)", "x"])
    got = staging.resolve_references(
        df, staging.Reference("Weight (Kilograms)", staging.WEIGHT_SENTINELS, "decimal(12,2)", "w", "src"),
        staging.Reference("x", {}, "decimal(12,2)", "y", "y_src"))
    assert {r["ID"]: (float(r["y"]), r["y_src"]) for r in got.collect()} == {
        r[0]: (7.5, "resolved_reference" if r[0] == "2" else "direct") for r in rows}
    found = {r["ID"]: (None if r["w"] is None else float(r["w"]), r["src"])
             for r in got.collect()}
    assert found == {
        "1": (100.5, "direct"), "2": (100.5, "resolved_reference"),
        "3": (None, "missing_captured_separately"), "4": (None, "missing_unresolved_reference"),
        "5": (None, "missing_unresolved_reference"), "6": (None, "missing_unresolved_reference")}


def test_category_wildcard(spark):
    df = spark.createDataFrame([("ARV", "Adult"), ("ARV", "Pediatric"), ("ANTM", "Malaria"),
                                ("ARV", "Other")], "g string, s string")
    got = [r["c"] for r in df.select(staging.product_category(F.col("g"), F.col("s")).alias("c"))
           .collect()]
    assert got == ["SOLAR_MODULE", "INVERTER", "BOS_COMPONENT", None]


def _raw(spark, rows):
    base = {c: None for c in staging.RAW_COLUMNS}
    base |= {"Scheduled Delivery Date": "2-Jun-06", "Delivered to Client Date": "3-Jun-06",
             "Line Item Quantity": "5"}
    schema = ", ".join(f"`{c}` string" for c in staging.RAW_COLUMNS)
    return spark.createDataFrame([tuple({**base, **r}[c] for c in staging.RAW_COLUMNS)
                                  for r in rows], schema)


def test_reject_reasons_and_ledger(spark):
    raw = _raw(spark, [
        {"ID": "1"}, {"ID": "2"}, {"ID": "2"},
        {"ID": "3", "Scheduled Delivery Date": "soon", "Line Item Quantity": "0"},
        {"ID": "4", "Delivered to Client Date": None}, {"ID": "5", "Line Item Quantity": "0"},
        {"ID": "6", "Line Item Quantity": "many"}])
    judged = staging.judge(raw)
    reasons = sorted((r["ID"], r["rejection_reason"]) for r in staging.rejects(judged).collect())
    assert reasons == [
        ("2", "duplicate ID"), ("2", "duplicate ID"),
        ("3", "unparseable scheduled delivery date"),
        ("4", "unparseable actual delivery date"),
        ("5", "non-positive or non-numeric quantity"),
        ("6", "non-positive or non-numeric quantity")]
    assert [r["ID"] for r in staging.accepted(judged).collect()] == ["1"]
    ledger = staging.reject_ledger(judged, CFG.as_of).filter("source_record_id = '5'").first()
    assert json.loads(ledger["raw_payload"]) == {
        "ID": "5", "Scheduled Delivery Date": "2-Jun-06",
        "Delivered to Client Date": "3-Jun-06", "Line Item Quantity": "0"}
    again = staging.reject_ledger(judged, CFG.as_of).filter("source_record_id = '5'").first()
    assert ledger["reject_id"] == again["reject_id"]


def test_staged_row(spark):
    raw = _raw(spark, [{
        "ID": "7", "Vendor INCO Term": "N/A - From RDC", "Shipment Mode": "Air Charter",
        "Product Group": "ACT", "Sub Classification": "x", "First Line Designation": "Yes",
        "Line Item Value": "12.50", "Unit of Measure (Per Pack)": "30",
        "Weight (Kilograms)": "8", "Freight Cost (USD)": "Invoiced Separately"}])
    row = staging.stage(raw, 10).first()
    assert len(row) == 35
    assert (row["incoterm"], row["shipment_mode"], row["missing_mode_flag"]) == \
        (None, "AIR_CHARTER", 0)
    assert row["product_category"] == "BOS_COMPONENT" and row["first_line_designation"] == 1
    assert row["reporting_scheduled_delivery_date"] == D(2016, 6, 2)
    assert row["freight_cost_source"] == "missing_invoiced_separately"


def test_geography(spark):
    assert one(spark, site_country(F.col("s")), s="Ranbaxy, Paonta Shahib, IN") == "India"
    assert one(spark, site_country(F.col("s")), s="Nowhere") is None
    assert one(spark, region_of(F.col("c")), c="Côte d'Ivoire") == "AFRICA"
    assert one(spark, region_of(F.col("c")), c="Atlantis") == "UNKNOWN"
    assert one(spark, warehouse_for(F.col("c")), c="Zambia") == "WH02"
    assert one(spark, warehouse_for(F.col("c")), c="Kenya") == "WH01"
    assert one(spark, warehouse_for(F.col("c")), c="Atlantis") == "WH03"


def test_hash_is_the_first_48_bits_of_md5(spark):
    import hashlib
    want = int(hashlib.md5(b"42:salt:17").hexdigest()[:12], 16)
    assert one(spark, hash48(42, "salt", F.col("k")), k=17) == want
    assert one(spark, uniform(42, "salt", F.col("k")), k=17) == want / 2 ** 48


# -- sampling ------------------------------------------------------------------------
@pytest.mark.parametrize("rate,n,size", [(0.01, 250, 3), (0.001, 40, 1), (0.0, 40, 0),
                                         (2.0, 40, 40), (0.5, 0, 0)])
def test_sample_size(spark, rate, n, size):
    assert one(spark, sampling.sample_size(rate, F.col("n").cast("bigint")), n=n) == size


def test_hash_sample_takes_the_smallest_hashes(spark):
    ids = spark.range(500).withColumnRenamed("id", "k")
    got = {r["k"] for r in sampling.hash_sample(ids, "k", "t", 0.05, 42).collect()}
    ranked = [r["k"] for r in ids.orderBy(hash48(42, "t", F.col("k")), "k").limit(25).collect()]
    assert got == set(ranked)


def test_disjoint_samples(spark):
    ids = spark.range(200).withColumnRenamed("id", "k")
    rows = sampling.disjoint_samples(ids, "k", {"a": 0.1, "b": 0.2}, 42).collect()
    assert len({r["k"] for r in rows}) == len(rows) == 60


def test_equal_tables_have_no_unequal_bucket_and_a_change_names_its_own(spark):
    rows = [(i, f"v{i % 7}", i / 3) for i in range(3000)] + [(None, None, None)]
    a = spark.createDataFrame(rows, "k int, p string, q double")
    assert sampling.unequal_buckets(a, a.repartition(7), "k", ["p", "q"]).count() == 0
    b = a.filter("k <> 11 OR k IS NULL").withColumn("p", F.when(F.col("k") == 40, F.lit(None)).otherwise(F.col("p")))
    found = {r["bucket"]: (r["left_rows"], r["right_rows"]) for r in sampling.unequal_buckets(a, b, "k", ["p", "q"]).collect()}
    own = {r["k"]: r["b"] for r in a.select("k", sampling._leaf("k").alias("b")).filter("k IN (11, 40)").collect()}
    assert set(found) == set(own.values()) and found[own[11]][0] - found[own[11]][1] == 1
    diff = {tuple(r)[:3] for r in sampling.table_diff(a, b, "k", ["p", "q"]).collect()}
    assert diff == {("11", "DELETED", "k"), ("40", "UPDATED", "p")}


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 5), (3, "z", 1)], "k int, p string, q int")
    b = spark.createDataFrame([(1, "x", None), (2, "n", None), (4, "w", 1)],
                              "k int, p string, q int")
    got = sorted(tuple(r) for r in sampling.table_diff(a, b, "k", ["p", "q"]).fillna("-")
                 .collect())
    assert got == [("2", "UPDATED", "p", "y", "n"), ("2", "UPDATED", "q", "5", "-"),
                   ("3", "DELETED", "k", "3", "-"), ("4", "INSERTED", "k", "-", "4")]


def test_fingerprint_ignores_order(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    same = sampling.same_table(df, df.orderBy(F.desc("id")).repartition(3)).first()
    other = sampling.same_table(df, df.withColumn("v", F.lit(1))).first()
    assert same["identical"] == 1 and other["identical"] == 0


# -- shipment base ---------------------------------------------------------------------
def _base(spark):
    ship = spark.createDataFrame([
        (1, "DELIVERED", D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 6), D(2025, 1, 6), 10, 10, 7),
        (2, "DELIVERED", D(2025, 1, 1), D(2025, 1, 1), D(2025, 1, 6), None, 10, 8, None),
        (3, "IN_TRANSIT", D(2025, 7, 9), D(2025, 7, 9), D(2025, 7, 20), None, 10, None, 99)],
        "shipment_id int, shipment_status string, planned_ship_date date, actual_ship_date date, "
        "planned_delivery_date date, actual_delivery_date date, planned_quantity int, "
        "delivered_quantity int, lane_id int")
    for c in ("source_record_id", "carrier_id", "product_id", "origin_location_id",
              "destination_location_id", "warehouse_id", "hazmat_flag", "customs_required_flag"):
        ship = ship.withColumn(c, F.lit(1))
    ship = ship.withColumns({
        "shipment_mode": F.lit("AIR"), "incoterm": F.lit(None).cast("string"),
        "shipment_weight_kg": F.lit("5.00").cast("decimal(14,2)"),
        "shipment_value_usd": F.lit("100.00").cast("decimal(16,2)")})
    lane = spark.createDataFrame([(7, 4)], "lane_id int, standard_transit_days int")
    place = spark.createDataFrame([(1, "Kenya", "AFRICA")],
                                  "location_id int, country string, region string")
    product = spark.createDataFrame([(1, "INVERTER")], "product_id int, product_category string")
    carrier = spark.createDataFrame([(1, "One")], "carrier_id int, carrier_name string")
    pod = spark.createDataFrame([(1,), (1,)], "shipment_id int")
    inv = spark.createDataFrame([(2,), (None,)], "shipment_id int")
    return shipments.analytics_base(ship, lane, place, product, carrier, pod, inv, CFG.as_of)


def test_base_flags(spark):
    rows = {r["shipment_id"]: r for r in _base(spark).collect()}
    assert len(rows) == 3
    one_, two, three = rows[1], rows[2], rows[3]
    assert (one_["on_time_flag"], one_["in_full_flag"], one_["otif_flag"]) == (1, 1, 1)
    assert (one_["actual_transit_days"], one_["within_standard_flag"], one_["has_pod"]) == (4, 1, 1)
    # A missing delivery date compares as false, not unknown.
    assert (two["on_time_flag"], two["late_flag"], two["otif_flag"]) == (0, 0, 0)
    assert two["within_standard_flag"] is None and two["has_invoice"] == 1
    assert three["on_time_flag"] is None and three["git_age_days"] == 0
    assert three["reporting_month"] == "2025-07" and three["overdue_git_flag"] == 0


def test_rates_range_over_delivered_only(spark):
    row = service_kpis.otif_summary(_base(spark)).first()
    assert (row["shipment_count"], row["delivered_count"], row["otif_pct"]) == (3, 2, 50.0)


def test_buckets(spark):
    df = spark.createDataFrame([(a,) for a in (0, 7, 8, 30, 60, 61)], "a int")
    got = [r["b"] for r in df.select(bucket(F.col("a"), [7, 14, 30, 60]).alias("b")).collect()]
    assert got == ["0-7", "0-7", "8-14", "15-30", "31-60", "60+"]


# -- rating and audit ----------------------------------------------------------------------
def _dec(df, columns, kind="decimal(14,2)"):
    return df.withColumns({c: F.col(c).cast(kind) for c in columns})


def _audit(spark):
    ship = _dec(spark.createDataFrame([
        (1, 1, 1, D(2024, 5, 1), 100.0), (2, 1, 2, D(2024, 5, 1), 10.0),
        (3, 1, 3, D(2024, 5, 1), 10.0), (4, None, 1, D(2024, 5, 1), 100.0)],
        "shipment_id int, carrier_id int, lane_id int, actual_ship_date date, "
        "shipment_weight_kg double"), ["shipment_weight_kg"])
    cards = spark.createDataFrame([
        (1, 1, 1, D(2020, 1, 1), D(2099, 12, 31)), (2, 1, 2, D(2020, 1, 1), D(2020, 12, 31))],
        "rate_id int, carrier_id int, lane_id int, effective_start_date date, "
        "effective_end_date date").withColumns({
            "rate_basis": F.lit("PER_KG"), "currency": F.lit("USD"),
            "rate_per_kg": F.lit("10").cast("decimal(12,4)"),
            "minimum_charge": F.lit("120").cast("decimal(12,2)"),
            "fuel_percentage": F.lit("0.2").cast("decimal(6,4)")})
    expected = freight_audit.expected_freight(ship, cards)
    bills = [
        (1, "A", 1, 1, 1000.0, 200.0, 1200.0, "USD"), (2, "A", 1, 1, 1000.0, 200.0, 1200.0, "USD"),
        (3, "C", 1, 1, 1200.0, 200.0, 1400.0, "USD"), (4, "D", 1, 1, 800.0, 200.0, 1000.0, "USD"),
        (5, "E", 1, 1, 1000.0, 320.0, 1320.0, "USD"), (6, "F", 1, 2, 1000.0, 200.0, 1200.0, "USD"),
        (7, "G", 1, 1, 1000.0, 200.0, 1200.0, "EUR"), (8, "H", 2, 1, 50.0, 10.0, 60.0, "USD"),
        (9, "I", 3, 1, 50.0, 10.0, 60.0, "USD"), (10, "J", 77, 1, 50.0, 10.0, 60.0, "USD"),
        (11, "K", 1, 1, 1055.0, 205.0, 1260.0, "USD"), (12, "L", 4, 1, 9.0, 1.0, 10.0, "USD")]
    inv = _dec(spark.createDataFrame(
        bills, "invoice_id int, invoice_number string, shipment_id int, carrier_id int, "
               "base_charge double, fuel_surcharge double, invoice_total double, "
               "currency string").withColumns({"accessorial_charge": F.lit(0.0),
                                               "tax_amount": F.lit(0.0)}),
        ["base_charge", "fuel_surcharge", "invoice_total", "accessorial_charge", "tax_amount"])
    acc = _dec(spark.createDataFrame(
        [(1, 99, 1, "STORAGE", 10.0, 1, 1)],
        "accessorial_id int, invoice_id int, shipment_id int, charge_type string, "
        "charge_amount double, contractually_allowed_flag int, supporting_document_flag int"),
        ["charge_amount"], "decimal(12,2)")
    return ship, inv, freight_audit.audit_invoices(inv, expected, acc, CFG)


def test_audit_statuses_follow_their_order(spark):
    _, _, audit = _audit(spark)
    rows = {r["invoice_id"]: r for r in audit.collect()}
    assert {i: r["audit_status"] for i, r in rows.items()} == {
        1: "MATCHED", 2: "DUPLICATE_INVOICE", 3: "POTENTIAL_OVERCHARGE",
        4: "POTENTIAL_UNDERCHARGE", 5: "INCORRECT_FUEL_SURCHARGE", 6: "CARRIER_MISMATCH",
        7: "INCORRECT_CURRENCY", 8: "EXPIRED_RATE", 9: "MISSING_RATE", 10: "SHIPMENT_MISMATCH",
        11: "MATCHED", 12: "MISSING_RATE"}
    # Unrated means unknown, never zero; 60 over is within the absolute threshold.
    assert rows[8]["expected_total"] is None and rows[8]["is_material"] is None
    assert rows[11]["is_material"] == 0 and float(rows[3]["overcharge_amount"]) == 200.0
    assert float(rows[4]["undercharge_amount"]) == 200.0


def test_three_way_match(spark):
    ship, inv, audit = _audit(spark)
    ship = ship.withColumns({
        "po_id": F.when(F.col("shipment_id") == 2, 500).otherwise(100),
        "product_id": F.lit(1), "planned_quantity": F.lit(5), "delivered_quantity": F.lit(5)})
    po = spark.createDataFrame([(100, 1)], "po_id int, product_id int")
    got = {r["invoice_id"]: r for r in matching.three_way_match(
        matching.match_components(inv, ship, po, audit, "USD")).collect()}
    assert len(got) == 12
    status = {i: r["overall_match_status"] for i, r in got.items()}
    assert status[1] == "MATCHED" and status[2] == "BLOCK_PAYMENT" and status[6] == "BLOCK_PAYMENT"
    assert status[3] == "REVIEW_REQUIRED" and status[4] == "MATCHED_WITH_WARNING"
    assert status[8] == "MISSING_RECORD" and status[10] == "MISSING_RECORD"
    # A shipment without a carrier cannot be mismatched.
    assert got[12]["carrier_match_status"] == "UNKNOWN"
    assert got[9]["exception_reason"] == "Rate issue: MISSING_RATE"


def test_accessorial_audit(spark):
    acc = _dec(spark.createDataFrame(
        [(1, "STORAGE", 1500.0, 1, 1), (2, "STORAGE", 100.0, 0, 1), (3, "STORAGE", 100.0, 1, 0),
         (4, "STORAGE", 100.0, 1, 1), (5, "OTHER", 9e5, 1, 1)],
        "accessorial_id int, charge_type string, charge_amount double, "
        "contractually_allowed_flag int, supporting_document_flag int"),
        ["charge_amount"], "decimal(12,2)").withColumns({"invoice_id": F.lit(1),
                                                         "shipment_id": F.lit(1)})
    got = {r["accessorial_id"]: (r["accessorial_status"], float(r["recoverable_amount"]))
           for r in freight_audit.audit_accessorials(acc, CFG.accessorial_bands).collect()}
    assert got == {1: ("EXCESSIVE", 300.0), 2: ("UNAUTHORIZED", 100.0), 3: ("UNSUPPORTED", 0.0),
                   4: ("ALLOWED", 0.0), 5: ("ALLOWED", 0.0)}


def test_accruals(spark):
    expected = _dec(spark.createDataFrame([(1, 100.0, 10.0), (2, 100.0, 10.0), (3, None, None)],
                                          "shipment_id int, expected_base double, "
                                          "expected_fuel double"),
                    ["expected_base", "expected_fuel"])
    ship = spark.createDataFrame([
        (1, "DELIVERED", D(2025, 6, 10), D(2025, 6, 1)), (2, "IN_TRANSIT", None, D(2025, 8, 3)),
        (3, "DELIVERED", D(2025, 6, 10), D(2025, 6, 1))],
        "shipment_id int, shipment_status string, actual_delivery_date date, "
        "planned_delivery_date date")
    inv = _dec(spark.createDataFrame([(1, D(2025, 7, 4), 120.0, "APPROVED")],
                                     "shipment_id int, invoice_date date, invoice_total double, "
                                     "approval_status string"), ["invoice_total"])
    got = {r["shipment_id"]: r for r in accruals.build_accruals(
        expected, ship, inv, CFG.as_of, 5).collect()}
    assert set(got) == {1, 2}
    # Dated after as-of but within the lag after period end: still received.
    assert got[1]["accrual_status"] == "RELEASED" and float(got[1]["accrual_variance"]) == 10.0
    assert got[2]["accounting_period"] == "2025-08" and got[2]["accrual_status"] == "ACCRUED"


# -- quality --------------------------------------------------------------------------------
def test_reconcile_counts_distinct_records_of_both_sides(spark):
    manifest = spark.createDataFrame(
        [("a", "1", "HIGH"), ("a", "1", "HIGH"), ("a", "2", "HIGH"), ("b", "9", "CRITICAL")],
        "exception_type string, record_id string, severity string")
    seen = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "7"), ("c", "3")],
                                 "exception_type string, record_id string")
    got = {r["exception_type"]: r for r in detection.reconcile(manifest, seen).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["true_positive_count"], a["false_positive_count"], a["false_negative_count"]) == \
        (1, 1, 1)
    assert (a["precision_pct"], a["recall_pct"], a["f1_score"]) == (50.0, 50.0, 0.5)
    assert b["precision_pct"] is None and b["recall_pct"] == 0 and b["f1_score"] == 0
    assert c["coverage_status"] == detection.CONTROL_ONLY and c["recall_pct"] is None
    perf = detection.reconcile(manifest, seen)
    with pytest.raises(RuntimeError):
        detection.require_recall(perf, CFG)


def test_inactive_and_custom_rules(spark):
    products = spark.createDataFrame([(1, None), (2, "x")], "product_id int, hts_code string")
    rule = rules.RULE_BY_ID["DQ09"]
    off = rules.Rule(**{**rule.__dict__, "rule_id": "X1", "active": False})
    mine = rules.Rule(**{**rule.__dict__, "rule_id": "X2", "check": rules.RowCheck(
        "product", None, lambda s: F.col("product_id") > 1)})
    hits = rules.violations({"dim_product": products}, CFG, [rule, off, mine]).collect()
    assert sorted((r["rule_id"], r["record_id"]) for r in hits) == [("DQ09", "1"), ("X2", "2")]


def test_registry_is_complete(spark):
    rows = detection.registry(spark).collect()
    assert len(rows) == 25 and len({r["rule_id"] for r in rows}) == 25
    owners = {r["exception_type"]: r["business_owner"] for r in rows}
    assert owners["missing_required_milestone"] == "Logistics Analytics"


def test_report_grades(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    lines = validation.grade(validation.report(df, [
        validation.Check("pk", "CRITICAL", F.count(F.lit(1)),
                         F.count(F.lit(1)) - F.countDistinct("k"))]))
    row = lines.first()
    assert (row["records_tested"], row["failures"], row["status"]) == (3, 2, "FAIL")
    with pytest.raises(RuntimeError):
        validation.require_baseline(lines)


# -- scores -----------------------------------------------------------------------------------
def test_peer_scores(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "x double, y double")
    rows = scorecards.peer_scores(df, F.lit(True), {
        "up": ("x", True), "down": ("x", False), "flat": ("y", True)}).orderBy("x").collect()
    assert [r["up"] for r in rows] == [0, 50, 100] and [r["down"] for r in rows] == [100, 50, 0]
    assert [r["flat"] for r in rows] == [100, 100, None]


def _carriers(spark):
    cols = ("carrier_id string, shipment_count int, otif_pct double, "
            "transit_reliability_pct double, cost_per_kg double, invoice_accuracy_pct double, "
            "pod_compliance_pct double, claims_rate_pct double")
    return spark.createDataFrame([("A", 100, 95., 95., 1., 99., 99., 1.),
                                  ("B", 100, 80., 80., 2., 90., 90., 3.),
                                  ("C", 10, 99., 99., 0.1, 99., 99., 0.)], cols)


def test_carrier_scorecard(spark):
    got = {r["carrier_id"]: r for r in scorecards.carrier_scorecard(
        _carriers(spark), CFG).collect()}
    assert (got["A"]["total_score"], got["A"]["carrier_rank"]) == (100.0, 1)
    assert (got["B"]["total_score"], got["B"]["carrier_rank"]) == (0.0, 2)
    assert got["C"]["carrier_rank"] is None
    assert got["C"]["classification"] == "Insufficient volume"
    assert got["B"]["classification"] == "Critical review"
    with pytest.raises(ValueError):
        scorecards.carrier_scorecard(_carriers(spark), Settings(
            as_of=CFG.as_of, score_weights={**CFG.score_weights, "otif": 0.5}))


def test_worst_month_needs_volume(spark):
    monthly = spark.createDataFrame(
        [("2024-01", 50, 90.0), ("2024-02", 5, 10.0), ("2024-03", 50, 80.0), ("2024-04", 50, 79.0)],
        "reporting_month string, delivered_count int, otif_pct double")
    row = worst_month(otif_trend(monthly, CFG)).first()
    assert (row["reporting_month"], row["otif_change_pp"]) == ("2024-03", -10.0)


# -- marts, measures, dashboards ----------------------------------------------------------------
def test_date_dimension(spark):
    base = spark.createDataFrame([(D(2024, 12, 28), D(2025, 1, 6))],
                                 "planned_ship_date date, planned_delivery_date date")
    rows = {r["date"]: r for r in marts.date_dimension(base).collect()}
    assert len(rows) == 10
    last = rows[D(2024, 12, 31)]
    assert (last["date_key"], last["quarter"], last["month_end_flag"]) == (20241231, "Q4", 1)
    assert (last["week_of_year"], last["week_start_date"]) == (1, D(2024, 12, 30))
    assert rows[D(2025, 1, 4)]["weekend_flag"] == 1 and rows[D(2025, 1, 6)]["weekend_flag"] == 0


def test_measures_divide_safely(spark):
    base = _base(spark).filter("shipment_id = 3")
    row = measures.measure(base, measures.shipment_measures()).first()
    assert row["shipment_count"] == 1 and row["otif_share"] is None


def test_ledger_flags_a_difference(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "metric string, value double")
    b = spark.createDataFrame([("x", 1.0), ("y", 2.5)], "metric string, value double")
    got = {r["metric"]: r["match"] for r in dashboards.reconciliation_ledger(a, b).collect()}
    assert got == {"x": "PASS", "y": "FAIL"}


# -- sources --------------------------------------------------------------------------------------
def test_raw_csv_is_text_without_bom(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('﻿ID,Name\n1,"a, b"\n007,x\n', encoding="utf-8")
    rows = files.read_raw(spark, str(path), ["ID", "Name"]).collect()
    assert [(r["ID"], r["Name"]) for r in rows] == [("1", "a, b"), ("007", "x")]


def test_layer_round_trip_and_refresh(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for _ in range(2):
        back = files.export_csv({"t": df}, str(tmp_path / "csv"))
    assert back["t"].count() == 2
    at = str(tmp_path / "pq")
    first = files.write_layer({"t": df, "u": df.limit(1)}, at)
    files.write_layer({"t": df.limit(0)}, at)
    assert files.read_layer(spark, at)["t"].count() == 0
    assert files.read_layer(spark, at, first)["t"].count() == 2
    assert files.missing_inputs(["a", "b"], ["b"]) == ["a"]
    assert validation.required_outputs(spark, ["no_such_table"]) == ["no_such_table"]


def test_a_refresh_that_stops_leaves_the_old_rows(spark, tmp_path):
    at, df = str(tmp_path / "layer"), spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    with pytest.raises(FileNotFoundError):
        files.read_layer(spark, at)
    files.write_layer({"t": df, "u": df}, at)
    broken = df.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="lost"):
        files.write_layer({"t": df.limit(1), "u": broken}, at)
    assert {n: t.count() for n, t in files.read_layer(spark, at).items()} == {"t": 2, "u": 2}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_lost_or_changed_file_fails_the_check(spark, tmp_path, fmt):
    at = str(tmp_path / "layer")
    df = spark.createDataFrame([(i, f"n{i}" if i % 3 else "", i / 7, D(2024, 1, 1 + i)) for i in range(20)], "k int, v string, x double, d date").repartition(4)
    version = files.write_layer({"t": df, "u": df}, at, fmt)
    assert {r["table_name"]: (r["rows_found"], r["identical"]) for r in files.check_layer(spark, at).collect()} == {"t": (20, 1), "u": (20, 1)}
    next((tmp_path / "layer" / version / "t").glob("part-*")).unlink()
    spark.catalog.refreshByPath(f"{at}/{version}/t")
    found = {r["table_name"]: (r["rows_found"] < 20, r["identical"]) for r in files.check_layer(spark, at).collect()}
    assert found == {"t": (True, 0), "u": (False, 1)}
    gate = validation._gate(files.check_layer(spark, at), "exports_as_written", F.min("identical") == 1).first()
    assert gate["status"] == "FAIL"


def test_dates_by_column_name(spark):
    df = spark.createDataFrame([("2024-02-01", "bad", "2024-02-01 10:00:00")],
                               "a_date string, b_date string, c_timestamp string")
    row = files.coerce_dates(df).first()
    assert (row["a_date"], row["b_date"]) == (D(2024, 2, 1), None)
    assert row["c_timestamp"].hour == 10


def test_lookup_tables(spark):
    tables = files.lookup_tables(spark, CFG)
    assert tables["meta_accessorial_band"].count() == 5
    weights = tables["meta_scorecard_weight"].agg(F.sum("weight")).first()[0]
    assert abs(weights - 1.0) < 1e-9


@pytest.mark.parametrize("split", ["1g", "16b"])
def test_records_with_line_breaks_and_faults(spark, tmp_path, split):
    (tmp_path / "a.csv").write_text('﻿id,a,b\n1,"two\nlines","x ""q"" y"\n2,b,c,surplus\n3,only\n\n5,p,q\r\n6,"m\r\n\nn",z\n7,,"\n"\n8,"a""",\n', encoding="utf-8",
                                    newline="")
    (tmp_path / "b.csv").write_text('id,a,b\n10,x,y\n11,"x,1",y')
    (tmp_path / "c.csv").write_text('id,a,b\n20,"open,z\n21,x,y\n"22,x,y\n"23,x,y\n24,x,y\n' + "25,x,y\n" * 9)
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1b"}
    was = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = read_records(spark, str(tmp_path), ["id", "a", "b"], max_lines=6)
        got = sorted((tuple(r) for r in rows.collect()), key=repr)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    good = [r[:3] for r in got if r[3] is None]
    assert sorted(good, key=repr) == sorted([
        ("1", "two\nlines", 'x "q" y'), ("5", "p", "q"), ("6", "m\n\nn", "z"), ("7", None, "\n"), ("8", 'a"', None), ("10", "x", "y"),
        ("11", "x,1", "y"), ("21", "x", "y"), ("24", "x", "y"), *[("25", "x", "y")] * 9], key=repr)
    assert sorted(r[3] for r in got if r[3] is not None) == ['"22,x,y', '"23,x,y', "2,b,c,surplus", '20,"open,z', "3,only"]
    assert read_records(spark, str(tmp_path / "b.csv"), ["id", "a", "b"], header=False).count() == 3


def test_malformed_records_reach_the_ledger(spark, tmp_path):
    row = ["1"] + ["x"] * (len(staging.RAW_COLUMNS) - 1)
    good = dict(zip(staging.RAW_COLUMNS, row)) | {"Scheduled Delivery Date": "2-Jun-06", "Delivered to Client Date": "3-Jun-06",
                                                  "Line Item Quantity": "4", "Vendor": '"two\nlines"'}
    line = ",".join(good.values())
    (tmp_path / "raw.csv").write_text(",".join(staging.RAW_COLUMNS) + f"\n{line}\n{line},surplus\n1,short\n")
    judged = staging.judge(files.read_raw(spark, str(tmp_path / "raw.csv")))
    assert staging.accepted(judged).select("ID", "Vendor").collect() == [("1", "two\nlines")]
    ledger = staging.reject_ledger(judged, CFG.as_of)
    assert {r["rejection_reason"] for r in ledger.collect()} == {"malformed record"}
    assert "1,short" in {r["raw_payload"] for r in ledger.collect()} and ledger.count() == 3
