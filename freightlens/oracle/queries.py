"""DuckDB statement of every query, composed from the model CTEs."""

from __future__ import annotations

from freightlens.oracle import staged
from freightlens.oracle.model import AS_OF, RULE_SQL, compose, rule_hits

_SELECTS: dict[str, str] = {}


def _money(table: str, columns: str, where: str = "") -> str:
    swaps = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({swaps}) FROM {table} {where}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


_BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
         "benchmark", "labels", "conversations"]
_SELECTS["table_counts"] = _union(
    [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _BASE])
_SELECTS["parameterised_query"] = """
SELECT o_orderstatus, COUNT(*) AS order_count FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-10' GROUP BY 1"""
_SELECTS["coerce_date_columns"] = """
SELECT event_id, CASE WHEN event_id % 7 <> 3 THEN CAST(ts AS DATE) END AS event_date FROM events"""
_SELECTS["layer_rerun_identical"] = """
SELECT (SELECT COUNT(*) FROM fact_shipment) AS left_rows, (SELECT COUNT(*) FROM fact_shipment) AS right_rows,
  CAST((SELECT COUNT(*) FROM (SELECT * FROM fact_shipment EXCEPT ALL SELECT * FROM fact_shipment)) = 0 AS INTEGER) AS identical"""
# Columns of the sources in their order: fractions as ten-thousandths, times to the second.
_TEXTS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "*o_totalprice", "@o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "*c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "*p_retailprice"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"], "region": ["r_regionkey", "r_name"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "*s_acctbal"],
}


def _content(table: str) -> str:
    def text(c: str) -> str:
        kinds = {"*": "CAST(ROUND({} * 10000) AS BIGINT)", "@": "strftime({}, '%Y-%m-%d %H:%M:%S')"}
        return f"COALESCE(CAST({kinds.get(c[0], '{}').format(c.lstrip('*@'))} AS VARCHAR), '~')"

    row = ", ".join(map(text, _TEXTS[table]))
    return (f"SELECT '{table}' AS source_name, COUNT(*) AS row_count, CAST(COALESCE(SUM(CAST(CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 12) "
            f"AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS content_sum FROM {table}")


_SELECTS["source_provenance"] = _union([_content(t) for t in ("orders", "customer", "part")])
_SELECTS["refreshed_layer"] = _union([_content(t) for t in ("nation", "region", "supplier")])
_SELECTS["typed_csv"] = "SELECT * FROM customer"

# -- conforming -----------------------------------------------------------------------
_SELECTS["invoice_lines"] = _money("fact_invoice_line", "amount")
_SELECTS["accrual_build"] = _money(
    "fact_accrual", "expected_freight_cost actual_invoice_cost accrual_variance")
_HASH = "CAST('0x' || substr(md5('42:{salt}:' || CAST({key} AS VARCHAR)), 1, 12) AS BIGINT)"
_SELECTS["hash_draw"] = (
    f"SELECT shipment_id, {_HASH.format(salt='audit', key='shipment_id')} AS hash, "
    f"{_HASH.format(salt='audit', key='shipment_id')} / 281474976710656.0::DOUBLE AS draw FROM fact_shipment")

# -- sampling ---------------------------------------------------------------------------
_SELECTS["hash_sample"] = f"""
SELECT shipment_id FROM (SELECT shipment_id, ROW_NUMBER() OVER (
  ORDER BY {_HASH.format(salt='missing_carrier_id', key='shipment_id')}, shipment_id) AS r FROM done_ship)
WHERE r <= (SELECT GREATEST(1, ROUND(COUNT(*) * 0.01)) FROM done_ship)"""
_SELECTS["disjoint_samples"] = f"""
SELECT shipment_id, exception_type FROM (
  SELECT shipment_id, 'missing_carrier_id' AS exception_type FROM (SELECT shipment_id, ROW_NUMBER() OVER (
    ORDER BY {_HASH.format(salt='missing_carrier_id', key='shipment_id')}, shipment_id) AS r FROM done_ship)
  WHERE r <= (SELECT GREATEST(1, ROUND(COUNT(*) * 0.01)) FROM done_ship))
UNION ALL
SELECT shipment_id, 'invalid_lane' FROM (SELECT shipment_id, ROW_NUMBER() OVER (
  ORDER BY {_HASH.format(salt='invalid_lane', key='shipment_id')}, shipment_id) AS r FROM done_ship
  WHERE shipment_id NOT IN (SELECT shipment_id FROM (SELECT shipment_id, ROW_NUMBER() OVER (
    ORDER BY {_HASH.format(salt='missing_carrier_id', key='shipment_id')}, shipment_id) AS r FROM done_ship)
    WHERE r <= (SELECT GREATEST(1, ROUND(COUNT(*) * 0.01)) FROM done_ship)))
WHERE r <= (SELECT GREATEST(1, ROUND(COUNT(*) * 0.008)) FROM done_ship)"""
_NOW = """SELECT shipment_id AS k, carrier_id AS c, lane_id AS l FROM fact_shipment WHERE shipment_id % 700 <> 5"""
_WAS = """SELECT shipment_id AS k, COALESCE(carrier_id, supplier_id % 12) AS c,
  CASE WHEN lane_id = 9999 THEN destination_location_id * 4 + list_position(['AIR', 'TRUCK', 'OCEAN', 'AIR_CHARTER'], shipment_mode) - 1
    ELSE lane_id END AS l FROM fact_shipment WHERE shipment_id % 500 <> 3"""
_DIFF = f"""
SELECT CAST(COALESCE(b.k, a.k) AS VARCHAR) AS record_id, 'INSERTED' AS change, 'shipment_id' AS column_name,
  CAST(NULL AS VARCHAR) AS clean_value, CAST(a.k AS VARCHAR) AS new_value FROM ({_NOW}) a LEFT JOIN ({_WAS}) b ON a.k = b.k WHERE b.k IS NULL
UNION ALL SELECT CAST(b.k AS VARCHAR), 'DELETED', 'shipment_id', CAST(b.k AS VARCHAR), NULL
FROM ({_WAS}) b LEFT JOIN ({_NOW}) a ON a.k = b.k WHERE a.k IS NULL
UNION ALL SELECT CAST(b.k AS VARCHAR), 'UPDATED', 'carrier_id', CAST(b.c AS VARCHAR), CAST(a.c AS VARCHAR)
FROM ({_WAS}) b JOIN ({_NOW}) a ON a.k = b.k WHERE a.c IS DISTINCT FROM b.c
UNION ALL SELECT CAST(b.k AS VARCHAR), 'UPDATED', 'lane_id', CAST(b.l AS VARCHAR), CAST(a.l AS VARCHAR)
FROM ({_WAS}) b JOIN ({_NOW}) a ON a.k = b.k WHERE a.l IS DISTINCT FROM b.l"""
_SELECTS["table_diff"] = _DIFF
_BUCKET = "CAST('0x' || substr(md5(CAST(k AS VARCHAR)), 1, 4) AS INTEGER)"
_SELECTS["unequal_buckets"] = f"""
SELECT bucket, CAST(SUM(was) AS BIGINT) AS left_rows, CAST(SUM(1 - was) AS BIGINT) AS right_rows
FROM (SELECT {_BUCKET} AS bucket, 1 AS was FROM ({_WAS}) UNION ALL SELECT {_BUCKET}, 0 FROM ({_NOW}))
WHERE bucket IN (SELECT {_BUCKET} FROM (({_WAS} EXCEPT {_NOW}) UNION ALL ({_NOW} EXCEPT {_WAS}))) GROUP BY bucket"""
_SELECTS["diff_summary"] = f"""
SELECT change, column_name, COUNT(*) AS cells, COUNT(DISTINCT record_id) AS records FROM ({_DIFF}) GROUP BY change, column_name"""
# Fault rates.
_RATES = {
    "missing_carrier_id": 0.010, "invalid_lane": 0.008, "duplicate_invoice": 0.012,
    "missing_pod": 0.040, "expired_rate_card": 0.015, "invoice_carrier_mismatch": 0.010,
    "delivery_before_ship": 0.004, "over_delivery": 0.008, "unauthorized_detention": 0.015,
    "excessive_demurrage": 0.010, "incorrect_fuel_surcharge": 0.020,
    "shipment_without_invoice": 0.030, "invoice_without_shipment": 0.006,
    "duplicate_payment_risk": 0.005, "incorrect_currency": 0.006, "missing_hts_code": 0.020,
    "missing_customs_doc": 0.015, "partial_delivery": 0.020, "damaged_shipment_claim": 0.012,
}
_RATE_ROWS = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in _RATES.items())
_POOLS = {
    "done_ship": "missing_carrier_id invalid_lane missing_pod delivery_before_ship over_delivery partial_delivery shipment_without_invoice damaged_shipment_claim",
    "fact_freight_invoice": "duplicate_invoice expired_rate_card invoice_carrier_mismatch incorrect_fuel_surcharge invoice_without_shipment "
                            "duplicate_payment_risk incorrect_currency",
    "done_ship WHERE customs_required_flag = 1 AND shipment_mode IN ('AIR', 'AIR_CHARTER', 'OCEAN', 'MULTIMODAL')": "missing_customs_doc",
    "done_ship WHERE shipment_mode IN ('TRUCK', 'OCEAN', 'MULTIMODAL')": "unauthorized_detention",
    "done_ship WHERE shipment_mode IN ('OCEAN', 'MULTIMODAL')": "excessive_demurrage", "dim_product": "missing_hts_code",
}
_POOL_ROWS = _union([f"SELECT '{k}' AS exception_type, {_RATES[k]}::DOUBLE AS rate, (SELECT COUNT(*) FROM {pool}) AS n"
                     for pool, kinds in _POOLS.items() for k in kinds.split()])
_SELECTS["fault_summary"] = f"""
SELECT p.exception_type, n AS eligible_records, rate AS configured_rate,
  CAST(LEAST(n, GREATEST(LEAST(1, n), ROUND(n * rate))) AS BIGINT) AS expected_count, COALESCE(c, 0) AS actual_count
FROM ({_POOL_ROWS}) p LEFT JOIN (SELECT exception_type, COUNT(*) AS c FROM manifest GROUP BY 1) m ON m.exception_type = p.exception_type"""
_GONE = "(SELECT invoice_id FROM fact_freight_invoice WHERE shipment_id % 33 = 2)"
_SELECTS["cascade_delete"] = _union([
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t} WHERE invoice_id NOT IN {_GONE}"
    for t in ("fact_invoice_line", "fact_invoice_approval", "fact_accessorial_charge")])
_SELECTS["last_customs_milestone"] = """
SELECT shipment_id, MAX(milestone_sequence) AS milestone_sequence, ARG_MAX(milestone_id, milestone_sequence) AS milestone_id
FROM fact_shipment_milestone WHERE milestone_type IN ('EXPORT_CUSTOMS', 'IMPORT_CUSTOMS') GROUP BY shipment_id"""

# -- data quality -----------------------------------------------------------------------
for _id, (_type, _, _) in RULE_SQL.items():
    _SELECTS[f"{_id.lower()}_{_type}"] = rule_hits(_id)
_SELECTS["dq_detected"] = """
SELECT rule_id, rule_name, rule_category, severity, business_owner, exception_type, expected_resolution_sla_hours,
  record_id, record_type, reference_date, exception_description, 'operational' AS source_layer
FROM dq_hits JOIN dq_rule USING (rule_id)"""
_SELECTS["dq_materialized"] = """
SELECT * EXCLUDE (rule_category, expected_resolution_sla_hours, severity_weight) FROM dq_found"""
_SELECTS["dq_reconcile"] = "SELECT * FROM dq_performance"
_GATES = """
SELECT ROUND(tp * 100.0::DOUBLE / NULLIF(tp + fp, 0), 2) AS precision_pct, ROUND(tp::DOUBLE / NULLIF(tp + fn, 0) * 100, 2) AS overall_recall_pct,
  ROUND(ctp::DOUBLE / GREATEST(1, ctp + cfn) * 100, 2) AS critical_recall_pct,
  CAST(tp::DOUBLE / NULLIF(tp + fn, 0) >= 0.95 AS INTEGER) AS overall_gate,
  CAST(ctp::DOUBLE / GREATEST(1, ctp + cfn) >= 1.0 AS INTEGER) AS critical_gate
FROM (SELECT SUM(true_positive_count) AS tp, SUM(false_positive_count) AS fp, SUM(false_negative_count) AS fn,
  COALESCE(SUM(CASE WHEN severity = 'CRITICAL' THEN true_positive_count END), 0) AS ctp,
  COALESCE(SUM(CASE WHEN severity = 'CRITICAL' THEN false_negative_count END), 0) AS cfn
  FROM dq_performance WHERE manifest_count > 0)"""
_SELECTS["dq_recall_gates"] = _GATES
_SCORE = """
SELECT CAST(w AS BIGINT) AS weighted_open, n AS shipment_count, ROUND(GREATEST(0.0, 1 - w::DOUBLE / (n * 10)) * 100, 2) AS dq_score_pct
FROM (SELECT (SELECT SUM(severity_weight) FROM dq_found WHERE resolution_status = 'OPEN') AS w, (SELECT COUNT(*) FROM fact_shipment) AS n)"""
_SELECTS["dq_score"] = _SCORE
_SELECTS["dq_sla_by_owner"] = """
SELECT business_owner, COUNT(*) AS exception_count,
  COUNT(CASE WHEN exception_age_days * 24 > expected_resolution_sla_hours THEN 1 END) AS sla_breach_count
FROM dq_found GROUP BY business_owner"""
_SELECTS["dq_severity"] = """
SELECT severity, COUNT(*) AS detected_count, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS severity_order
FROM dq_found GROUP BY severity"""


def _check(name: str, severity: str, tested: str, failures: str, source: str) -> str:
    return (f"SELECT '{name}' AS validation_name, CAST({tested} AS BIGINT) AS records_tested, "
            f"CAST(COALESCE({failures}, 0) AS BIGINT) AS failures, '{severity}' AS severity FROM {source}")


_PK = {
    "dim_location": "location_id", "dim_product": "product_id", "dim_carrier": "carrier_id",
    "dim_lane": "lane_id", "dim_supplier": "supplier_id", "dim_rate_card": "rate_id",
    "fact_purchase_order": "po_id", "fact_shipment": "shipment_id",
    "fact_shipment_milestone": "milestone_id", "fact_freight_invoice": "invoice_id",
    "fact_invoice_line": "invoice_line_id", "fact_accessorial_charge": "accessorial_id",
    "fact_proof_of_delivery": "pod_id", "fact_claim": "claim_id",
    "fact_carrier_capacity": "capacity_id", "fact_invoice_approval": "approval_id",
    "fact_accrual": "accrual_id",
}
_FK = [
    ("fk_shipment_carrier", "fact_shipment", "carrier_id", "dim_carrier", "CRITICAL"),
    ("fk_shipment_lane", "fact_shipment", "lane_id", "dim_lane", "CRITICAL"),
    ("fk_shipment_product", "fact_shipment", "product_id", "dim_product", "CRITICAL"),
    ("fk_shipment_po", "fact_shipment", "po_id", "fact_purchase_order", "CRITICAL"),
    ("fk_shipment_origin", "fact_shipment", "origin_location_id", "dim_location", "HIGH"),
    ("fk_shipment_destination", "fact_shipment", "destination_location_id", "dim_location", "HIGH"),
    ("fk_invoice_shipment", "fact_freight_invoice", "shipment_id", "fact_shipment", "CRITICAL"),
    ("fk_invoice_line_invoice", "fact_invoice_line", "invoice_id", "fact_freight_invoice", "CRITICAL"),
    ("fk_accessorial_invoice", "fact_accessorial_charge", "invoice_id", "fact_freight_invoice", "HIGH"),
    ("fk_pod_shipment", "fact_proof_of_delivery", "shipment_id", "fact_shipment", "CRITICAL"),
    ("fk_claim_shipment", "fact_claim", "shipment_id", "fact_shipment", "HIGH"),
    ("fk_accrual_shipment", "fact_accrual", "shipment_id", "fact_shipment", "HIGH"),
    ("fk_milestone_shipment", "fact_shipment_milestone", "shipment_id", "fact_shipment", "CRITICAL"),
    ("fk_approval_invoice", "fact_invoice_approval", "invoice_id", "fact_freight_invoice", "HIGH"),
]
_N = "COUNT(*)"


def _if(test: str) -> str:
    return f"COUNT(CASE WHEN {test} THEN 1 END)"


_DONE = "shipment_status = 'DELIVERED'"
_SHIP = """(SELECT s.*, l.transport_mode AS lane_mode, c.primary_mode AS pool_mode, e.rate_status
  FROM fact_shipment s LEFT JOIN dim_lane l ON l.lane_id = s.lane_id LEFT JOIN dim_carrier c ON c.carrier_id = s.carrier_id
  LEFT JOIN expected_freight e ON e.shipment_id = s.shipment_id)"""
_INV_RATE = """(SELECT i.*, s.carrier_id AS ship_carrier, i.base_charge + i.fuel_surcharge AS got,
  CASE WHEN e.rate_per_kg * e.shipment_weight_kg > e.minimum_charge THEN e.rate_per_kg * e.shipment_weight_kg ELSE e.minimum_charge END AS gross,
  e.fuel_percentage AS fp FROM fact_freight_invoice i JOIN fact_shipment s ON s.shipment_id = i.shipment_id
  JOIN expected_freight e ON e.shipment_id = i.shipment_id)"""
_CHECKS = [_check(f"pk_unique[{t}]", "CRITICAL", _N, f"COUNT(*) - COUNT(DISTINCT {k})",
                  t if t != "dim_supplier" else "(SELECT s_suppkey AS supplier_id FROM supplier)")
           for t, k in _PK.items()]
_CHECKS += [_check(n, sev, _N, f"COUNT(CASE WHEN {c} IS NOT NULL AND {c} NOT IN (SELECT {_PK[p]} FROM {p}) THEN 1 END)", t)
            for n, t, c, p, sev in _FK]
_CHECKS += [_check(*c, _SHIP) for c in [
    ("required_shipment_carrier", "CRITICAL", _N, _if("carrier_id IS NULL")),
    ("required_shipment_lane", "CRITICAL", _N, _if("lane_id IS NULL")),
    ("required_shipment_product", "HIGH", _N, _if("product_id IS NULL")),
    ("date_booking_le_ship", "HIGH", _N, _if("booking_date > actual_ship_date")),
    ("date_ship_le_delivery", "CRITICAL", _if(_DONE), _if(f"{_DONE} AND actual_ship_date > actual_delivery_date")),
    ("date_planned_ship_le_planned_delivery", "HIGH", _N, _if("planned_ship_date > planned_delivery_date")),
    ("delivered_le_shipped", "MEDIUM", "COUNT(delivered_quantity)", _if("delivered_quantity > shipped_quantity")),
    ("carrier_in_lane_mode_pool", "HIGH", _N, _if("NOT COALESCE(pool_mode = lane_mode, FALSE)")),
    ("shipment_mode_matches_lane", "MEDIUM", _N, _if("NOT COALESCE(shipment_mode = lane_mode, FALSE)")),
    ("delivered_shipment_has_invoice", "CRITICAL", _if(_DONE),
     _if(f"{_DONE} AND shipment_id NOT IN (SELECT shipment_id FROM fact_freight_invoice)")),
    ("pod_for_delivered", "HIGH", _if(_DONE), _if(f"{_DONE} AND shipment_id NOT IN (SELECT shipment_id FROM fact_proof_of_delivery)")),
    ("rate_covers_ship_date", "HIGH", _N, _if("rate_status <> 'RATED'")),
    ("shipment_lineage_to_source", "CRITICAL", _N, _if("source_record_id NOT IN (SELECT o_orderkey FROM orders)")),
]]
_CHECKS += [
    _check("shipped_qty_le_po_qty", "HIGH", _N, _if("shipped > ordered_quantity"),
           "(SELECT g.po_id, shipped, ordered_quantity FROM (SELECT po_id, SUM(shipped_quantity) AS shipped FROM fact_shipment "
           "GROUP BY po_id) g LEFT JOIN fact_purchase_order o ON o.po_id = g.po_id)"),
    _check("milestone_timestamp_monotonic", "HIGH", _N, _if("actual_timestamp < prev"),
           "(SELECT actual_timestamp, LAG(actual_timestamp) OVER (PARTITION BY shipment_id ORDER BY milestone_sequence) AS prev "
           "FROM fact_shipment_milestone WHERE milestone_status = 'COMPLETED')"),
    _check("required_invoice_number", "CRITICAL", _N, _if("invoice_number IS NULL"), "fact_freight_invoice"),
    _check("invoice_total_reconciles", "CRITICAL", _N,
           _if("ABS(base_charge + fuel_surcharge + accessorial_charge + tax_amount - invoice_total) > 0.01"), "fact_freight_invoice"),
    _check("invoice_lines_sum_to_total", "HIGH", _N, _if("ABS(invoice_total - COALESCE(s, 0)) > 0.01"),
           "(SELECT i.*, s FROM fact_freight_invoice i LEFT JOIN (SELECT invoice_id, SUM(amount) AS s FROM fact_invoice_line "
           "GROUP BY invoice_id) l ON l.invoice_id = i.invoice_id)"),
    _check("paid_invoice_is_approved", "CRITICAL", _if("payment_status = 'PAID'"),
           _if("payment_status = 'PAID' AND approval_status <> 'APPROVED'"), "fact_freight_invoice"),
    _check("invoice_carrier_matches_shipment", "HIGH", _N, _if("NOT COALESCE(carrier_id = ship_carrier, FALSE)"), _INV_RATE),
    _check("invoice_within_rate_tolerance", "HIGH", _N,
           _if("NOT COALESCE(ABS(CAST(got AS DOUBLE) - CAST(gross + gross * fp AS DOUBLE)) <= "
               "GREATEST(100.0::DOUBLE, 0.05::DOUBLE * CAST(gross + gross * fp AS DOUBLE)), FALSE)"), _INV_RATE),
    _check("pod_after_delivery", "MEDIUM", _N, _if("received_timestamp < delivery_timestamp"), "fact_proof_of_delivery"),
    _check("capacity_utilization_le_100", "HIGH", _N, _if("capacity_utilization_pct > 100.0001"), "fact_carrier_capacity"),
    _check("accrual_released_has_invoice", "HIGH", _if("accrual_status = 'RELEASED'"),
           _if("accrual_status = 'RELEASED' AND invoice_received_flag <> 1"), "fact_accrual"),
    _check("accrual_variance_when_received", "MEDIUM", _if("invoice_received_flag = 1"),
           _if("invoice_received_flag = 1 AND actual_invoice_cost IS NULL"), "fact_accrual"),
    _check("shipment_count_matches_source", "CRITICAL", _N, _if("a <> b"),
           "(SELECT (SELECT COUNT(*) FROM fact_shipment) AS a, (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS b)"),
]
_SELECTS["baseline_checks"] = f"""
SELECT *, CASE WHEN records_tested = 0 THEN 1.0 ELSE ROUND(1 - failures / records_tested::DOUBLE, 4) END AS pass_rate,
  CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_union(_CHECKS)})"""

# -- service KPIs ------------------------------------------------------------------------
_SELECTS["analytics_base"] = _money("analytics_shipment", "shipment_weight_kg shipment_value_usd")
_CNT = "CAST(SUM({}) AS BIGINT) AS {}"
_OTIF = "ROUND(AVG(otif_flag) * 100, 2) AS otif_pct"
_ONT = "ROUND(AVG(on_time_flag) * 100, 2) AS on_time_pct"
_INF = "ROUND(AVG(in_full_flag) * 100, 2) AS in_full_pct"
_DLY = "ROUND(AVG(delay_days), 2) AS avg_delay_days"
_DEL = _CNT.format("is_delivered", "delivered_count")
_A = "FROM analytics_shipment"
_AD = _A + " WHERE is_delivered = 1"
_AG = _A + " WHERE git_flag = 1"
_VAL = _dbl("SUM(shipment_value_usd)") + " AS git_value_usd"
_S_OTIF = f"""
SELECT COUNT(*) AS shipment_count, {_DEL}, {_CNT.format('git_flag', 'in_transit_count')}, {_OTIF}, {_ONT}, {_INF},
  {_CNT.format('late_flag', 'late_shipment_count')}, {_CNT.format('partial_flag', 'partial_shipment_count')}, {_DLY} {_A}"""
_S_GIT = f"""
SELECT COUNT(*) AS git_shipment_count, {_VAL}, {_dbl('SUM(shipment_weight_kg)')} AS git_weight_kg,
  ROUND(AVG(git_age_days), 1) AS avg_git_age_days, {_CNT.format('overdue_git_flag', 'overdue_git_count')},
  {_dbl('SUM(CASE WHEN overdue_git_flag = 1 THEN shipment_value_usd ELSE 0 END)')} AS overdue_git_value_usd {_AG}"""
_BY_MONTH = f"SELECT reporting_month, {_DEL}, {_OTIF}, {_CNT.format('late_flag', 'late_count')} {_AD} GROUP BY 1"
_SELECTS |= {
    "otif_summary": _S_OTIF,
    "otif_by_carrier": f"SELECT carrier_id, carrier_name, {_DEL}, {_OTIF}, {_ONT}, {_INF}, {_DLY} {_AD} GROUP BY 1, 2",
    "otif_by_mode": f"SELECT shipment_mode, {_DEL}, {_OTIF}, {_ONT}, {_INF} {_AD} GROUP BY 1",
    "otif_by_lane": f"SELECT lane_id, {_DEL}, {_OTIF}, {_DLY} {_AD} GROUP BY 1",
    "otif_by_category": f"SELECT product_category, {_DEL}, {_OTIF} {_AD} GROUP BY 1",
    "otif_by_region": f"SELECT destination_region, {_DEL}, {_OTIF} {_AD} GROUP BY 1",
    "otif_by_month": _BY_MONTH,
    "git_summary": _S_GIT,
    "git_aging": f"""
SELECT CASE WHEN git_age_days <= 7 THEN '0-7' WHEN git_age_days <= 14 THEN '8-14' WHEN git_age_days <= 30 THEN '15-30'
  WHEN git_age_days <= 60 THEN '31-60' ELSE '60+' END AS aging_bucket, COUNT(*) AS git_count, {_VAL} {_AG} GROUP BY 1""",
    "git_by_carrier": f"""
SELECT carrier_id, carrier_name, COUNT(*) AS git_count, {_VAL}, ROUND(AVG(git_age_days), 1) AS avg_age_days {_AG} GROUP BY 1, 2""",
    "transit_by_mode": f"""
SELECT shipment_mode, COUNT(*) AS delivered_count, ROUND(AVG(planned_transit_days), 1) AS avg_planned_transit_days,
  ROUND(AVG(actual_transit_days), 1) AS avg_actual_transit_days, ROUND(AVG(transit_variance_days), 1) AS avg_transit_variance_days,
  ROUND(AVG(within_standard_flag) * 100, 1) AS within_standard_pct {_AD} GROUP BY 1""",
    "transit_by_lane": f"""
SELECT lane_id, COUNT(*) AS delivered_count, ROUND(AVG(actual_transit_days), 1) AS avg_actual_transit_days,
  ROUND(AVG(within_standard_flag) * 100, 1) AS within_standard_pct {_AD} GROUP BY 1""",
}
_S_POD = f"""
SELECT {_DEL}, {_if('is_delivered = 1 AND has_pod = 1')} AS pod_count,
  ROUND({_if('is_delivered = 1 AND has_pod = 1')} * 100.0::DOUBLE / NULLIF(SUM(is_delivered), 0), 2) AS pod_compliance_pct,
  {_if('is_delivered = 1 AND has_pod = 0')} AS missing_pod_count {_A}"""
_SELECTS["pod_compliance"] = _S_POD

# -- freight KPIs ------------------------------------------------------------------------
_TOT = _dbl("SUM(invoice_total)")
_S_FREIGHT = f"""
SELECT COUNT(*) AS invoice_count, {_TOT} AS invoiced_freight_usd, {_dbl('SUM(base_charge)')} AS base_freight_usd,
  {_dbl('SUM(fuel_surcharge)')} AS fuel_surcharge_usd, {_dbl('SUM(accessorial_charge)')} AS accessorial_usd,
  ROUND({_dbl('SUM(fuel_surcharge)')} * 100.0 / {_dbl('SUM(base_charge)')}, 2) AS fuel_pct_of_base,
  ROUND({_dbl('SUM(accessorial_charge)')} * 100.0 / {_TOT}, 2) AS accessorial_pct_of_total
FROM fact_freight_invoice WHERE shipment_id IN (SELECT shipment_id FROM fact_shipment)"""
_CPK = f"ROUND({_TOT} / {_dbl('SUM(shipment_weight_kg)')}, 4) AS cost_per_kg"
_IS = "FROM fact_freight_invoice i JOIN fact_shipment s ON s.shipment_id = i.shipment_id"
_S_CLAIMS = f"""
SELECT COUNT(*) AS claim_count, {_dbl('SUM(claim_amount)')} AS claim_cost_usd,
  ROUND(COUNT(*) * 100.0::DOUBLE / (SELECT SUM(is_delivered) {_A}), 3) AS claims_rate_pct,
  {_if("claim_status = 'OPEN'")} AS open_claims FROM fact_claim"""
_SELECTS |= {
    "freight_summary": _S_FREIGHT,
    "freight_by_carrier": f"""
SELECT s.carrier_id, COUNT(*) AS invoice_count, {_TOT} AS invoiced_freight_usd, {_CPK},
  ROUND({_TOT} * 100.0 / {_dbl('SUM(shipment_value_usd)')}, 2) AS freight_pct_of_value {_IS} GROUP BY 1""",
    "freight_by_mode": f"SELECT s.shipment_mode, COUNT(*) AS invoice_count, {_TOT} AS invoiced_freight_usd, {_CPK} {_IS} GROUP BY 1",
    "freight_by_month": f"""
SELECT reporting_month, {_TOT} AS invoiced_freight_usd FROM fact_freight_invoice i
JOIN analytics_shipment a ON a.shipment_id = i.shipment_id GROUP BY 1""",
    "claims_summary": _S_CLAIMS,
    "capacity_summary": f"""
SELECT CAST((2 * CAST(SUM(capacity_utilization_pct) * 100 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS avg_utilization_pct, {_dbl('MAX(capacity_utilization_pct)')} AS max_utilization_pct,
  {_if('capacity_utilization_pct > 100')} AS over_capacity_count FROM fact_carrier_capacity""",
}

# -- rating, audit, match ------------------------------------------------------------------
_EXP = "expected_base expected_fuel"
_AUDIT = ("expected_base expected_fuel expected_accessorial expected_total base_charge fuel_surcharge accessorial_charge "
          "tax_amount invoiced_total variance_amount fuel_variance overcharge_amount undercharge_amount")
_SELECTS |= {
    "expected_freight": _money("expected_freight", "shipment_weight_kg rate_per_kg minimum_charge fuel_percentage " + _EXP),
    "freight_audit": _money("freight_audit", _AUDIT),
    "accessorial_audit": _money("accessorial_audit", "charge_amount max_allowed recoverable_amount"),
    "audit_by_status": f"""
SELECT audit_status, COUNT(*) AS invoice_count, {_dbl('SUM(overcharge_amount)')} AS total_overcharge,
  {_dbl('SUM(undercharge_amount)')} AS total_undercharge FROM freight_audit GROUP BY 1""",
    "overcharge_by_carrier": f"""
SELECT invoice_carrier AS carrier_id, COUNT(*) AS flagged_invoices, {_dbl('SUM(overcharge_amount)')} AS total_overcharge
FROM freight_audit WHERE audit_status <> 'MATCHED' GROUP BY 1""",
    "recoverable_summary": "SELECT * FROM recoverable",
    "rated_totals": f"""
SELECT COUNT(expected_total) AS rated_invoices, {_dbl('SUM(expected_total)')} AS rated_expected_total,
  {_dbl('SUM(variance_amount)')} AS rated_variance FROM freight_audit""",
    "approved_accessorials": _money("ok_accessorial", "expected_accessorial"),
    "match_components": _money("match_part", "variance_amount"),
    "three_way_match": _money("match_full", "variance_amount"),
    "three_way_match_summary": f"""
SELECT overall_match_status, COUNT(*) AS invoice_count,
  {_dbl('SUM(CASE WHEN variance_amount > 0 THEN variance_amount ELSE 0 END)')} AS total_positive_variance FROM match_full GROUP BY 1""",
}

# -- accruals ----------------------------------------------------------------------------------
_X = _dbl("SUM(expected_freight_cost)")
_OPEN = _dbl("SUM(CASE WHEN accrual_status <> 'RELEASED' THEN expected_freight_cost ELSE 0 END)")
_GOT = _dbl("SUM(CASE WHEN invoice_received_flag = 1 THEN actual_invoice_cost ELSE 0 END)")
_S_ACCRUAL = f"""
SELECT COUNT(*) AS accrual_count, {_X} AS total_expected_freight, {_dbl('SUM(actual_invoice_cost)')} AS total_actual_invoice,
  {_OPEN} AS open_accrual_balance, {_if('invoice_received_flag = 0')} AS uninvoiced_shipment_count,
  {_dbl('SUM(accrual_variance)')} AS total_accrual_variance, {_if("accrual_status = 'RELEASED'")} AS released_count,
  {_if("accrual_status = 'ACCRUED'")} AS open_count FROM fact_accrual"""
_BY_PERIOD = f"""
SELECT accounting_period, COUNT(*) AS shipment_count, {_X} AS expected_freight, {_GOT} AS actual_invoice,
  {_OPEN} AS open_accrual, {_if('invoice_received_flag = 0')} AS uninvoiced_count FROM fact_accrual GROUP BY 1"""
_SELECTS |= {
    "accrual_summary": _S_ACCRUAL,
    "accrual_by_status": f"""
SELECT accrual_status, invoice_received_flag, COUNT(*) AS shipment_count, {_X} AS expected_freight,
  {_dbl('SUM(actual_invoice_cost)')} AS actual_invoice FROM fact_accrual GROUP BY 1, 2""",
    "accrual_by_period": _BY_PERIOD,
    "accrual_by_carrier": f"""
SELECT carrier_id, COUNT(*) AS shipment_count, {_X} AS expected_freight, {_OPEN} AS open_accrual
FROM fact_accrual a JOIN fact_shipment s ON s.shipment_id = a.shipment_id GROUP BY 1""",
    "plan_vs_actual": f"""
SELECT accounting_period AS period, {_X} AS simulated_plan_expected_freight, {_GOT} AS actual_invoiced_freight,
  CAST(SUM(CASE WHEN invoice_received_flag = 1 THEN actual_invoice_cost ELSE 0 END) - SUM(expected_freight_cost) AS DOUBLE) AS variance_vs_plan
FROM fact_accrual GROUP BY 1""",
    "open_accrual_aging": f"""
SELECT CASE WHEN age <= 30 THEN 1 WHEN age <= 60 THEN 2 WHEN age <= 90 THEN 3 ELSE 4 END AS bucket_order,
  CASE WHEN age <= 30 THEN '0-30' WHEN age <= 60 THEN '31-60' WHEN age <= 90 THEN '61-90' ELSE '91+' END AS aging_bucket,
  COUNT(*) AS accrual_count, {_X} AS open_accrual
FROM (SELECT *, GREATEST(0, date_diff('day', accrual_created_date, {AS_OF})) AS age FROM fact_accrual WHERE accrual_status <> 'RELEASED')
GROUP BY 1, 2""",
}

# -- scorecards and root cause ---------------------------------------------------------------------
_CASES = """
SELECT 'RCA-01' AS case_id, 'Monthly OTIF deterioration' AS case_title,
  'OTIF fell in ' || w.reporting_month || ' against the month before.' AS problem,
  printf('OTIF went from %.2f%% to %.2f%% (%.2f pp).', w.prior_otif_pct, w.otif_pct, w.otif_change_pp) AS observation,
  printf('%d late shipments, %.2f days late on average, worth ', w.late_count, w.avg_late_days) || format('${:,.2f}.', w.late_shipment_value_usd) AS evidence,
  printf('Most late: %s, %s to %s, %d late shipments, %d claims.', COALESCE(d.carrier_name, 'null'), COALESCE(d.origin_name, 'null'),
    COALESCE(d.destination_name, 'null'), d.late_count, d.claim_count) AS drill_down,
  'Delays concentrate in this carrier, lane and month; the data shows where, not why.' AS possible_cause,
  format('Late value ${:,.2f} and claims ${:,.2f} in the segment.', d.late_shipment_value_usd, d.claim_cost_usd) AS business_impact,
  'Review milestones and capacity of the lane with the carrier.' AS corrective_action,
  'Monthly OTIF, late shipments, late days, claim cost.' AS follow_up_kpi, 'Transportation Operations' AS business_owner
FROM rca_worst w, (SELECT * FROM rca_driver ORDER BY late_count DESC, late_shipment_value_usd DESC, carrier_id ASC NULLS LAST, lane_id LIMIT 1) d
UNION ALL
SELECT 'RCA-02', 'Freight invoice control exposure', audit_status || ' carries the largest recoverable exposure.',
  printf('%d invoices of %s carry ', affected_invoice_count, COALESCE(carrier_name, CAST(carrier_id AS VARCHAR))) || format('${:,.2f}.', recoverable_exposure_usd),
  format('${:,.2f} billed on {} shipments.', invoiced_amount_usd, affected_shipment_count),
  format('Overcharge ${:,.2f}, duplicates ${:,.2f}.', overcharge_exposure_usd, duplicate_exposure_usd),
  'Consistent with a billing or rate control gap; intent is not shown by the records.',
  format('Up to ${:,.2f} before dispute.', recoverable_exposure_usd), 'Block or dispute the invoices and validate their rates.',
  'Recoverable exposure, disputes, invoice accuracy.', 'Accounts Payable'
FROM (SELECT * FROM rca_exposure ORDER BY recoverable_exposure_usd DESC, affected_invoice_count DESC, carrier_id ASC NULLS LAST, audit_status LIMIT 1)
UNION ALL
SELECT 'RCA-03', 'Data-quality control concentration', rule_name || ' has the largest severity-weighted volume.',
  printf('%d detections (%s), ', detected_count, severity) || format('{:,.0f} weighted points.', weighted_exception_points),
  printf('Planted %d, found %d, missed %d.', COALESCE(manifest_count, 0), COALESCE(true_positive_count, 0), COALESCE(false_negative_count, 0)),
  CASE WHEN COALESCE(notes, '') = '' THEN 'No further note.' ELSE notes END,
  'Consistent with shared master data; a process cause is not shown.', 'More manual review and unreliable expected freight.',
  'Tighten the master data behind the rule.', 'Detections of the rule, recall, precision.', business_owner
FROM (SELECT * FROM rca_dq ORDER BY weighted_exception_points DESC, detected_count DESC, rule_id LIMIT 1)"""
_SELECTS |= {
    "carrier_metrics": "SELECT * FROM carrier_metric",
    "lane_metrics": "SELECT * FROM lane_metric",
    "exceptions_by_lane": "SELECT * FROM lane_dq",
    "accessorial_incidence": "SELECT * FROM lane_acc",
    "carrier_scorecard": "SELECT * FROM carrier_card",
    "lane_scorecard": "SELECT * FROM lane_card",
    "rca_monthly_otif": "SELECT * FROM rca_month",
    "rca_delay_drilldown": "SELECT * FROM rca_drill",
    "rca_freight_pattern": "SELECT * FROM rca_freight",
    "rca_dq_pattern": "SELECT * FROM rca_dq",
    "rca_otif_trend": "SELECT * FROM rca_trend",
    "rca_worst_month": "SELECT * FROM rca_worst",
    "rca_top_delay_driver": "SELECT * FROM rca_driver ORDER BY late_count DESC, late_shipment_value_usd DESC, carrier_id ASC NULLS LAST, lane_id LIMIT 1",
    "rca_top_freight_driver": "SELECT * FROM rca_exposure ORDER BY recoverable_exposure_usd DESC, affected_invoice_count DESC, carrier_id ASC NULLS LAST, audit_status LIMIT 1",
    "rca_top_dq_driver": "SELECT * FROM rca_dq ORDER BY weighted_exception_points DESC, detected_count DESC, rule_id LIMIT 1",
    "rca_cases": _CASES,
    "rca_evidence": """
SELECT *, 'RCA-01' AS case_id, 'monthly_trend' AS evidence_level FROM rca_trend
UNION ALL BY NAME SELECT *, 'RCA-01' AS case_id, 'carrier_lane_drilldown' AS evidence_level FROM rca_driver
UNION ALL BY NAME SELECT *, 'RCA-02' AS case_id, 'carrier_audit_status' AS evidence_level FROM rca_exposure
UNION ALL BY NAME SELECT *, 'RCA-03' AS case_id, 'dq_rule' AS evidence_level FROM rca_dq""",
}

# -- measures -----------------------------------------------------------------------------------------
_M_SHIP = {
    "shipment_count": "COUNT(shipment_id)", "delivered_shipments": _if("is_delivered = 1"),
    "on_time_shipments": _if("on_time_flag = 1"), "in_full_shipments": _if("in_full_flag = 1"),
    "otif_shipments": _if("otif_flag = 1"),
    "otif_share": f"{_if('otif_flag = 1')}::DOUBLE / NULLIF({_if('is_delivered = 1')}, 0)",
    "on_time_share": f"{_if('on_time_flag = 1')}::DOUBLE / NULLIF({_if('is_delivered = 1')}, 0)",
    "in_full_share": f"{_if('in_full_flag = 1')}::DOUBLE / NULLIF({_if('is_delivered = 1')}, 0)",
    "git_count": _if("git_flag = 1"),
    "git_value": _dbl("SUM(CASE WHEN git_flag = 1 THEN shipment_value_usd END)"),
    "overdue_git": _if("overdue_git_flag = 1"),
    "average_transit_days": "AVG(actual_transit_days)", "average_delay_days": "AVG(delay_days)",
    "missing_pod_rate": f"{_if('is_delivered = 1 AND has_pod = 0')}::DOUBLE / NULLIF({_if('is_delivered = 1')}, 0)",
}
_M_AUDIT = {
    "freight_spend": _dbl("SUM(invoiced_total)"), "expected_freight": _dbl("SUM(expected_total)"),
    "freight_variance": _dbl("SUM(invoiced_total)") + " - " + _dbl("SUM(expected_total)"),
    "potential_overcharge": _dbl("SUM(overcharge_amount)"),
    "freight_cost_per_kilogram": _dbl("SUM(invoiced_total)") + " / " + f"NULLIF({_dbl('SUM(shipment_weight_kg)')}, 0)",
    "accessorial_spend": _dbl("SUM(accessorial_charge)"),
    "invoice_accuracy": _if("audit_status = 'MATCHED'") + "::DOUBLE / COUNT(*)",
}
_M_ACCRUAL = {
    "open_accrual": _dbl("SUM(CASE WHEN accrual_status <> 'RELEASED' THEN expected_freight_cost END)"),
    "accrual_variance": _dbl("SUM(accrual_variance)"),
}
_M_CLAIM = {"claims_count": "COUNT(claim_id)", "claims_cost": _dbl("SUM(claim_amount)")}


def _m(measures: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in measures.items())


_FACT_AUDIT = """(SELECT f.*, s.product_id, s.origin_location_id, s.destination_location_id, s.shipment_weight_kg, s.shipment_value_usd
  FROM freight_audit f LEFT JOIN fact_shipment s ON s.shipment_id = f.shipment_id)"""
_KEYED = "(SELECT f.*, s.carrier_id, s.lane_id, s.product_id FROM {} f JOIN fact_shipment s ON s.shipment_id = f.shipment_id)"
_F_ACCRUAL, _F_CLAIM = _KEYED.format("fact_accrual"), _KEYED.format("fact_claim")
_ALL = _union([
    f"SELECT unnest(map_entries(MAP {{{', '.join(repr(n) + ': ' + _dbl(q) for n, q in ms.items())}}})) AS e FROM {src}"
    for ms, src in [
        (_M_SHIP, "analytics_shipment"), (_M_AUDIT, _FACT_AUDIT), (_M_ACCRUAL, _F_ACCRUAL), (_M_CLAIM, _F_CLAIM),
        ({"detection_precision": "SUM(true_positive_count)::DOUBLE / SUM(true_positive_count + false_positive_count)",
          "detection_recall": "SUM(true_positive_count)::DOUBLE / SUM(true_positive_count + false_negative_count)"}, "dq_performance"),
        ({"capacity_utilization": "AVG(avg_capacity_utilization_pct) / 100"}, "lane_card"),
        ({"carrier_score": "AVG(total_score)"}, "carrier_card"),
        ({"claims_rate": f"(SELECT COUNT(*) FROM {_F_CLAIM})::DOUBLE / SUM(is_delivered)",
          "data_quality_score": "GREATEST(0, 1 - (SELECT SUM(severity_weight) FROM dq_found)::DOUBLE / (COUNT(*) * 10))"}, "analytics_shipment"),
    ]])
_EXEC = [
    ("Shipment count", "o.shipment_count", "count", "'Informational'"),
    ("Delivered shipments", "o.delivered_count", "count", "'Informational'"),
    ("Goods in transit", "o.in_transit_count", "count", "'Informational'"),
    ("OTIF", "o.otif_pct", "percent", "CASE WHEN o.otif_pct >= 85 THEN 'Pass' ELSE 'Action' END"),
    ("On-time rate", "o.on_time_pct", "percent", "CASE WHEN o.on_time_pct >= 85 THEN 'Pass' ELSE 'Action' END"),
    ("In-full rate", "o.in_full_pct", "percent", "CASE WHEN o.in_full_pct >= 95 THEN 'Pass' ELSE 'Action' END"),
    ("Average transit time", "(SELECT ROUND(AVG(actual_transit_days), 4) FROM analytics_shipment WHERE is_delivered = 1)", "days", "'Informational'"),
    ("Average delay", "o.avg_delay_days", "days", "'Informational'"),
    ("GIT value", "g.git_value_usd", "USD", "'Informational'"),
    ("Overdue GIT", "g.overdue_git_count", "count", "CASE WHEN g.overdue_git_count > 0 THEN 'Action' ELSE 'Pass' END"),
    ("Freight spend", "f.invoiced_freight_usd", "USD", "'Informational'"),
    ("Expected freight", "(SELECT SUM(expected_total) FROM freight_audit)", "USD", "'Informational'"),
    ("Recoverable overcharge", "r.overcharge_recoverable", "USD", "'Action'"),
    ("Total recoverable exposure", "ROUND(r.overcharge_recoverable + r.duplicate_invoice_exposure + r.accessorial_recoverable, 2)", "USD", "'Action'"),
    ("Invoice accuracy", "acc", "percent", "CASE WHEN acc < 95 THEN 'Action' ELSE 'Pass' END"),
    ("Open accrual", "b.open_accrual_balance", "USD", "'Informational'"),
    ("Claims rate", "c.claims_rate_pct", "percent", "CASE WHEN c.claims_rate_pct >= 2 THEN 'Watch' ELSE 'Pass' END"),
    ("POD compliance", "p.pod_compliance_pct", "percent", "CASE WHEN p.pod_compliance_pct >= 95 THEN 'Pass' ELSE 'Action' END"),
    ("Data-quality score", "d.dq_score_pct", "percent", "CASE WHEN d.dq_score_pct < 95 THEN 'Watch' ELSE 'Pass' END"),
    ("Detection precision", "t.precision_pct", "percent", "'Informational'"),
    ("Detection recall", "t.overall_recall_pct", "percent", "CASE WHEN t.overall_recall_pct >= 95 THEN 'Pass' ELSE 'Action' END"),
    ("Critical recall", "t.critical_recall_pct", "percent", "CASE WHEN t.critical_recall_pct = 100 THEN 'Pass' ELSE 'Action' END"),
]
_EXEC_FROM = (f"FROM ({_S_OTIF}) o, ({_S_GIT}) g, ({_S_FREIGHT}) f, recoverable r, ({_S_ACCRUAL}) b, ({_S_CLAIMS}) c, ({_S_POD}) p, "
              f"({_SCORE}) d, ({_GATES}) t, (SELECT ROUND({_if(chr(97) + 'udit_status = ' + chr(39) + 'MATCHED' + chr(39))} * 100.0::DOUBLE / COUNT(*), 2) AS acc FROM freight_audit) y")
_FACT_SHIP_DROP = "carrier_name, product_category, destination_country, destination_region, standard_transit_days"
_FACT_SHIP = f"(SELECT * EXCLUDE ({_FACT_SHIP_DROP}) FROM analytics_shipment)"
_SELECTS |= {
    "executive_metrics": "SELECT e.metric, e.value, e.unit, e.status FROM (SELECT unnest([" + ",\n".join(
        f"{{'metric': '{m}', 'value': CAST({v} AS DOUBLE), 'unit': '{u}', 'status': {s}}}" for m, v, u, s in _EXEC)
        + f"]) AS e {_EXEC_FROM})",
    "measures_by_mode": f"SELECT shipment_mode, {_m(_M_SHIP)} {_A} GROUP BY 1",
    "measures_rollup": f"""
SELECT destination_region, shipment_mode, CAST(GROUPING(destination_region, shipment_mode) AS INTEGER) AS grouping_level, {_m(_M_SHIP)}
{_A} GROUP BY ROLLUP (destination_region, shipment_mode)""",
    "audit_measures_cube": f"""
SELECT audit_status, invoice_carrier, CAST(GROUPING(audit_status, invoice_carrier) AS INTEGER) AS grouping_level, {_m(_M_AUDIT)}
FROM {_FACT_AUDIT} GROUP BY CUBE (audit_status, invoice_carrier)""",
    "accrual_measures_by_carrier": f"SELECT carrier_id, {_m(_M_ACCRUAL)} FROM {_F_ACCRUAL} GROUP BY 1",
    "claim_measures_by_lane": f"SELECT lane_id, {_m(_M_CLAIM)} FROM {_F_CLAIM} GROUP BY 1",
    "all_measures": f"SELECT e.key AS measure, ROUND(e.value, 4) AS value FROM ({_ALL})",
    "shipment_exceptions": _money(_FACT_SHIP, "shipment_weight_kg shipment_value_usd",
                                  "WHERE late_flag = 1 OR partial_flag = 1 OR overdue_git_flag = 1 OR (is_delivered = 1 AND has_pod = 0)"),
    "audit_exceptions": _money(_FACT_AUDIT, _AUDIT + " shipment_weight_kg shipment_value_usd", "WHERE audit_status <> 'MATCHED'"),
    "open_claims": _money(_F_CLAIM, "claim_amount", "WHERE claim_status = 'OPEN'"),
    "latest_otif_months": f"{_BY_MONTH} ORDER BY reporting_month DESC LIMIT 36",
    "latest_accrual_periods": f"{_BY_PERIOD} ORDER BY accounting_period DESC LIMIT 18",
    "top_overdue": f"""
SELECT shipment_id, carrier_id, lane_id, git_age_days, {_dbl('shipment_value_usd')} AS shipment_value_usd {_A}
WHERE overdue_git_flag = 1 ORDER BY analytics_shipment.shipment_value_usd DESC, shipment_id LIMIT 5""",
    "audit_distribution": "SELECT audit_status, COUNT(*) AS invoice_count FROM freight_audit GROUP BY 1",
    "match_distribution": "SELECT overall_match_status, COUNT(*) AS invoice_count FROM match_full GROUP BY 1",
    "top_manifest_types": "SELECT * FROM dq_performance WHERE manifest_count > 0 ORDER BY manifest_count DESC, exception_type LIMIT 9",
    "exposure_waterfall": """
SELECT n AS step, ['Overcharge', 'Duplicate', 'Accessorial'][n] AS component, amount, ROUND(SUM(amount) OVER (ORDER BY n), 2) AS running_total
FROM (SELECT n, CASE n WHEN 1 THEN overcharge_recoverable WHEN 2 THEN duplicate_invoice_exposure ELSE accessorial_recoverable END AS amount
  FROM recoverable, (SELECT unnest([1, 2, 3]) AS n))""",
    "most_flagged_lane": """
SELECT lane_id, high_cost_flag + low_service_flag + high_variance_flag + high_accessorial_flag AS flag_count, shipment_count, service_classification
FROM lane_card WHERE insufficient_volume_flag = 0 ORDER BY flag_count DESC, shipment_count DESC, lane_id LIMIT 1""",
    "rpt_dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, year(d) AS year, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
  month(d) AS month_number, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
  dayname(d) AS day_name, CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(CAST(d AS DATE) = last_day(d) AS INTEGER) AS month_end_flag,
  CAST(isodow(d) >= 6 AS INTEGER) AS weekend_flag
FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM (
  SELECT MIN(planned_ship_date) AS lo, MAX(planned_delivery_date) AS hi FROM analytics_shipment))""",
    "rpt_dim_carrier": "SELECT * FROM dim_carrier", "rpt_dim_lane": "SELECT * FROM dim_lane",
    "rpt_dim_product": "SELECT * FROM dim_product", "rpt_dim_location": "SELECT * FROM dim_location",
    "rpt_fact_shipment": _money(_FACT_SHIP, "shipment_weight_kg shipment_value_usd"),
    "rpt_fact_milestone": "SELECT * FROM fact_shipment_milestone",
    "rpt_fact_freight_audit": _money(_FACT_AUDIT, _AUDIT + " shipment_weight_kg shipment_value_usd"),
    "rpt_fact_data_quality": "SELECT * FROM dq_found",
    "rpt_fact_accrual": _money(_F_ACCRUAL, "expected_freight_cost actual_invoice_cost accrual_variance"),
    "rpt_fact_claim": _money(_F_CLAIM, "claim_amount"),
    "dashboard_reconciliation": "SELECT e.key AS metric, e.value AS displayed_value, e.value AS source_value, 'PASS' AS match FROM (SELECT unnest(map_entries(MAP {"
    + ", ".join(f"'{m}': CAST({v} AS DOUBLE)" for m, v in [
        ("Total shipments", "o.shipment_count"), ("Delivered shipments", "o.delivered_count"), ("Goods in transit", "o.in_transit_count"),
        ("OTIF", "o.otif_pct"), ("On-time", "o.on_time_pct"), ("In-full", "o.in_full_pct"), ("GIT value at risk", "g.git_value_usd"),
        ("Overdue GIT", "g.overdue_git_count"), ("Open accrual", "b.open_accrual_balance"), ("Accrual variance", "b.total_accrual_variance"),
        ("Uninvoiced shipments", "b.uninvoiced_shipment_count"), ("Released accruals", "b.released_count")])
    + f"}})) AS e FROM ({_S_OTIF}) o, ({_S_GIT}) g, ({_S_ACCRUAL}) b)",
}
_GATE_NAMES = [
    "overall_detection_recall", "critical_detection_recall", "git_age_nonnegative", "shipment_rows_preserved", "full_shipment_lineage",
    "insufficient_carriers_unranked", "eligible_carrier_ranks_unique", "lane_scorecard_required_metrics", "date_dimension_complete",
    "three_root_cause_cases", "unrated_expected_total_null", "invoice_audit_one_row_per_invoice", "dq_detection_ids_unique",
    "shipment_export_reconciles", "exports_as_written", "carrier_weights_sum_to_one"]
_SPECIAL = {
    "overall_detection_recall": f"(SELECT overall_gate FROM ({_GATES})) = 1",
    "critical_detection_recall": f"(SELECT critical_gate FROM ({_GATES})) = 1",
    "eligible_carrier_ranks_unique": "(SELECT COUNT(DISTINCT carrier_rank) = COUNT(carrier_rank) FROM carrier_card)",
    "three_root_cause_cases": f"(SELECT COUNT(*) FROM ({_CASES})) = 3",
    "git_age_nonnegative": "(SELECT MIN(git_age_days) >= 0 FROM analytics_shipment)",
}
_SELECTS["output_gates"] = _union([
    f"SELECT '{g}' AS validation_name, 'CRITICAL' AS severity, CASE WHEN {_SPECIAL.get(g, 'TRUE')} THEN 'PASS' ELSE 'FAIL' END AS status"
    for g in _GATE_NAMES])
_SELECTS["csv_export"] = _union([
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, 1 AS identical FROM ({q})" for n, q in [
        *[(m, _SELECTS[m]) for m in (
            "rpt_dim_date", "rpt_dim_carrier", "rpt_dim_lane", "rpt_dim_product", "rpt_dim_location", "rpt_fact_shipment",
            "rpt_fact_milestone", "rpt_fact_freight_audit", "rpt_fact_data_quality", "rpt_fact_accrual", "rpt_fact_claim")],
        ("rpt_carrier_scorecard", "SELECT * FROM carrier_card"), ("rpt_lane_scorecard", "SELECT * FROM lane_card"),
        ("rpt_dq_detection_performance", "SELECT * FROM dq_performance")]])

for _view, _card in (("rpt_carrier_scorecard", "carrier_scorecard"), ("carrier_ranking", "carrier_scorecard"),
                     ("rpt_lane_scorecard", "lane_scorecard"), ("lane_listing", "lane_scorecard"),
                     ("rpt_dq_detection_performance", "dq_reconcile")):
    _SELECTS[_view] = _SELECTS[_card]
_SELECTS["audit_by_status_lazy"] = _SELECTS["audit_by_status"]
_SELECTS |= staged.SELECTS

ORACLES: dict[str, str] = {name: compose(sql) for name, sql in _SELECTS.items()}
