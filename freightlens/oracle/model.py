"""The derived logistics model restated as DuckDB CTEs, for checking only."""

from __future__ import annotations

AS_OF = "DATE '2001-06-01'"

CTES: dict[str, str] = {}
DEPENDS: dict[str, list[str]] = {}


def cte(name: str, sql: str) -> None:
    """Register a CTE; the other CTEs it mentions are found by name."""
    CTES[name] = sql


def compose(select: str) -> str:
    """``select`` preceded by the CTEs it needs, in dependency order."""
    import re

    def words(sql: str) -> set[str]:
        return set(re.findall(r"[a-z_0-9]+", sql))

    order: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name in words(sql) and name not in order:
                visit_name(name)

    active: set[str] = set()

    def visit_name(name: str) -> None:
        if name in active:
            return
        active.add(name)
        for other in CTES:
            if other != name and other in words(CTES[name]) and other not in order:
                visit_name(other)
        order.append(name)

    visit(select)
    if not order:
        return select
    body = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{select}"


_CARRIER_NAMES = [
    "Helios Ocean Lines", "BlueCurrent Shipping", "AeroVolt Air Cargo", "VoltLine Express Air",
    "Continental Charter Air", "SunHaul Trucking", "TerraLink Road Freight",
    "PhotonRail Logistics", "GridWay Multimodal", "Meridian Freight Forwarders",
    "Cascade Customs & Brokerage", "LastMile Renewables Delivery"]
_CARRIER_TYPES = ["OCEAN_LINE", "OCEAN_LINE", "AIR_CARGO", "AIR_CARGO", "AIR_CARGO", "TRUCKING",
                  "TRUCKING", "RAIL", "MULTIMODAL", "FORWARDER", "BROKER", "FINAL_MILE"]
_CARRIER_REGIONS = ["GLOBAL", "ASIA_AFRICA", "GLOBAL", "GLOBAL", "GLOBAL", "AFRICA", "GLOBAL",
                    "EURASIA", "GLOBAL", "GLOBAL", "GLOBAL", "AFRICA"]
_CARRIER_TERMS = ["NET45", "NET45", "NET30", "NET30", "NET30", "NET30", "NET30", "NET45",
                  "NET45", "NET30", "NET30", "NET15"]


def texts(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_MODES = "['AIR', 'TRUCK', 'OCEAN', 'AIR_CHARTER']"

cte("dim_carrier", f"""
SELECT DISTINCT s_suppkey % 12 AS carrier_id,
  {texts(_CARRIER_NAMES)}[s_suppkey % 12 + 1] AS carrier_name,
  {texts(_CARRIER_TYPES)}[s_suppkey % 12 + 1] AS carrier_type,
  {_MODES}[s_suppkey % 4 + 1] AS primary_mode,
  {texts(_CARRIER_REGIONS)}[s_suppkey % 12 + 1] AS operating_region,
  {texts(_CARRIER_TERMS)}[s_suppkey % 12 + 1] AS payment_terms,
  'USD' AS default_currency, 1 AS active_flag, 'SIMULATED' AS data_class
FROM supplier""")

cte("dim_location", """
SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name || ' Distribution Center' AS location_name,
  n_name AS country, r_name AS region, 'DISTRIBUTION_CENTER' AS location_type,
  1 AS active_flag, 'DERIVED' AS data_class
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT DISTINCT s_suppkey % 5 + 100, 'Hub ' || CAST(s_suppkey % 5 + 100 AS VARCHAR), NULL, 'UNKNOWN',
  'MANUFACTURING_SITE', 1, 'DERIVED' FROM supplier""")

cte("dim_lane", f"""
SELECT CAST(n_nationkey AS BIGINT) * 4 + m AS lane_id, CAST(m + 100 AS BIGINT) AS origin_location_id,
  CAST(n_nationkey AS BIGINT) AS destination_location_id, 'Hub ' || CAST(m + 100 AS VARCHAR) AS origin_name,
  n_name || ' Distribution Center' AS destination_name, {_MODES}[m + 1] AS transport_mode,
  r_name AS lane_region, [5, 4, 32, 3][m + 1] AS standard_transit_days,
  'MODE_REGION_STANDARD' AS transit_derivation_method, 1 AS active_flag, 'DERIVED' AS data_class
FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest([0, 1, 2, 3]) AS m)""")

_CAT = ("CASE p_type WHEN 'ECONOMY' THEN 'SOLAR_MODULE' WHEN 'STANDARD' THEN 'SOLAR_MODULE' "
        "WHEN 'MEDIUM' THEN 'INVERTER' WHEN 'PROMO' THEN 'INVERTER' WHEN 'LARGE' THEN 'BATTERY_ESS' "
        "WHEN 'SMALL' THEN 'BOS_COMPONENT' END")
cte("dim_product", f"""
SELECT p_partkey AS product_id,
  CASE cat WHEN 'SOLAR_MODULE' THEN 'EQ-PVM' WHEN 'INVERTER' THEN 'EQ-INV'
    WHEN 'BATTERY_ESS' THEN 'EQ-BES' ELSE 'EQ-BOS' END || '-' || CAST(p_partkey AS VARCHAR) AS product_sku,
  cat AS product_category, p_name AS product_description, 'PACK' AS unit_of_measure,
  CASE WHEN p_partkey % 50 <> 7 THEN CASE cat WHEN 'SOLAR_MODULE' THEN '8541' WHEN 'INVERTER' THEN '8504'
    WHEN 'BATTERY_ESS' THEN '8507' ELSE '8544' END || '.40.' || substr(cat, 1, 3) END AS hts_code,
  CASE WHEN cat = 'BATTERY_ESS' THEN 1 ELSE 0 END AS hazardous_material_flag,
  CASE WHEN cat = 'BATTERY_ESS' THEN 1 ELSE 0 END AS temperature_controlled_flag,
  1 AS active_flag, 'SIMULATED' AS data_class
FROM (SELECT *, {_CAT} AS cat FROM part)""")

cte("rate_pairs", """
SELECT c.carrier_id, l.lane_id, l.transport_mode, c.carrier_id * 31 + l.lane_id AS mark
FROM dim_carrier c JOIN dim_lane l ON c.primary_mode = l.transport_mode""")
cte("dim_rate_card", """
SELECT (carrier_id * 10000 + lane_id) * 10 + version AS rate_id, carrier_id, lane_id, transport_mode,
  effective_start_date, effective_end_date, 'PER_KG' AS rate_basis,
  CAST(ROUND((1.5000 + CAST(carrier_id AS DECIMAL(6,0)) * 0.3700) * factor, 4) AS DECIMAL(12,4)) AS rate_per_kg,
  CAST(lane_id + 120 AS DECIMAL(12,2)) AS minimum_charge,
  CAST(0.1200 + CAST(lane_id % 4 AS DECIMAL(2,0)) * 0.0300 AS DECIMAL(6,4)) AS fuel_percentage,
  'USD' AS currency
FROM (
  SELECT *, 1 AS version, CAST(1.00 AS DECIMAL(4,2)) AS factor, DATE '1994-01-01' AS effective_start_date,
    CASE WHEN mark % 5 = 1 OR mark % 23 = 2 THEN DATE '1997-12-31'
         WHEN mark % 17 = 0 THEN DATE '1999-06-30' ELSE DATE '2099-12-31' END AS effective_end_date
  FROM rate_pairs
  UNION ALL
  SELECT *, 2, CAST(1.10 AS DECIMAL(4,2)), CASE WHEN mark % 23 = 2 THEN DATE '1997-07-01' ELSE DATE '1998-01-01' END,
    CASE WHEN mark % 17 = 0 THEN DATE '1999-06-30' ELSE DATE '2099-12-31' END
  FROM rate_pairs WHERE mark % 5 = 1 OR mark % 23 = 2
  UNION ALL
  SELECT *, 3, CAST(0.50 AS DECIMAL(4,2)), DATE '1996-03-01', DATE '1996-04-30'
  FROM rate_pairs WHERE mark % 19 = 3)""")

cte("order_lines", """
SELECT l_orderkey AS k, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
  SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS val, MIN(l_suppkey) AS supp, MIN(l_partkey) AS part
FROM lineitem GROUP BY l_orderkey""")
cte("ship_dates", f"""
SELECT *, arrival <= {AS_OF} AND k % 149 <> 11 AS done FROM (
  SELECT *, actual_ship_date + CAST(GREATEST(1, std + (k * 13) % 7 - 3) AS INTEGER) AS arrival FROM (
    SELECT *, planned_ship_date + CAST((k * 7) % 3 AS INTEGER) AS actual_ship_date,
      planned_ship_date + std AS planned_delivery_date FROM (
      SELECT l.*, o_custkey AS cust, CAST(c_nationkey AS BIGINT) AS nation,
        CAST(o_orderdate AS DATE) AS ordered, CAST(o_orderdate AS DATE) + 2 AS planned_ship_date,
        {_MODES}[supp % 4 + 1] AS shipment_mode, [5, 4, 32, 3][supp % 4 + 1] AS std
      FROM order_lines l JOIN orders ON o_orderkey = k JOIN customer ON c_custkey = o_custkey)))""")
cte("fact_shipment", """
SELECT k AS shipment_id, k AS source_record_id,
  CASE WHEN k % 211 = 9 THEN -k ELSE cust * 10000 + year(ordered) END AS po_id,
  CASE WHEN k % 97 <> 5 THEN supp % 12 END AS carrier_id,
  CASE WHEN k % 113 = 7 THEN 9999 ELSE nation * 4 + supp % 4 END AS lane_id,
  part AS product_id, supp AS supplier_id, 100 + supp % 5 AS origin_location_id,
  nation AS destination_location_id, CASE WHEN k % 3 = 0 THEN nation % 5 END AS warehouse_id,
  shipment_mode, CASE k % 3 WHEN 1 THEN 'FCA' WHEN 2 THEN 'EXW' END AS incoterm,
  LEAST(planned_ship_date, actual_ship_date) - 4 AS booking_date, planned_ship_date,
  actual_ship_date, planned_delivery_date,
  CASE WHEN done AND k % 131 = 17 THEN actual_ship_date - 2 WHEN done THEN arrival END AS actual_delivery_date,
  qty AS planned_quantity, qty AS shipped_quantity,
  CASE WHEN done THEN CASE WHEN k % 50 = 1 THEN qty * 7 // 10 WHEN k % 125 = 2 THEN qty + 1 ELSE qty END END AS delivered_quantity,
  CAST(qty * 3 AS DECIMAL(14,2)) AS shipment_weight_kg, CAST(val AS DECIMAL(16,2)) AS shipment_value_usd,
  CASE WHEN done THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS shipment_status,
  CAST(k % 4 <> 0 AS INTEGER) AS customs_required_flag, CAST(k % 10 = 0 AS INTEGER) AS hazmat_flag
FROM ship_dates""")
cte("done_ship", "SELECT *, shipment_id AS k FROM fact_shipment WHERE shipment_status = 'DELIVERED'")

cte("po_mode_supplier", """
SELECT po_id, supplier_id FROM (SELECT po_id, supplier_id, ROW_NUMBER() OVER (
  PARTITION BY po_id ORDER BY COUNT(*) DESC, supplier_id) AS r
  FROM fact_shipment WHERE po_id > 0 GROUP BY po_id, supplier_id) WHERE r = 1""")
cte("po_mode_product", """
SELECT po_id, product_id FROM (SELECT po_id, product_id, ROW_NUMBER() OVER (
  PARTITION BY po_id ORDER BY COUNT(*) DESC, product_id) AS r
  FROM fact_shipment WHERE po_id > 0 GROUP BY po_id, product_id) WHERE r = 1""")
cte("fact_purchase_order", """
SELECT g.*, supplier_id, product_id FROM (
  SELECT po_id, CAST(SUM(planned_quantity) AS BIGINT) AS ordered_quantity FROM fact_shipment
  WHERE po_id > 0 GROUP BY po_id) g
LEFT JOIN po_mode_supplier USING (po_id) LEFT JOIN po_mode_product USING (po_id)""")

cte("expected_freight", """
SELECT shipment_id, carrier_id, lane_id, actual_ship_date, shipment_weight_kg, rate_id, rate_basis,
  rate_per_kg, minimum_charge, fuel_percentage, currency AS rate_currency,
  CASE WHEN rate_id IS NOT NULL THEN 'RATED' WHEN known THEN 'EXPIRED_RATE' ELSE 'MISSING_RATE' END AS rate_status,
  CAST(ROUND(CASE WHEN rate_per_kg * shipment_weight_kg > minimum_charge
    THEN rate_per_kg * shipment_weight_kg ELSE minimum_charge END, 2) AS DECIMAL(14,2)) AS expected_base,
  CAST(ROUND(CASE WHEN rate_per_kg * shipment_weight_kg > minimum_charge
    THEN rate_per_kg * shipment_weight_kg ELSE minimum_charge END * fuel_percentage, 2) AS DECIMAL(14,2)) AS expected_fuel
FROM (
  SELECT s.shipment_id, s.carrier_id, s.lane_id, s.actual_ship_date, s.shipment_weight_kg,
    r.rate_id, r.rate_basis, r.rate_per_kg, r.minimum_charge, r.fuel_percentage, r.currency,
    EXISTS (SELECT 1 FROM dim_rate_card x WHERE x.carrier_id = s.carrier_id AND x.lane_id = s.lane_id) AS known,
    ROW_NUMBER() OVER (PARTITION BY s.shipment_id ORDER BY r.effective_start_date DESC NULLS LAST, r.rate_id DESC) AS pick
  FROM fact_shipment s LEFT JOIN dim_rate_card r ON r.carrier_id = s.carrier_id AND r.lane_id = s.lane_id
    AND s.actual_ship_date BETWEEN r.effective_start_date AND r.effective_end_date)
WHERE pick = 1""")

cte("fact_accessorial_charge", """
SELECT k * 10 + k % 12 AS accessorial_id, k * 10 AS invoice_id, k AS shipment_id,
  ['DEMURRAGE', 'DETENTION', 'STORAGE'][k % 12] AS charge_type,
  CAST(CASE k % 12 WHEN 1 THEN 400 + (8 * k) % 2300 WHEN 2 THEN 150 + (9 * k) % 800
    ELSE 100 + (10 * k) % 1150 END AS DECIMAL(12,2)) AS charge_amount,
  CAST(k % 35 <> k % 12 + 1 AS INTEGER) AS supporting_document_flag,
  CAST(k % 60 <> k % 12 AS INTEGER) AS contractually_allowed_flag
FROM done_ship WHERE k % 12 BETWEEN 1 AND 3""")

cte("bill_base", """
SELECT d.k, d.supplier_id, d.carrier_id AS sc, d.actual_ship_date, d.actual_delivery_date, e.fuel_percentage,
  COALESCE(a.charge_amount, 0.00)::DECIMAL(14,2) AS acc,
  CAST(ROUND(CAST(COALESCE(e.expected_base, d.shipment_weight_kg * 2) AS DECIMAL(16,2))
    * CAST(CASE WHEN k % 300 = 14 THEN 80 ELSE 98 + (17 * k) % 5 END AS DECIMAL(3,0)) * 0.01, 2) AS DECIMAL(14,2)) AS base
FROM done_ship d JOIN expected_freight e USING (shipment_id)
LEFT JOIN fact_accessorial_charge a USING (shipment_id) WHERE k % 33 <> 1""")
cte("bill_row", """
SELECT *, base + fuel + acc + CASE WHEN k % 400 = 11 THEN 5.00 ELSE 0.00 END AS total FROM (
  SELECT *, CAST(ROUND(base * COALESCE(fuel_percentage, 0.1500)
    * CASE WHEN k % 51 = 4 THEN 1.6 ELSE 1.0 END, 2) AS DECIMAL(14,2)) AS fuel FROM bill_base)""")
cte("bill_copy", """
SELECT *, 0 AS step, 'FIN-' || CAST(k AS VARCHAR) AS num, k AS owner,
  CASE WHEN k % 5 = 0 THEN 'UNPAID' ELSE 'PAID' END AS pay FROM bill_row
UNION ALL
SELECT *, 1, 'FIN-' || CAST(k AS VARCHAR), k, CASE WHEN k % 5 = 0 THEN 'UNPAID' ELSE 'PAID' END FROM bill_row WHERE k % 83 = 3
UNION ALL
SELECT *, 2, 'FIN-' || CAST(k AS VARCHAR) || '-R', k, 'PAID' FROM bill_row WHERE k % 199 = 8 AND k % 5 <> 0
UNION ALL
SELECT *, 5, 'FIN-' || CAST(k AS VARCHAR) || '-O', -k, CASE WHEN k % 5 = 0 THEN 'UNPAID' ELSE 'PAID' END
FROM bill_row WHERE k % 170 = 12""")
cte("fact_freight_invoice", """
SELECT k * 10 + step AS invoice_id, num AS invoice_number, owner AS shipment_id,
  CASE WHEN k % 101 = 3 THEN (COALESCE(sc, 0) + 1) % 12 ELSE COALESCE(sc, supplier_id % 12) END AS carrier_id,
  actual_delivery_date + 3 AS invoice_date, base AS base_charge, fuel AS fuel_surcharge,
  acc AS accessorial_charge, CAST(0 AS DECIMAL(14,2)) AS tax_amount, CAST(total AS DECIMAL(14,2)) AS invoice_total,
  CASE WHEN k % 167 = 5 THEN 'EUR' ELSE 'USD' END AS currency,
  CASE WHEN k % 250 = 6 THEN 'PENDING' ELSE 'APPROVED' END AS approval_status, pay AS payment_status
FROM bill_copy""")
cte("fact_invoice_line", """
SELECT 'IL-' || CAST(invoice_id AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS invoice_line_id, invoice_id,
  ['BASE_FREIGHT', 'FUEL_SURCHARGE', 'ACCESSORIAL', 'TAX'][n] AS line_type,
  ['Base freight per rate card', 'Fuel surcharge', 'Accessorial charges', 'Tax'][n] AS description,
  CAST(CASE n WHEN 1 THEN base_charge WHEN 2 THEN fuel_surcharge WHEN 3 THEN accessorial_charge
    ELSE tax_amount END AS DECIMAL(14,2)) AS amount, currency
FROM fact_freight_invoice, (SELECT unnest([1, 2, 3, 4]) AS n)
WHERE n <= 2 OR (n = 3 AND accessorial_charge > 0) OR (n = 4 AND tax_amount > 0)""")
cte("fact_invoice_approval", """
SELECT invoice_id * 10 + n AS approval_id, invoice_id FROM fact_freight_invoice,
  (SELECT unnest([1, 2, 3, 4]) AS n)""")
cte("fact_proof_of_delivery", """
SELECT k AS pod_id, k AS shipment_id, CAST(actual_delivery_date AS TIMESTAMP) AS delivery_timestamp,
  CAST(actual_delivery_date + CASE WHEN k % 401 = 3 THEN -1 ELSE 1 END AS TIMESTAMP) AS received_timestamp
FROM done_ship WHERE k % 25 <> 4""")
cte("fact_claim", """
SELECT k AS claim_id, k AS shipment_id, CASE WHEN k % 3 = 0 THEN 'DAMAGE' ELSE 'SHORTAGE' END AS claim_type,
  CAST(ROUND(shipment_value_usd * 0.08, 2) AS DECIMAL(14,2)) AS claim_amount,
  CASE WHEN k % 4 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS claim_status,
  CASE WHEN k % 2 = 0 THEN 'ROUGH_HANDLING' ELSE 'PORT_CONGESTION' END AS root_cause,
  actual_delivery_date + 5 AS created_date,
  CASE WHEN k % 4 <> 0 THEN actual_delivery_date + 35 END AS closed_date
FROM done_ship WHERE k % 40 IN (3, 8)""")
cte("fact_shipment_milestone", """
SELECT k * 10 + n AS milestone_id, k AS shipment_id,
  ['BOOKING_CONFIRMED', 'ORIGIN_DEPARTURE', 'IMPORT_CUSTOMS', 'WAREHOUSE_ARRIVAL', 'CUSTOMER_DELIVERY'][n] AS milestone_type,
  n AS milestone_sequence, CAST(actual_ship_date + n AS TIMESTAMP) AS planned_timestamp,
  CASE WHEN st = 'COMPLETED' THEN CAST(actual_ship_date + n
    + CASE WHEN n = 3 AND k % 90 = 8 THEN -10 ELSE 0 END AS TIMESTAMP) END AS actual_timestamp,
  st AS milestone_status,
  CASE WHEN st = 'MISSED' AND n = 3 THEN 'MISSING_CUSTOMS_DOCUMENTATION'
       WHEN st = 'MISSED' THEN 'DELIVERY_NOT_CONFIRMED' END AS exception_reason
FROM (SELECT shipment_id AS k, n, actual_ship_date,
  CASE WHEN shipment_status = 'IN_TRANSIT' AND n > 2 THEN 'PLANNED'
       WHEN shipment_status <> 'IN_TRANSIT' AND ((n = 3 AND shipment_id % 61 = 9) OR (n = 5 AND shipment_id % 77 = 5)) THEN 'MISSED'
       ELSE 'COMPLETED' END AS st
  FROM fact_shipment, (SELECT unnest([1, 2, 3, 4, 5]) AS n))""")
cte("fact_carrier_capacity", """
SELECT CAST(carrier_id AS VARCHAR) || '-' || CAST(lane_id AS VARCHAR) || '-' || period_month AS capacity_id,
  carrier_id, lane_id, CAST(period_month || '-01' AS DATE) AS period_start, period_month,
  CAST(ROUND(CAST(w AS DECIMAL(16,2)) * 0.0625, 2) AS DECIMAL(12,2)) AS capacity_utilization_pct
FROM (SELECT carrier_id, lane_id, strftime(actual_ship_date, '%Y-%m') AS period_month, SUM(shipment_weight_kg) AS w
  FROM fact_shipment WHERE carrier_id IS NOT NULL GROUP BY ALL)""")
cte("accrual_row", """
SELECT e.shipment_id, CAST(e.expected_base + e.expected_fuel AS DECIMAL(14,2)) AS expected_freight_cost,
  CASE WHEN s.shipment_status = 'DELIVERED' THEN s.actual_delivery_date ELSE s.planned_delivery_date END AS service,
  i.invoice_date, i.invoice_total, i.approval_status
FROM expected_freight e JOIN fact_shipment s USING (shipment_id)
LEFT JOIN (SELECT * FROM fact_freight_invoice WHERE invoice_id % 10 = 0) i ON i.shipment_id = e.shipment_id
WHERE e.expected_base IS NOT NULL""")
cte("fact_accrual", f"""
SELECT shipment_id AS accrual_id, shipment_id, strftime(service, '%Y-%m') AS accounting_period,
  expected_freight_cost, CAST(received AS INTEGER) AS invoice_received_flag,
  CASE WHEN received THEN invoice_total END AS actual_invoice_cost,
  CASE WHEN received AND approval_status = 'APPROVED' THEN 'RELEASED' ELSE 'ACCRUED' END AS accrual_status,
  last_day(service) AS accrual_created_date,
  CASE WHEN received AND approval_status = 'APPROVED' THEN invoice_date END AS accrual_release_date,
  CASE WHEN received THEN CAST(invoice_total - expected_freight_cost AS DECIMAL(14,2)) END AS accrual_variance
FROM (SELECT *, COALESCE(invoice_date <= last_day(service) + 5 OR invoice_date <= {AS_OF}, FALSE) AS received FROM accrual_row)""")

cte("analytics_shipment", f"""
SELECT s.shipment_id, s.source_record_id, s.carrier_id, c.carrier_name, s.lane_id, s.product_id,
  p.product_category, s.origin_location_id, s.destination_location_id, o.country AS destination_country,
  o.region AS destination_region, s.warehouse_id, s.shipment_mode, s.incoterm, s.shipment_status,
  CASE WHEN shipment_status = 'DELIVERED' THEN 1 ELSE 0 END AS is_delivered, hazmat_flag, customs_required_flag,
  planned_quantity, delivered_quantity, shipment_weight_kg, shipment_value_usd, planned_ship_date,
  actual_ship_date, planned_delivery_date, actual_delivery_date, l.standard_transit_days,
  CASE WHEN shipment_status = 'DELIVERED' THEN CAST(actual_delivery_date <= planned_delivery_date AS INTEGER) END AS on_time_flag,
  CASE WHEN shipment_status = 'DELIVERED' THEN CAST(delivered_quantity >= planned_quantity AS INTEGER) END AS in_full_flag,
  CASE WHEN shipment_status = 'DELIVERED' THEN CAST(actual_delivery_date <= planned_delivery_date AND delivered_quantity >= planned_quantity AS INTEGER) END AS otif_flag,
  CASE WHEN shipment_status = 'DELIVERED' THEN CAST(actual_delivery_date > planned_delivery_date AS INTEGER) END AS late_flag,
  CASE WHEN shipment_status = 'DELIVERED' THEN CAST(delivered_quantity < planned_quantity AS INTEGER) END AS partial_flag,
  CASE WHEN shipment_status = 'DELIVERED' THEN date_diff('day', planned_delivery_date, actual_delivery_date) END AS delay_days,
  date_diff('day', planned_ship_date, planned_delivery_date) AS planned_transit_days,
  CASE WHEN shipment_status = 'DELIVERED' THEN date_diff('day', actual_ship_date, actual_delivery_date) END AS actual_transit_days,
  CASE WHEN shipment_status = 'DELIVERED' THEN date_diff('day', actual_ship_date, actual_delivery_date)
    - date_diff('day', planned_ship_date, planned_delivery_date) END AS transit_variance_days,
  CASE WHEN shipment_status = 'DELIVERED' AND l.standard_transit_days IS NOT NULL
    THEN CAST(date_diff('day', actual_ship_date, actual_delivery_date) <= l.standard_transit_days AS INTEGER) END AS within_standard_flag,
  CASE WHEN shipment_status = 'IN_TRANSIT' THEN 1 ELSE 0 END AS git_flag,
  CASE WHEN shipment_status = 'IN_TRANSIT' THEN GREATEST(0, date_diff('day', actual_ship_date, {AS_OF})) END AS git_age_days,
  CASE WHEN shipment_status = 'IN_TRANSIT' THEN CAST(planned_delivery_date < {AS_OF} AS INTEGER) END AS overdue_git_flag,
  strftime(CASE WHEN shipment_status = 'DELIVERED' THEN actual_delivery_date ELSE planned_delivery_date END, '%Y-%m') AS reporting_month,
  CAST(s.shipment_id IN (SELECT shipment_id FROM fact_proof_of_delivery) AS INTEGER) AS has_pod,
  CAST(s.shipment_id IN (SELECT shipment_id FROM fact_freight_invoice) AS INTEGER) AS has_invoice
FROM fact_shipment s LEFT JOIN dim_lane l ON s.lane_id = l.lane_id
LEFT JOIN dim_location o ON o.location_id = s.destination_location_id
LEFT JOIN dim_product p ON p.product_id = s.product_id
LEFT JOIN dim_carrier c ON c.carrier_id = s.carrier_id""")

cte("ok_accessorial", """
SELECT invoice_id, CAST(SUM(charge_amount) AS DECIMAL(14,2)) AS expected_accessorial FROM fact_accessorial_charge
WHERE contractually_allowed_flag = 1 AND supporting_document_flag = 1
  AND charge_amount <= CASE charge_type WHEN 'DEMURRAGE' THEN 2500 WHEN 'DETENTION' THEN 900 WHEN 'STORAGE' THEN 1200 END
GROUP BY invoice_id""")
cte("audit_row", """
SELECT i.invoice_id, i.invoice_number, i.shipment_id, i.carrier_id AS invoice_carrier,
  e.carrier_id AS shipment_carrier, e.lane_id, e.rate_id, e.rate_status, i.currency, e.rate_currency,
  e.expected_base, e.expected_fuel, COALESCE(a.expected_accessorial, 0.00)::DECIMAL(14,2) AS expected_accessorial,
  CASE WHEN e.expected_base IS NOT NULL THEN CAST(e.expected_base + e.expected_fuel + COALESCE(a.expected_accessorial, 0.00) + i.tax_amount AS DECIMAL(16,2)) END AS expected_total,
  i.base_charge, i.fuel_surcharge, i.accessorial_charge, i.tax_amount, i.invoice_total AS invoiced_total,
  e.shipment_id AS hit, i.invoice_id > d.lowest AS copied
FROM fact_freight_invoice i LEFT JOIN expected_freight e ON e.shipment_id = i.shipment_id
LEFT JOIN ok_accessorial a ON a.invoice_id = i.invoice_id
LEFT JOIN (SELECT invoice_number, MIN(invoice_id) AS lowest FROM fact_freight_invoice GROUP BY invoice_number
  HAVING COUNT(*) > 1) d ON d.invoice_number = i.invoice_number""")
cte("audit_scored", """
SELECT *, CASE WHEN expected_total IS NULL THEN NULL
    WHEN ABS(variance_amount) > 100.00 AND ABS(variance_amount) > 0.05 * expected_total THEN 1 ELSE 0 END AS is_material,
  COALESCE(ABS(fuel_variance) > 100.00 AND ABS(fuel_variance) > 0.05 * expected_fuel, FALSE) AS fuel_off
FROM (SELECT *, CAST(invoiced_total - expected_total AS DECIMAL(16,2)) AS variance_amount,
  CAST(fuel_surcharge - expected_fuel AS DECIMAL(16,2)) AS fuel_variance FROM audit_row)""")
cte("freight_audit", """
SELECT invoice_id, invoice_number, shipment_id, invoice_carrier, shipment_carrier, lane_id, rate_id, rate_status,
  currency, rate_currency, expected_base, expected_fuel, expected_accessorial, expected_total, base_charge,
  fuel_surcharge, accessorial_charge, tax_amount, invoiced_total, variance_amount,
  sign(variance_amount) * CAST((CAST(ABS(variance_amount) * 100 AS HUGEINT) * 20000 + CAST(expected_total * 100 AS HUGEINT))
    // (2 * NULLIF(CAST(expected_total * 100 AS HUGEINT), 0)) AS DOUBLE) / 100 AS variance_pct,
  is_material, fuel_variance,
  CASE WHEN hit IS NULL THEN 'SHIPMENT_MISMATCH' WHEN copied THEN 'DUPLICATE_INVOICE'
    WHEN rate_status IN ('MISSING_RATE', 'EXPIRED_RATE') THEN rate_status
    WHEN invoice_carrier <> shipment_carrier THEN 'CARRIER_MISMATCH'
    WHEN currency <> rate_currency THEN 'INCORRECT_CURRENCY'
    WHEN fuel_off THEN 'INCORRECT_FUEL_SURCHARGE'
    WHEN is_material = 1 AND variance_amount > 0 THEN 'POTENTIAL_OVERCHARGE'
    WHEN is_material = 1 AND variance_amount < 0 THEN 'POTENTIAL_UNDERCHARGE' ELSE 'MATCHED' END AS audit_status,
  CASE WHEN is_material = 1 AND variance_amount > 0 THEN variance_amount ELSE CAST(0 AS DECIMAL(16,2)) END AS overcharge_amount,
  CASE WHEN is_material = 1 AND variance_amount < 0 THEN -variance_amount ELSE CAST(0 AS DECIMAL(16,2)) END AS undercharge_amount
FROM audit_scored""")
cte("accessorial_audit", """
SELECT *, CASE WHEN contractually_allowed_flag = 0 THEN 'UNAUTHORIZED' WHEN charge_amount > max_allowed THEN 'EXCESSIVE'
    WHEN supporting_document_flag = 0 THEN 'UNSUPPORTED' ELSE 'ALLOWED' END AS accessorial_status,
  CASE WHEN contractually_allowed_flag = 0 THEN charge_amount WHEN charge_amount > max_allowed THEN charge_amount - max_allowed
    ELSE CAST(0 AS DECIMAL(12,2)) END AS recoverable_amount
FROM (SELECT *, CAST(CASE charge_type WHEN 'DEMURRAGE' THEN 2500 WHEN 'DETENTION' THEN 900 WHEN 'STORAGE' THEN 1200 END
  AS DECIMAL(12,2)) AS max_allowed FROM fact_accessorial_charge)""")

# -- rules: (rule_id, exception type, record type, select of record_id and date) ---
_S = "SELECT shipment_id, {d} FROM fact_shipment WHERE "
RULE_SQL = {
    "DQ01": ("missing_carrier_id", "shipment", _S.format(d="actual_ship_date") + "carrier_id IS NULL"),
    "DQ02": ("invalid_lane", "shipment", _S.format(d="actual_ship_date")
             + "lane_id NOT IN (SELECT lane_id FROM dim_lane)"),
    "DQ03": ("delivery_before_ship", "shipment", _S.format(d="actual_ship_date")
             + "actual_delivery_date < actual_ship_date"),
    "DQ04": ("over_delivery", "shipment", _S.format(d="actual_delivery_date")
             + "delivered_quantity > planned_quantity"),
    "DQ05": ("partial_delivery", "shipment", _S.format(d="actual_delivery_date")
             + "delivered_quantity < planned_quantity"),
    "DQ06": ("missing_pod", "shipment", _S.format(d="actual_delivery_date")
             + "shipment_status = 'DELIVERED' AND shipment_id NOT IN (SELECT shipment_id FROM fact_proof_of_delivery)"),
    "DQ07": ("shipment_without_invoice", "shipment", _S.format(d="actual_delivery_date")
             + "shipment_status = 'DELIVERED' AND shipment_id NOT IN (SELECT shipment_id FROM fact_freight_invoice)"),
    "DQ08": ("missing_customs_doc", "milestone",
             "SELECT milestone_id, CAST(planned_timestamp AS DATE) FROM fact_shipment_milestone WHERE milestone_status = 'MISSED' "
             "AND exception_reason = 'MISSING_CUSTOMS_DOCUMENTATION'"),
    "DQ09": ("missing_hts_code", "product",
             "SELECT product_id, CAST(NULL AS DATE) FROM dim_product WHERE hts_code IS NULL"),
    "DQ10": ("damaged_shipment_claim", "claim",
             "SELECT claim_id, created_date FROM fact_claim WHERE claim_type = 'DAMAGE' AND claim_status = 'OPEN'"),
    "DQ11": ("invoice_carrier_mismatch", "invoice",
             "SELECT i.invoice_id, i.invoice_date FROM fact_freight_invoice i JOIN fact_shipment s "
             "ON s.shipment_id = i.shipment_id WHERE i.carrier_id <> s.carrier_id"),
    "DQ12": ("incorrect_fuel_surcharge", "invoice",
             "SELECT i.invoice_id, i.invoice_date FROM fact_freight_invoice i JOIN fact_shipment s ON s.shipment_id = i.shipment_id "
             "WHERE EXISTS (SELECT 1 FROM dim_rate_card r WHERE r.carrier_id = s.carrier_id AND r.lane_id = s.lane_id "
             "AND (ABS(i.fuel_surcharge - i.base_charge * r.fuel_percentage) > 100.00 "
             "OR ABS(i.fuel_surcharge - i.base_charge * r.fuel_percentage) > 0.05 * i.base_charge * r.fuel_percentage))"),
    "DQ13": ("incorrect_currency", "invoice",
             "SELECT i.invoice_id, i.invoice_date FROM fact_freight_invoice i JOIN dim_carrier c "
             "ON c.carrier_id = i.carrier_id WHERE i.currency <> c.default_currency"),
    "DQ14": ("expired_rate_card", "invoice",
             "SELECT i.invoice_id, i.invoice_date FROM fact_freight_invoice i JOIN fact_shipment s ON s.shipment_id = i.shipment_id "
             "WHERE EXISTS (SELECT 1 FROM dim_rate_card r WHERE r.carrier_id = s.carrier_id AND r.lane_id = s.lane_id) "
             "AND NOT EXISTS (SELECT 1 FROM dim_rate_card r WHERE r.carrier_id = s.carrier_id AND r.lane_id = s.lane_id "
             "AND s.actual_ship_date BETWEEN r.effective_start_date AND r.effective_end_date)"),
    "DQ15": ("duplicate_invoice", "invoice",
             "SELECT f.invoice_id, f.invoice_date FROM fact_freight_invoice f WHERE f.invoice_id > "
             "(SELECT MIN(g.invoice_id) FROM fact_freight_invoice g WHERE g.invoice_number = f.invoice_number)"),
    "DQ16": ("duplicate_payment_risk", "invoice",
             "SELECT f.invoice_id, f.invoice_date FROM fact_freight_invoice f WHERE f.payment_status = 'PAID' AND f.invoice_id > "
             "(SELECT MIN(g.invoice_id) FROM fact_freight_invoice g WHERE g.shipment_id = f.shipment_id AND g.payment_status = 'PAID')"),
    "DQ17": ("invoice_without_shipment", "invoice",
             "SELECT invoice_id, invoice_date FROM fact_freight_invoice WHERE shipment_id NOT IN (SELECT shipment_id FROM fact_shipment)"),
    "DQ18": ("unauthorized_detention", "accessorial",
             "SELECT accessorial_id, CAST(NULL AS DATE) FROM fact_accessorial_charge WHERE contractually_allowed_flag = 0"),
    "DQ19": ("excessive_demurrage", "accessorial",
             "SELECT accessorial_id, CAST(NULL AS DATE) FROM accessorial_audit WHERE charge_amount > max_allowed"),
    "DQ20": ("paid_without_approval", "invoice",
             "SELECT invoice_id, invoice_date FROM fact_freight_invoice WHERE payment_status = 'PAID' AND approval_status <> 'APPROVED'"),
    "DQ21": ("invalid_milestone_sequence", "milestone",
             "SELECT milestone_id, CAST(planned_timestamp AS DATE) FROM (SELECT *, MAX(actual_timestamp) OVER (PARTITION BY shipment_id "
             "ORDER BY milestone_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM fact_shipment_milestone "
             "WHERE milestone_status = 'COMPLETED') WHERE actual_timestamp < prior"),
    "DQ22": ("capacity_over_100", "capacity",
             "SELECT capacity_id, period_start FROM fact_carrier_capacity WHERE capacity_utilization_pct > 100"),
    "DQ23": ("broken_po_shipment", "shipment", _S.format(d="actual_ship_date")
             + "po_id NOT IN (SELECT po_id FROM fact_purchase_order)"),
    "DQ24": ("invoice_component_reconciliation", "invoice",
             "SELECT invoice_id, invoice_date FROM fact_freight_invoice WHERE ABS(invoice_total - base_charge - fuel_surcharge "
             "- accessorial_charge - tax_amount) > 0.01"),
    "DQ25": ("missing_required_milestone", "shipment", _S.format(d="actual_delivery_date")
             + "shipment_status = 'DELIVERED' AND shipment_id NOT IN (SELECT shipment_id FROM fact_shipment_milestone "
             "WHERE milestone_type = 'CUSTOMER_DELIVERY' AND milestone_status = 'COMPLETED')"),
}


def rule_hits(rule_id: str) -> str:
    _, record_type, body = RULE_SQL[rule_id]
    return (f"SELECT '{rule_id}' AS rule_id, CAST(x.rid AS VARCHAR) AS record_id, '{record_type}' AS record_type, "
            f"x.d AS reference_date FROM ({body}) x(rid, d)")


cte("dq_hits", "\nUNION ALL\n".join(rule_hits(r) for r in RULE_SQL))


def registry_values() -> str:
    from freightlens.config import DEFAULT_OWNER, EXCEPTION_OWNERS, SEVERITY_SLA_HOURS
    from freightlens.operators.rules import RULES

    rows = []
    for r in RULES:
        owner = EXCEPTION_OWNERS.get(r.exception_type, DEFAULT_OWNER)
        cells = [r.rule_id, r.rule_name, r.rule_category, r.severity, owner, r.exception_type,
                 r.exception_description]
        quoted = ", ".join("'" + c.replace("'", "''") + "'" for c in cells)
        rows.append(f"({quoted}, {SEVERITY_SLA_HOURS[r.severity]})")
    return "VALUES " + ",\n".join(rows)


cte("dq_rule", f"""
SELECT * FROM ({registry_values()}) v(rule_id, rule_name, rule_category, severity, business_owner,
  exception_type, exception_description, expected_resolution_sla_hours)""")
cte("dq_found", f"""
SELECT 'DE-' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY h.rule_id, h.record_type, h.record_id) AS VARCHAR), 6, '0') AS detected_exception_id,
  h.rule_id, exception_type, record_id, record_type, {AS_OF} AS detected_date, severity, exception_description,
  business_owner, 'OPEN' AS resolution_status, date_diff('day', reference_date, {AS_OF}) AS exception_age_days,
  'operational' AS source_layer, rule_category, expected_resolution_sla_hours,
  CASE severity WHEN 'CRITICAL' THEN 10 WHEN 'HIGH' THEN 5 WHEN 'MEDIUM' THEN 2 ELSE 1 END AS severity_weight
FROM dq_hits h JOIN dq_rule USING (rule_id)""")

_PLANTED = [
    ("missing_carrier_id", "k % 97 = 5", "k"), ("invalid_lane", "k % 113 = 7", "k"),
    ("delivery_before_ship", "done AND k % 131 = 17", "k"),
    ("over_delivery", "done AND k % 125 = 2", "k"), ("partial_delivery", "done AND k % 50 = 1", "k"),
    ("missing_pod", "done AND k % 25 = 4", "k"),
    ("shipment_without_invoice", "done AND k % 33 = 1", "k"),
    ("missing_customs_doc", "done AND k % 61 = 9", "k * 10 + 3"),
    ("damaged_shipment_claim", "done AND k % 240 = 48", "k"),
    ("invoice_carrier_mismatch", "billed AND k % 101 = 3", "k * 10"),
    ("incorrect_fuel_surcharge", "billed AND k % 51 = 4", "k * 10"),
    ("incorrect_currency", "billed AND k % 167 = 5", "k * 10"),
    ("duplicate_invoice", "billed AND k % 83 = 3", "k * 10 + 1"),
    ("duplicate_payment_risk", "billed AND k % 199 = 8 AND k % 5 <> 0", "k * 10 + 2"),
    ("invoice_without_shipment", "billed AND k % 170 = 12", "k * 10 + 5"),
    ("unauthorized_detention", "done AND k % 12 BETWEEN 1 AND 3 AND k % 60 = k % 12", "k * 10 + k % 12"),
]
cte("planted_key", """
SELECT shipment_id AS k, shipment_status = 'DELIVERED' AS done,
  shipment_status = 'DELIVERED' AND shipment_id % 33 <> 1 AS billed FROM fact_shipment""")
cte("manifest", "SELECT m.*, r.severity FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS exception_type, CAST({e} AS VARCHAR) AS record_id FROM planted_key WHERE {p}"
    for t, p, e in _PLANTED)
    + "\nUNION ALL\nSELECT 'missing_hts_code', CAST(product_id AS VARCHAR) FROM dim_product "
      "WHERE product_id % 50 = 7) m JOIN dq_rule r USING (exception_type)")

_NOTES = {
    "duplicate_payment_risk": "Copies of a paid invoice are second payments too.",
    "damaged_shipment_claim": "Every open damage claim needs action, planted or not.",
    "invoice_carrier_mismatch": "A shipment without a carrier cannot disagree with it.",
}
cte("perf_count", """
SELECT exception_type, MIN(severity) AS severity, COUNT(m) AS mc, COUNT(d) AS dc,
  COUNT(CASE WHEN m = 1 AND d = 1 THEN 1 END) AS tp, COUNT(CASE WHEN m IS NULL THEN 1 END) AS fp,
  COUNT(CASE WHEN d IS NULL THEN 1 END) AS fn
FROM (SELECT exception_type, record_id, MIN(severity) AS severity, 1 AS m FROM manifest GROUP BY ALL)
FULL JOIN (SELECT DISTINCT exception_type, record_id, 1 AS d FROM dq_found) USING (exception_type, record_id)
GROUP BY exception_type""")
cte("dq_performance", f"""
SELECT exception_type, severity, mc AS manifest_count, dc AS detected_count, tp AS true_positive_count,
  fp AS false_positive_count, fn AS false_negative_count, ROUND(p * 100, 2) AS precision_pct,
  ROUND(r * 100, 2) AS recall_pct, ROUND(CASE WHEN p = 0 OR r = 0 THEN 0.0 ELSE 2 * p * r / NULLIF(p + r, 0) END, 4) AS f1_score,
  CASE WHEN mc = 0 THEN 'CONTROL_RULE (no injected records)' WHEN r = 1 THEN 'FULL' WHEN r >= 0.95 THEN 'NEAR_FULL'
    ELSE 'GAP' END AS coverage_status,
  CASE exception_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _NOTES.items())} ELSE '' END AS notes
FROM (SELECT *, CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS p, CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS r FROM perf_count)""")

# -- three-way match ------------------------------------------------------------
cte("match_part", """
SELECT i.invoice_id, i.invoice_number, i.shipment_id, s.po_id,
  CASE WHEN o.po_id IS NULL THEN 'MISSING' ELSE 'MATCH' END AS po_match_status,
  CASE WHEN s.shipment_id IS NULL THEN 'MISSING' ELSE 'MATCH' END AS shipment_match_status,
  CASE WHEN s.shipment_id IS NULL THEN 'MISSING' ELSE 'MATCH' END AS invoice_match_status,
  CASE WHEN o.product_id IS NULL OR s.product_id IS NULL THEN 'UNKNOWN' WHEN o.product_id = s.product_id THEN 'MATCH'
    ELSE 'MULTI_PRODUCT_PO' END AS product_match_status,
  CASE WHEN s.delivered_quantity IS NULL THEN 'PENDING' WHEN s.delivered_quantity > s.planned_quantity THEN 'EXCEPTION'
    WHEN s.delivered_quantity < s.planned_quantity THEN 'WARNING' ELSE 'MATCH' END AS quantity_match_status,
  CASE WHEN s.carrier_id IS NULL THEN 'UNKNOWN' WHEN i.carrier_id = s.carrier_id THEN 'MATCH' ELSE 'MISMATCH' END AS carrier_match_status,
  CASE WHEN i.currency = 'USD' THEN 'MATCH' ELSE 'MISMATCH' END AS currency_match_status,
  CASE WHEN a.rate_status = 'RATED' THEN 'MATCH' ELSE COALESCE(a.rate_status, 'NO_RATE') END AS rate_match_status,
  CASE WHEN a.audit_status = 'DUPLICATE_INVOICE' THEN 'DUPLICATE' ELSE 'OK' END AS duplicate_check_status,
  a.variance_amount, a.audit_status
FROM fact_freight_invoice i LEFT JOIN fact_shipment s ON s.shipment_id = i.shipment_id
LEFT JOIN fact_purchase_order o ON o.po_id = s.po_id LEFT JOIN freight_audit a ON a.invoice_id = i.invoice_id""")
cte("match_full", """
SELECT *, CASE WHEN 'MISSING' IN (shipment_match_status, po_match_status) THEN 'MISSING_RECORD'
    WHEN duplicate_check_status = 'DUPLICATE' OR carrier_match_status = 'MISMATCH' OR audit_status = 'SHIPMENT_MISMATCH' THEN 'BLOCK_PAYMENT'
    WHEN rate_match_status <> 'MATCH' OR quantity_match_status = 'EXCEPTION' OR currency_match_status = 'MISMATCH'
      OR audit_status IN ('POTENTIAL_OVERCHARGE', 'INCORRECT_FUEL_SURCHARGE') THEN 'REVIEW_REQUIRED'
    WHEN quantity_match_status = 'WARNING' OR audit_status = 'POTENTIAL_UNDERCHARGE' THEN 'MATCHED_WITH_WARNING'
    ELSE 'MATCHED' END AS overall_match_status,
  CASE WHEN shipment_match_status = 'MISSING' THEN 'Invoice has no matching shipment'
    WHEN po_match_status = 'MISSING' THEN 'Shipment has no matching purchase order'
    WHEN duplicate_check_status = 'DUPLICATE' THEN 'Duplicate invoice number'
    WHEN carrier_match_status = 'MISMATCH' THEN 'Invoice carrier differs from shipment carrier'
    WHEN rate_match_status <> 'MATCH' THEN concat('Rate issue: ', rate_match_status)
    WHEN quantity_match_status = 'EXCEPTION' THEN 'Delivered quantity exceeds ordered'
    WHEN currency_match_status = 'MISMATCH' THEN 'Currency differs from contract'
    WHEN audit_status IN ('POTENTIAL_OVERCHARGE', 'INCORRECT_FUEL_SURCHARGE') THEN 'Charge above expected' ELSE '' END AS exception_reason,
  CASE WHEN 'MISSING' IN (shipment_match_status, po_match_status) THEN 'Return to carrier - do not pay'
    WHEN duplicate_check_status = 'DUPLICATE' THEN 'Block - verify not already paid'
    WHEN carrier_match_status = 'MISMATCH' THEN 'Block - confirm billing entity'
    WHEN rate_match_status <> 'MATCH' THEN 'Route to Procurement for rate validation'
    WHEN audit_status IN ('POTENTIAL_OVERCHARGE', 'INCORRECT_FUEL_SURCHARGE') THEN 'Short-pay to expected - dispute variance'
    WHEN quantity_match_status = 'EXCEPTION' THEN 'Reconcile delivery with Warehouse'
    ELSE 'Approve for payment' END AS recommended_action
FROM match_part""")
cte("recoverable", """
SELECT CAST((SELECT COALESCE(SUM(overcharge_amount), 0) FROM freight_audit
    WHERE audit_status IN ('POTENTIAL_OVERCHARGE', 'INCORRECT_FUEL_SURCHARGE')) AS DOUBLE) AS overcharge_recoverable,
  CAST((SELECT COALESCE(SUM(invoiced_total), 0) FROM freight_audit WHERE audit_status = 'DUPLICATE_INVOICE') AS DOUBLE) AS duplicate_invoice_exposure,
  CAST((SELECT COALESCE(SUM(recoverable_amount), 0) FROM accessorial_audit
    WHERE accessorial_status IN ('UNAUTHORIZED', 'EXCESSIVE')) AS DOUBLE) AS accessorial_recoverable""")

# -- scorecards -------------------------------------------------------------------
cte("carrier_bill", """
SELECT s.carrier_id, CAST(SUM(a.invoiced_total) AS DOUBLE) AS invoiced_freight_usd,
  ROUND(CAST(SUM(a.invoiced_total) AS DOUBLE) / CAST(SUM(s.shipment_weight_kg) AS DOUBLE), 4) AS cost_per_kg,
  COUNT(*) AS invoice_count,
  ROUND(COUNT(CASE WHEN audit_status = 'MATCHED' THEN 1 END) * 100.0::DOUBLE / COUNT(*), 2) AS invoice_accuracy_pct
FROM freight_audit a JOIN fact_shipment s USING (shipment_id) WHERE s.carrier_id IS NOT NULL GROUP BY s.carrier_id""")
cte("carrier_metric", """
SELECT g.*, invoiced_freight_usd, cost_per_kg, invoice_count, invoice_accuracy_pct, COALESCE(n, 0) AS claim_count,
  COALESCE(ROUND(COALESCE(n, 0) * 100.0::DOUBLE / shipment_count, 3), 0) AS claims_rate_pct
FROM (SELECT carrier_id, carrier_name, COUNT(*) AS shipment_count, CAST(SUM(is_delivered) AS BIGINT) AS delivered_count,
    ROUND(AVG(otif_flag) * 100, 2) AS otif_pct, ROUND(AVG(within_standard_flag) * 100, 2) AS transit_reliability_pct,
    ROUND(COUNT(CASE WHEN is_delivered = 1 AND has_pod = 1 THEN 1 END) * 100.0::DOUBLE / NULLIF(SUM(is_delivered), 0), 2) AS pod_compliance_pct,
    ROUND(AVG(delay_days), 2) AS avg_delay_days, ROUND(AVG(actual_transit_days), 2) AS avg_actual_transit_days
  FROM analytics_shipment WHERE carrier_id IS NOT NULL GROUP BY carrier_id, carrier_name) g
LEFT JOIN carrier_bill USING (carrier_id)
LEFT JOIN (SELECT carrier_id, COUNT(*) AS n FROM fact_claim JOIN fact_shipment USING (shipment_id) GROUP BY carrier_id) c USING (carrier_id)""")
_CARD = [("otif_score", "otif_pct", 1), ("transit_reliability_score", "transit_reliability_pct", 1),
         ("cost_competitiveness_score", "cost_per_kg", 0), ("invoice_accuracy_score", "invoice_accuracy_pct", 1),
         ("pod_compliance_score", "pod_compliance_pct", 1), ("claims_score", "claims_rate_pct", 0)]
_WEIGHT = [0.30, 0.20, 0.15, 0.15, 0.10, 0.10]


def _peer(score: str, metric: str, up: int) -> str:
    lo = f"(SELECT MIN({metric}) FROM carrier_metric WHERE shipment_count >= 50)"
    hi = f"(SELECT MAX({metric}) FROM carrier_metric WHERE shipment_count >= 50)"
    raw = f"({metric} - {lo}) / NULLIF({hi} - {lo}, 0) * 100"
    val = raw if up else f"100 - {raw}"
    return (f"CASE WHEN shipment_count >= 50 AND {metric} IS NOT NULL THEN CASE WHEN ABS({lo} - {hi}) <= 1e-8 + 1e-5 * ABS({hi}) "
            f"THEN 100.0 ELSE ROUND({val}, 2) END END AS {score}")


cte("carrier_scored", "SELECT *, " + ",\n".join(_peer(*c) for c in _CARD) + "\nFROM carrier_metric")
cte("carrier_card", f"""
SELECT *, CASE classification WHEN 'Preferred' THEN 'Prioritize for strategic awards; monitor quarterly'
    WHEN 'Acceptable' THEN 'Maintain allocation; target weakest score component'
    WHEN 'Improvement required' THEN 'Agree a 90-day corrective-action plan'
    WHEN 'Critical review' THEN 'Escalate sourcing review and contingency planning'
    ELSE 'Collect more volume before ranking' END AS recommended_action, 50 AS minimum_shipment_threshold
FROM (SELECT *, CASE WHEN total_score IS NOT NULL THEN RANK() OVER (ORDER BY total_score DESC NULLS LAST) END AS carrier_rank,
    CASE WHEN shipment_count < 50 THEN 'Insufficient volume' WHEN total_score >= 80 THEN 'Preferred' WHEN total_score >= 65 THEN 'Acceptable'
      WHEN total_score >= 50 THEN 'Improvement required' ELSE 'Critical review' END AS classification
  FROM (SELECT *, ROUND({' + '.join(f'{c[0]} * {w}::DOUBLE' for c, w in zip(_CARD, _WEIGHT))}, 2) AS total_score FROM carrier_scored))""")
cte("lane_dq", """
SELECT lane_id, COUNT(*) AS dq_exception_count FROM (
  SELECT s.lane_id FROM dq_found d JOIN fact_shipment s ON d.record_type = 'shipment' AND d.record_id = CAST(s.shipment_id AS VARCHAR)
  UNION ALL SELECT s.lane_id FROM dq_found d JOIN fact_freight_invoice i ON d.record_type = 'invoice' AND d.record_id = CAST(i.invoice_id AS VARCHAR)
    JOIN fact_shipment s ON s.shipment_id = i.shipment_id
  UNION ALL SELECT s.lane_id FROM dq_found d JOIN fact_claim c ON d.record_type = 'claim' AND d.record_id = CAST(c.claim_id AS VARCHAR)
    JOIN fact_shipment s ON s.shipment_id = c.shipment_id
  UNION ALL SELECT s.lane_id FROM dq_found d JOIN fact_accessorial_charge a ON d.record_type = 'accessorial' AND d.record_id = CAST(a.accessorial_id AS VARCHAR)
    JOIN fact_shipment s ON s.shipment_id = a.shipment_id
  UNION ALL SELECT s.lane_id FROM dq_found d JOIN fact_shipment_milestone m ON d.record_type = 'milestone' AND d.record_id = CAST(m.milestone_id AS VARCHAR)
    JOIN fact_shipment s ON s.shipment_id = m.shipment_id
  UNION ALL SELECT c.lane_id FROM dq_found d JOIN fact_carrier_capacity c ON d.record_type = 'capacity' AND d.record_id = c.capacity_id)
WHERE lane_id IS NOT NULL GROUP BY lane_id""")
cte("lane_acc", """
SELECT lane_id, COUNT(DISTINCT CASE WHEN a.shipment_id IS NOT NULL THEN s.shipment_id END) AS accessorial_shipment_count,
  ROUND(COUNT(DISTINCT CASE WHEN a.shipment_id IS NOT NULL THEN s.shipment_id END) * 100.0::DOUBLE / COUNT(DISTINCT s.shipment_id), 2) AS accessorial_rate_pct
FROM fact_shipment s LEFT JOIN fact_accessorial_charge a ON a.shipment_id = s.shipment_id GROUP BY lane_id""")
cte("lane_bill", """
SELECT s.lane_id, CAST(SUM(a.invoiced_total) AS DOUBLE) AS invoiced_freight_usd,
  ROUND(CAST(SUM(a.invoiced_total) AS DOUBLE) / CAST(SUM(s.shipment_weight_kg) AS DOUBLE), 4) AS cost_per_kg,
  COUNT(CASE WHEN audit_status <> 'MATCHED' THEN 1 END) AS invoice_exception_count,
  ROUND(COUNT(CASE WHEN audit_status <> 'MATCHED' THEN 1 END) * 100.0::DOUBLE / COUNT(*), 2) AS invoice_exception_pct
FROM freight_audit a JOIN fact_shipment s USING (shipment_id) GROUP BY s.lane_id""")
cte("lane_metric", """
SELECT g.lane_id, origin_name, destination_name, transport_mode, lane_region, shipment_count, delivered_count, otif_pct,
  avg_delay_days, avg_actual_transit_days, transit_reliability_pct, invoiced_freight_usd, cost_per_kg,
  COALESCE(n, 0) AS claim_count, COALESCE(ROUND(n * 100.0::DOUBLE / shipment_count, 3), 0) AS claims_rate_pct,
  COALESCE(invoice_exception_count, 0) AS invoice_exception_count, COALESCE(invoice_exception_pct, 0) AS invoice_exception_pct,
  COALESCE(accessorial_shipment_count, 0) AS accessorial_shipment_count, COALESCE(accessorial_rate_pct, 0) AS accessorial_rate_pct,
  avg_capacity_utilization_pct, COALESCE(dq_exception_count, 0) AS dq_exception_count,
  COALESCE(ROUND(dq_exception_count * 100.0::DOUBLE / shipment_count, 2), 0) AS dq_exception_rate_pct
FROM (SELECT lane_id, COUNT(*) AS shipment_count, CAST(SUM(is_delivered) AS BIGINT) AS delivered_count, ROUND(AVG(otif_flag) * 100, 2) AS otif_pct,
    ROUND(AVG(delay_days), 2) AS avg_delay_days, ROUND(AVG(actual_transit_days), 2) AS avg_actual_transit_days,
    ROUND(AVG(within_standard_flag) * 100, 2) AS transit_reliability_pct
  FROM analytics_shipment WHERE lane_id IN (SELECT lane_id FROM dim_lane) GROUP BY lane_id) g
JOIN dim_lane l ON l.lane_id = g.lane_id LEFT JOIN lane_bill b ON b.lane_id = g.lane_id
LEFT JOIN (SELECT lane_id, COUNT(*) AS n FROM fact_claim JOIN fact_shipment USING (shipment_id) GROUP BY lane_id) c ON c.lane_id = g.lane_id
LEFT JOIN lane_acc a ON a.lane_id = g.lane_id LEFT JOIN lane_dq d ON d.lane_id = g.lane_id
LEFT JOIN (SELECT lane_id, CAST((2 * CAST(SUM(capacity_utilization_pct) * 100 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS avg_capacity_utilization_pct
  FROM fact_carrier_capacity GROUP BY lane_id) k ON k.lane_id = g.lane_id""")
cte("lane_var", """
SELECT m.*, ROUND(COALESCE(sd, 0), 2) AS transit_time_variability_days FROM lane_metric m LEFT JOIN (
  SELECT lane_id, sqrt(CAST(COUNT(actual_transit_days) * SUM(CAST(actual_transit_days AS HUGEINT) * actual_transit_days) - SUM(actual_transit_days) * SUM(actual_transit_days) AS DOUBLE)) / COUNT(actual_transit_days) AS sd FROM analytics_shipment WHERE is_delivered = 1 GROUP BY lane_id) USING (lane_id)""")
cte("lane_cut", """
SELECT quantile_cont(cost_per_kg, 0.75) AS pc, quantile_cont(transit_time_variability_days, 0.75) AS pv,
  quantile_cont(accessorial_rate_pct, 0.75) AS pa FROM lane_var WHERE shipment_count >= 20""")
cte("lane_flag", """
SELECT v.*, CAST(COALESCE(shipment_count >= 20 AND cost_per_kg >= pc, FALSE) AS INTEGER) AS high_cost_flag,
  CAST(COALESCE(shipment_count >= 20 AND otif_pct < 80, FALSE) AS INTEGER) AS low_service_flag,
  CAST(COALESCE(shipment_count >= 20 AND transit_time_variability_days >= pv, FALSE) AS INTEGER) AS high_variance_flag,
  CAST(COALESCE(shipment_count >= 20 AND accessorial_rate_pct >= pa, FALSE) AS INTEGER) AS high_accessorial_flag,
  CAST(shipment_count < 20 AS INTEGER) AS insufficient_volume_flag, 20 AS minimum_shipment_threshold,
  ROUND(pc, 4) AS cost_p75_threshold, ROUND(pv, 2) AS variability_p75_threshold, ROUND(pa, 2) AS accessorial_p75_threshold
FROM lane_var v, lane_cut""")
cte("lane_card", """
SELECT * EXCLUDE (labels, acts), CASE WHEN insufficient_volume_flag = 1 THEN 'Insufficient volume' WHEN labels = '' THEN 'Stable' ELSE labels END AS service_classification,
  CASE WHEN insufficient_volume_flag = 1 THEN 'Monitor until the minimum volume threshold is met' WHEN acts = '' THEN 'Maintain and monitor'
    ELSE upper(substr(acts, 1, 1)) || substr(acts, 2) END AS recommended_action
FROM (SELECT *, concat_ws('; ', CASE WHEN high_cost_flag = 1 THEN 'High cost' END, CASE WHEN low_service_flag = 1 THEN 'Low service' END,
    CASE WHEN high_variance_flag = 1 THEN 'High variance' END, CASE WHEN high_accessorial_flag = 1 THEN 'High accessorial' END) AS labels,
  concat_ws('; ', CASE WHEN high_cost_flag = 1 THEN 'benchmark or rebid rate' END, CASE WHEN low_service_flag = 1 THEN 'carrier service recovery plan' END,
    CASE WHEN high_variance_flag = 1 THEN 'review schedule and milestone variability' END,
    CASE WHEN high_accessorial_flag = 1 THEN 'audit accessorial root causes' END) AS acts FROM lane_flag)""")

# -- root cause -----------------------------------------------------------------------
cte("rca_month", """
SELECT reporting_month, CAST(SUM(is_delivered) AS BIGINT) AS delivered_count, CAST(SUM(late_flag) AS BIGINT) AS late_count,
  ROUND(AVG(otif_flag) * 100, 2) AS otif_pct, ROUND(AVG(on_time_flag) * 100, 2) AS on_time_pct,
  ROUND(AVG(CASE WHEN late_flag = 1 THEN delay_days END), 2) AS avg_late_days,
  CAST(SUM(CASE WHEN late_flag = 1 THEN shipment_value_usd ELSE 0 END) AS DOUBLE) AS late_shipment_value_usd
FROM analytics_shipment WHERE is_delivered = 1 GROUP BY reporting_month""")
cte("rca_trend", """
SELECT *, ROUND(otif_pct - prior_otif_pct, 2) AS otif_change_pp FROM (
  SELECT *, LAG(otif_pct) OVER (ORDER BY reporting_month) AS prior_otif_pct FROM rca_month WHERE delivered_count >= 30)""")
cte("rca_worst", "SELECT * FROM rca_trend WHERE otif_change_pp IS NOT NULL ORDER BY otif_change_pp, reporting_month LIMIT 1")
cte("rca_drill", """
SELECT reporting_month, a.carrier_id, carrier_name, a.lane_id, origin_name, destination_name, transport_mode,
  COUNT(*) AS delivered_count, CAST(SUM(late_flag) AS BIGINT) AS late_count, ROUND(AVG(otif_flag) * 100, 2) AS otif_pct,
  ROUND(AVG(CASE WHEN late_flag = 1 THEN delay_days END), 2) AS avg_late_days,
  CAST(SUM(CASE WHEN late_flag = 1 THEN shipment_value_usd ELSE 0 END) AS DOUBLE) AS late_shipment_value_usd,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS claim_count, CAST(COALESCE(SUM(amt), 0) AS DOUBLE) AS claim_cost_usd
FROM analytics_shipment a LEFT JOIN dim_lane l ON l.lane_id = a.lane_id
LEFT JOIN (SELECT shipment_id, COUNT(*) AS n, SUM(claim_amount) AS amt FROM fact_claim GROUP BY shipment_id) c ON c.shipment_id = a.shipment_id
WHERE is_delivered = 1 GROUP BY ALL""")
cte("rca_driver", """
SELECT * FROM rca_drill WHERE reporting_month = (SELECT reporting_month FROM rca_worst) AND delivered_count >= 3""")
cte("rca_freight", """
SELECT invoice_carrier AS carrier_id, carrier_name, audit_status, COUNT(*) AS affected_invoice_count,
  CAST(SUM(invoiced_total) AS DOUBLE) AS invoiced_amount_usd, CAST(SUM(overcharge_amount) AS DOUBLE) AS overcharge_exposure_usd,
  CAST(SUM(CASE WHEN audit_status = 'DUPLICATE_INVOICE' THEN invoiced_total ELSE 0 END) AS DOUBLE) AS duplicate_exposure_usd,
  COUNT(DISTINCT f.shipment_id) AS affected_shipment_count,
  CAST(COALESCE(SUM(shipment_value_usd), 0) AS DOUBLE) AS affected_shipment_value_usd
FROM freight_audit f LEFT JOIN dim_carrier c ON c.carrier_id = f.invoice_carrier
LEFT JOIN fact_shipment s ON s.shipment_id = f.shipment_id WHERE audit_status <> 'MATCHED' GROUP BY ALL""")
cte("rca_exposure", """
SELECT *, ROUND(COALESCE(overcharge_exposure_usd, 0) + COALESCE(duplicate_exposure_usd, 0), 2) AS recoverable_exposure_usd FROM rca_freight""")
cte("rca_dq", """
SELECT d.rule_id, r.rule_name, d.exception_type, d.severity, d.business_owner, COUNT(*) AS detected_count,
  CAST(COUNT(*) * d.severity_weight AS DOUBLE) AS weighted_exception_points, p.manifest_count, p.true_positive_count,
  p.false_positive_count, p.false_negative_count, p.precision_pct, p.recall_pct, p.notes
FROM dq_found d JOIN dq_rule r ON r.rule_id = d.rule_id LEFT JOIN dq_performance p ON p.exception_type = d.exception_type
GROUP BY d.rule_id, r.rule_name, d.exception_type, d.severity, d.business_owner, d.severity_weight, p.manifest_count,
  p.true_positive_count, p.false_positive_count, p.false_negative_count, p.precision_pct, p.recall_pct, p.notes""")
