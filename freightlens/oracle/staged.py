"""DuckDB statements for the staging, profiling and conforming queries."""

from __future__ import annotations

from freightlens import geography
from freightlens.oracle.model import cte, texts

SELECTS: dict[str, str] = {}

# Vocabulary the integer keys are spelled as, and the raw column names in order.
_COUNTRIES = ["Angola", "Benin", "Kenya", "Ghana", "Zambia", "South Africa", "Vietnam", "Haiti",
              "Lebanon", "Kazakhstan", "Germany", "Australia", "Pakistan", "Guyana", "Nigeria",
              "Uganda", "Malawi", "Botswana", "Rwanda", "Togo", "Mali", "Senegal", "Belize",
              "Poland", "Atlantis"]
_SITES = ["Plant One, India", "Works Nashik 2", "Ludwigshafen Hall", "Granville Australia",
          "Unknown Yard", "Meymac, France", "Paonta Shahib, IN", "Diagnostics Bay US"]
_RAW = ["ID", "Project Code", "PQ #", "PO / SO #", "ASN/DN #", "Country", "Managed By",
        "Fulfill Via", "Vendor INCO Term", "Shipment Mode", "PQ First Sent to Client Date",
        "PO Sent to Vendor Date", "Scheduled Delivery Date", "Delivered to Client Date",
        "Delivery Recorded Date", "Product Group", "Sub Classification", "Vendor",
        "Item Description", "Molecule/Test Type", "Brand", "Dosage", "Dosage Form",
        "Unit of Measure (Per Pack)", "Line Item Quantity", "Line Item Value", "Pack Price",
        "Unit Price", "Manufacturing Site", "First Line Designation", "Weight (Kilograms)",
        "Freight Cost (USD)", "Line Item Insurance (USD)"]


def _v(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _short(day: str) -> str:
    return f"strftime({day}, '%-d-%b-%y')"


def _see(kind: str) -> str:
    return (f"'See {kind}-' || {_v('k')} || ' (ID#:' || "
            f"{_v('CASE WHEN k % 17 = 2 AND n > 2 THEN k * 10 + 2 ELSE k * 10 + 1 END')} || ')'")


_SPELL = {
    "ID": _v("k * 10 + n"), "Project Code": f"'PRJ-' || {_v('o_custkey % 20')}",
    "PQ #": f"'PQ-' || {_v('k')}", "PO / SO #": f"CASE WHEN k % 29 <> 3 THEN 'SO-' || {_v('k')} END",
    "ASN/DN #": f"CASE WHEN n % 2 = 0 THEN 'ASN-' ELSE 'DN-' END || {_v('k * 10 + n')}",
    "Country": f"{texts(_COUNTRIES)}[c_nationkey + 1]", "Managed By": "'PMO - US'",
    "Fulfill Via": "CASE WHEN k % 3 = 0 THEN 'From RDC' ELSE 'Direct Drop' END",
    "Vendor INCO Term": "CASE k % 3 WHEN 0 THEN 'N/A - From RDC' WHEN 1 THEN 'FCA' ELSE 'EXW' END",
    "Shipment Mode": "CASE WHEN k % 31 <> 4 THEN ['Air', 'Truck', 'Ocean', 'Air Charter'][l_suppkey % 4 + 1] END",
    "PQ First Sent to Client Date": f"CASE k % 7 WHEN 1 THEN 'Pre-PQ Process' WHEN 2 THEN 'Date Not Captured' ELSE {_short('od - 30')} END",
    "PO Sent to Vendor Date": f"CASE WHEN k % 3 = 0 THEN 'N/A - From RDC' WHEN k % 11 = 5 THEN 'Date Not Captured' ELSE {_short('od')} END",
    "Scheduled Delivery Date": f"CASE WHEN k % 211 = 3 THEN 'to be agreed' ELSE {_short('sd + 10')} END",
    "Delivered to Client Date": f"CASE WHEN k % 307 = 4 THEN '31-Feb-98' ELSE {_short('sd + CAST(k % 9 + 6 AS INTEGER)')} END",
    "Delivery Recorded Date": _short("sd + CAST(k % 9 + 8 AS INTEGER)"),
    "Product Group": "['ARV', 'HRDT', 'ANTM', 'ACT', 'MRDT'][l_partkey % 5 + 1]",
    "Sub Classification": "CASE l_partkey % 5 WHEN 0 THEN CASE WHEN l_partkey % 97 = 0 THEN 'Other' WHEN l_partkey % 2 = 0 THEN 'Adult' ELSE 'Pediatric' END "
                          "WHEN 1 THEN CASE WHEN l_partkey % 2 = 0 THEN 'HIV test' ELSE 'HIV test - Ancillary' END ELSE 'Malaria' END",
    "Vendor": "s_name", "Item Description": "p_name", "Molecule/Test Type": "p_type", "Brand": "p_brand",
    "Dosage": f"CASE WHEN l_partkey % 6 <> 0 THEN {_v('p_size')} || 'mg' END",
    "Dosage Form": "CASE WHEN l_partkey % 5 = 0 THEN 'Tablet' ELSE 'Test kit' END",
    "Unit of Measure (Per Pack)": _v("p_size"),
    "Line Item Quantity": f"CASE WHEN k % 401 = 7 THEN '0' WHEN k % 409 = 8 THEN 'unknown' ELSE {_v('q')} END",
    "Line Item Value": _v("price"), "Pack Price": _v("CAST(p_retailprice AS DECIMAL(12,2))"),
    "Unit Price": _v("CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.01 AS DECIMAL(12,4))"),
    "Manufacturing Site": f"{texts(_SITES)}[l_suppkey % 8 + 1]",
    "First Line Designation": "CASE WHEN l_partkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "Weight (Kilograms)": f"CASE WHEN k % 13 = 5 THEN 'Weight Captured Separately' WHEN k % 5 = 2 AND n > 1 THEN {_see('DN')} ELSE {_v('q * 3')} || '.5' END",
    "Freight Cost (USD)": f"CASE WHEN k % 9 = 1 THEN 'Freight Included in Commodity Cost' WHEN k % 9 = 2 THEN 'Invoiced Separately' "
                          f"WHEN k % 9 = 3 AND n > 1 THEN {_see('ASN')} ELSE {_v('CAST(ROUND(price * 0.05, 2) AS DECIMAL(12,2))')} END",
    "Line Item Insurance (USD)": f"CASE WHEN k % 8 <> 0 THEN {_v('CAST(ROUND(price * 0.01, 2) AS DECIMAL(12,2))')} END",
}
cte("raw_text", "SELECT " + ",\n  ".join(f'{_SPELL[c]} AS "{c}"' for c in _RAW) + """
FROM (SELECT *, l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, CAST(l_quantity AS BIGINT) AS q,
    CAST(l_extendedprice AS DECIMAL(14,2)) AS price, CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)""")


def _date(column: str) -> str:
    return f"CAST(try_strptime(\"{column}\", '%d-%b-%y') AS DATE)"


cte("raw_judged", f"""
SELECT *, CASE WHEN COUNT(*) OVER (PARTITION BY "ID") > 1 THEN 'duplicate ID'
  WHEN {_date('Scheduled Delivery Date')} IS NULL THEN 'unparseable scheduled delivery date'
  WHEN {_date('Delivered to Client Date')} IS NULL THEN 'unparseable actual delivery date'
  WHEN COALESCE(TRY_CAST("Line Item Quantity" AS DOUBLE), 0) <= 0 THEN 'non-positive or non-numeric quantity' END AS rejection_reason
FROM raw_text""")
SELECTS["reject_split"] = """
SELECT COALESCE(rejection_reason, 'accepted') AS rejection_reason, COUNT(*) AS row_count FROM raw_judged GROUP BY 1"""
SELECTS["raw_sample"] = """
SELECT "ID", "Country", "Vendor", "Line Item Quantity", "Weight (Kilograms)" FROM raw_text ORDER BY 1, 2, 3, 4, 5 LIMIT 100"""
_PAYLOAD = "'{' || concat_ws(',', " + ", ".join(
    f"""'"{c}":"' || "{c}" || '"'""" for c in _RAW) + ") || '}'"
SELECTS["reject_ledger"] = f"""
SELECT sha256(payload || '|' || rejection_reason) AS reject_id, "ID" AS source_record_id, rejection_reason, payload AS raw_payload,
  DATE '2021-06-01' AS rejected_on FROM (SELECT *, {_PAYLOAD} AS payload FROM raw_judged WHERE rejection_reason IS NOT NULL)"""

cte("raw_good", """SELECT *, CAST("ID" AS BIGINT) AS rid FROM raw_judged WHERE rejection_reason IS NULL""")


def _pointer(column: str) -> str:
    return f"TRY_CAST(regexp_extract(\"{column}\", 'ID#:\\s*(\\d+)', 1) AS BIGINT)"


def _dated(column: str) -> str:
    return (f"CASE WHEN \"{column}\" NOT IN ('Pre-PQ Process', 'Date Not Captured', 'N/A - From RDC') THEN {_date(column)} END")


cte("stg_row", f"""
SELECT g.*, w.v AS wv, f.v AS fv, {_pointer('Weight (Kilograms)')} AS wp, {_pointer('Freight Cost (USD)')} AS fp,
  TRY_CAST(g."Weight (Kilograms)" AS DECIMAL(12,2)) AS wd, TRY_CAST(g."Freight Cost (USD)" AS DECIMAL(12,2)) AS fd
FROM raw_good g
LEFT JOIN (SELECT rid, TRY_CAST("Weight (Kilograms)" AS DECIMAL(12,2)) AS v FROM raw_good) w ON w.rid = {_pointer('Weight (Kilograms)').replace('"Weight', 'g."Weight')}
LEFT JOIN (SELECT rid, TRY_CAST("Freight Cost (USD)" AS DECIMAL(12,2)) AS v FROM raw_good) f ON f.rid = {_pointer('Freight Cost (USD)').replace('"Freight', 'g."Freight')}""")
cte("stg", f"""
SELECT rid AS source_record_id, "PO / SO #" AS po_so_number, "ASN/DN #" AS asn_dn_number, "Project Code" AS project_code,
  "Country" AS destination_country, "Managed By" AS managed_by, "Fulfill Via" AS fulfill_via,
  NULLIF("Vendor INCO Term", 'N/A - From RDC') AS incoterm, "Shipment Mode" AS shipment_mode_raw,
  CASE "Shipment Mode" WHEN 'Air' THEN 'AIR' WHEN 'Air Charter' THEN 'AIR_CHARTER' WHEN 'Truck' THEN 'TRUCK' WHEN 'Ocean' THEN 'OCEAN' END AS shipment_mode,
  CAST("Shipment Mode" IS NULL AS INTEGER) AS missing_mode_flag,
  {_dated('PQ First Sent to Client Date')} AS pq_first_sent_date, {_dated('PO Sent to Vendor Date')} AS po_sent_date,
  {_date('Scheduled Delivery Date')} AS scheduled_delivery_date, {_date('Delivered to Client Date')} AS actual_delivery_date,
  {_date('Delivery Recorded Date')} AS delivery_recorded_date, "Product Group" AS product_group_raw, "Sub Classification" AS sub_classification_raw,
  CASE WHEN "Product Group" = 'ARV' THEN CASE "Sub Classification" WHEN 'Adult' THEN 'SOLAR_MODULE' WHEN 'Pediatric' THEN 'INVERTER' END
    WHEN "Product Group" = 'HRDT' THEN CASE "Sub Classification" WHEN 'HIV test' THEN 'BATTERY_ESS' WHEN 'HIV test - Ancillary' THEN 'BOS_COMPONENT' END
    ELSE 'BOS_COMPONENT' END AS product_category,
  "Vendor" AS vendor_name, "Item Description" AS item_description_raw, "Manufacturing Site" AS manufacturing_site,
  CAST("First Line Designation" = 'Yes' AS INTEGER) AS first_line_designation, CAST("Unit of Measure (Per Pack)" AS BIGINT) AS unit_of_measure_per_pack,
  CAST("Line Item Quantity" AS BIGINT) AS line_item_quantity, CAST("Line Item Value" AS DECIMAL(14,2)) AS line_item_value_usd,
  CAST("Pack Price" AS DECIMAL(12,2)) AS pack_price_usd, CAST("Unit Price" AS DECIMAL(12,4)) AS unit_price_usd,
  COALESCE(wv, wd) AS weight_kg,
  CASE WHEN wp IS NOT NULL AND wv IS NOT NULL THEN 'resolved_reference' WHEN wp IS NOT NULL THEN 'missing_unresolved_reference'
    WHEN wd IS NOT NULL THEN 'direct' WHEN "Weight (Kilograms)" = 'Weight Captured Separately' THEN 'missing_captured_separately' ELSE '' END AS weight_source,
  COALESCE(fv, fd) AS freight_cost_usd,
  CASE WHEN fp IS NOT NULL AND fv IS NOT NULL THEN 'resolved_reference' WHEN fp IS NOT NULL THEN 'missing_unresolved_reference'
    WHEN fd IS NOT NULL THEN 'direct' WHEN "Freight Cost (USD)" = 'Freight Included in Commodity Cost' THEN 'missing_included_in_commodity'
    WHEN "Freight Cost (USD)" = 'Invoiced Separately' THEN 'missing_invoiced_separately' ELSE '' END AS freight_cost_source,
  CAST("Line Item Insurance (USD)" AS DECIMAL(12,2)) AS line_item_insurance_usd,
  CAST({_date('Scheduled Delivery Date')} + INTERVAL 20 YEAR AS DATE) AS reporting_scheduled_delivery_date,
  CAST({_date('Delivered to Client Date')} + INTERVAL 20 YEAR AS DATE) AS reporting_actual_delivery_date
FROM stg_row""")
_STG_MONEY = "line_item_value_usd pack_price_usd unit_price_usd weight_kg freight_cost_usd line_item_insurance_usd"
SELECTS["staged_shipments"] = "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in _STG_MONEY.split()) + ") FROM stg"
SELECTS["reference_provenance"] = """
SELECT weight_source, freight_cost_source, COUNT(*) AS row_count, CAST(SUM(weight_kg) AS DOUBLE) AS weight_kg,
  CAST(SUM(freight_cost_usd) AS DOUBLE) AS freight_cost_usd FROM stg GROUP BY 1, 2"""
SELECTS["category_map"] = """
SELECT product_group_raw, sub_classification_raw, product_category, COUNT(*) AS row_count FROM stg GROUP BY 1, 2, 3"""

_PADDED = "' ' || {} || ' '"


def _country(site: str) -> str:
    tests = "\n".join(f"WHEN contains({_PADDED.format(site)}, '" + w.replace("'", "''") + f"') THEN '{c}'"
                      for w, c in geography.SITE_KEYWORDS)
    return f"CASE {tests} END"


def _region(country: str) -> str:
    tests = " ".join(
        f"WHEN {country} IN ({', '.join(chr(39) + c.replace(chr(39), chr(39) * 2) + chr(39) for c in cs)}) THEN '{r}'"
        for r, cs in geography.REGION_COUNTRIES.items())
    return f"CASE {tests} ELSE 'UNKNOWN' END"


def _warehouse(country: str) -> str:
    south = ", ".join(f"'{c}'" for c in geography.SOUTHERN_AFRICA)
    tests = " ".join(f"WHEN '{r}' THEN '{w}'" for r, w in geography.REGION_WAREHOUSE.items())
    return f"CASE WHEN {country} IN ({south}) THEN 'WH02' ELSE CASE {_region(country)} {tests} ELSE 'WH03' END END"


SELECTS["site_country"] = f"""
SELECT manufacturing_site, {_country('manufacturing_site')} AS country, COUNT(*) AS row_count FROM stg GROUP BY 1, 2"""
SELECTS["regional_warehouse"] = f"""
SELECT destination_country, {_region('destination_country')} AS region, {_warehouse('destination_country')} AS warehouse_id,
  COUNT(*) AS row_count FROM stg GROUP BY 1, 2, 3"""

# -- profile ------------------------------------------------------------------------------
_TARGETS = {
    "ID": "source_record_id", "PO / SO #": "po_so_number", "ASN/DN #": "asn_dn_number", "Project Code": "project_code",
    "Country": "destination_country", "Managed By": "managed_by", "Fulfill Via": "fulfill_via", "Vendor INCO Term": "incoterm",
    "Shipment Mode": "shipment_mode_raw, shipment_mode, missing_mode_flag", "PQ First Sent to Client Date": "pq_first_sent_date",
    "PO Sent to Vendor Date": "po_sent_date", "Scheduled Delivery Date": "scheduled_delivery_date, reporting_scheduled_delivery_date",
    "Delivered to Client Date": "actual_delivery_date, reporting_actual_delivery_date", "Delivery Recorded Date": "delivery_recorded_date",
    "Product Group": "product_group_raw, product_category", "Sub Classification": "sub_classification_raw, product_category",
    "Vendor": "vendor_name", "Item Description": "item_description_raw", "Manufacturing Site": "manufacturing_site",
    "First Line Designation": "first_line_designation", "Unit of Measure (Per Pack)": "unit_of_measure_per_pack",
    "Line Item Quantity": "line_item_quantity", "Line Item Value": "line_item_value_usd", "Pack Price": "pack_price_usd",
    "Unit Price": "unit_price_usd", "Weight (Kilograms)": "weight_kg, weight_source",
    "Freight Cost (USD)": "freight_cost_usd, freight_cost_source", "Line Item Insurance (USD)": "line_item_insurance_usd",
}
cte("raw_count", "SELECT c, v, COUNT(*) AS n FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS c, \"{c}\" AS v FROM raw_text" for c in _RAW) + ") GROUP BY c, v")
SELECTS["raw_csv"] = "SELECT * FROM raw_text"
# A record whose field count is off is malformed unless its line break makes it two records that are.
SELECTS["malformed_records"] = """
SELECT rejection_reason, CAST(SUM(n) AS BIGINT) AS row_count, CAST(SUM(b) AS BIGINT) AS line_breaks
FROM (SELECT CASE WHEN surplus OR short OR opened THEN 'malformed record' ELSE COALESCE(rejection_reason, 'accepted') END AS rejection_reason,
    CASE WHEN broken AND surplus THEN 2 ELSE 1 END AS n, CASE WHEN broken AND NOT surplus AND NOT short THEN 1 ELSE 0 END AS b
  FROM (SELECT rejection_reason, i % 97 = 5 AS broken, i % 101 = 7 AS surplus, i % 103 = 9 AND i % 101 <> 7 AS short, i % 107 = 11 AND i % 97 <> 5 AS opened
        FROM (SELECT CAST("ID" AS BIGINT) AS i, rejection_reason FROM raw_judged)))
GROUP BY rejection_reason"""
SELECTS["column_profile"] = f"""
SELECT s.c AS column_name, CASE WHEN d = 0 THEN 'unknown' WHEN num = d AND whole = d THEN 'integer' WHEN num = d THEN 'numeric'
    WHEN num > 0 THEN 'mixed (numeric + text sentinels)' WHEN days = d THEN 'date (%d-%b-%y)'
    WHEN days > 0 THEN 'mixed (date + text sentinels)' ELSE 'text' END AS inferred_type,
  ROUND(missing * 100.0::DOUBLE / total, 2) AS missing_pct, d AS distinct_values, COALESCE(tops, '') AS top_values,
  CASE s.c {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TARGETS.items())} ELSE '(not modeled)' END AS target_model_column
FROM (SELECT c, SUM(n) AS total, COALESCE(SUM(CASE WHEN v IS NULL THEN n END), 0) AS missing, COUNT(v) AS d,
    COUNT(TRY_CAST(v AS DOUBLE)) AS num, COUNT(CASE WHEN TRY_CAST(v AS DOUBLE) % 1 = 0 THEN 1 END) AS whole,
    COUNT(try_strptime(v, '%d-%b-%y')) AS days FROM raw_count GROUP BY c) s
LEFT JOIN (SELECT c, string_agg(v || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY r) AS tops FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c ORDER BY n DESC, v) AS r FROM raw_count WHERE v IS NOT NULL) WHERE r <= 3 GROUP BY c) t ON t.c = s.c"""

# -- conformed dimensions --------------------------------------------------------------------
cte("site_no", """
SELECT manufacturing_site AS site, ROW_NUMBER() OVER (ORDER BY manufacturing_site) AS n FROM (SELECT DISTINCT manufacturing_site FROM stg)""")
cte("goal_no", """
SELECT destination_country AS goal, ROW_NUMBER() OVER (ORDER BY destination_country) AS n FROM (SELECT DISTINCT destination_country FROM stg)""")
_WH = ("(VALUES ('LOCWH01', 'Corridor West Africa DC', 'AFRICA'), ('LOCWH02', 'Corridor Southern Africa DC', 'AFRICA'), "
       "('LOCWH03', 'Corridor SE Asia DC', 'ASIA'), ('LOCWH04', 'Corridor Americas DC', 'AMERICAS'), ('LOCWH05', 'Corridor Europe Hub', 'EUROPE')) w(i, n, r)")
cte("loc", f"""
SELECT printf('LOCMFG%03d', n) AS location_id, site AS location_name, country, {_region('country')} AS region,
  'MANUFACTURING_SITE' AS location_type, CASE WHEN country IS NOT NULL THEN 'PUBLIC' ELSE 'DERIVED' END AS data_class
FROM (SELECT *, {_country('site')} AS country FROM site_no)
UNION ALL SELECT printf('LOCDST%03d', n), goal || ' Distribution Center', goal, {_region('goal')}, 'DISTRIBUTION_CENTER', 'DERIVED' FROM goal_no
UNION ALL SELECT i, n, NULL, r, 'WAREHOUSE', 'SIMULATED' FROM {_WH}""")
SELECTS["location_dim"] = "SELECT * FROM loc"
SELECTS["location_xref"] = f"""
SELECT printf('XR-MFG-%03d', n) AS xref_id, site AS raw_location_string, 'manufacturing_site' AS raw_field, printf('LOCMFG%03d', n) AS location_id,
  CASE WHEN {_country('site')} IS NOT NULL THEN 'COUNTRY_PARSED' ELSE 'UNRESOLVED' END AS match_method FROM site_no
UNION ALL SELECT printf('XR-DST-%03d', n), goal, 'destination_country', printf('LOCDST%03d', n), 'EXACT' FROM goal_no"""
# Medians in units of 1e-10, so that everything after them is integer arithmetic.
cte("unit_median", """
SELECT product_category, COALESCE(CAST(ROUND(median(CAST(weight_kg AS DOUBLE) / line_item_quantity) * 1e10) AS HUGEINT), 10000000000) AS w,
  CAST(ROUND(median(CAST(line_item_value_usd AS DOUBLE) / line_item_quantity) * 1e10) AS HUGEINT) AS v
FROM stg WHERE product_category IS NOT NULL GROUP BY 1""")
_TRAIT = {"SOLAR_MODULE": ("EQ-PVM", "Solar Modules", "8541", 0, 0, 1), "INVERTER": ("EQ-INV", "Inverters", "8504", 0, 0, 1),
          "BATTERY_ESS": ("EQ-BES", "Battery Energy Storage Systems", "8507", 1, 1, 0),
          "BOS_COMPONENT": ("EQ-BOS", "Electrical Balance-of-System Components", "8544", 0, 0, 1)}
_TRAITS = ", ".join(f"('{c}', '{t[0]}', '{t[1]}', '{t[2]}', {t[3]}, {t[4]}, {t[5]})" for c, t in _TRAIT.items())
cte("variant", f"""
SELECT printf('PRD-%s-%02d', substr(c, 1, 3), n) AS product_id, printf('%s-%d-%02d', sku, 100 + n * 17, n) AS product_sku, c AS product_category,
  printf('%s — nominal pack unit variant %d', label, n) AS product_description, 'PACK' AS unit_of_measure,
  CAST((w * (n + 7) + 5000000) // 10000000 AS DOUBLE) / 10000 AS unit_weight_kg, CAST((v * (n + 7) + 5000000) // 10000000 AS DOUBLE) / 10000 AS unit_value_usd,
  hts || '.40.' || substr(c, 1, 3) AS hts_code, hz AS hazardous_material_flag, tc AS temperature_controlled_flag, st AS stackable_flag
FROM (VALUES {_TRAITS}) x(c, sku, label, hts, hz, tc, st) JOIN unit_median ON product_category = c, (SELECT unnest([1, 2, 3, 4, 5]) AS n)""")
SELECTS["product_dim"] = "SELECT * FROM variant"
cte("vendor", f"""
SELECT printf('SUP%03d', ROW_NUMBER() OVER (ORDER BY a.vendor_name)) AS supplier_id, a.vendor_name AS supplier_name,
  l.location_id AS supplier_location_id, cat AS primary_product_category, l.country
FROM (SELECT DISTINCT vendor_name FROM stg) a
LEFT JOIN (SELECT * FROM (SELECT vendor_name, manufacturing_site AS site, ROW_NUMBER() OVER (PARTITION BY vendor_name ORDER BY COUNT(*) DESC, manufacturing_site) AS r
  FROM stg GROUP BY 1, 2) WHERE r = 1) b ON b.vendor_name = a.vendor_name
LEFT JOIN (SELECT * FROM (SELECT vendor_name, product_category AS cat, ROW_NUMBER() OVER (PARTITION BY vendor_name ORDER BY COUNT(*) DESC, product_category) AS r
  FROM stg WHERE product_category IS NOT NULL GROUP BY 1, 2) WHERE r = 1) c ON c.vendor_name = a.vendor_name
LEFT JOIN loc l ON l.location_type = 'MANUFACTURING_SITE' AND l.location_name = site""")
SELECTS["supplier_dim"] = "SELECT * FROM vendor"
_HAUL = [("CAR01", "Helios Ocean Lines", "CARRIER", "GLOBAL"), ("CAR02", "BlueCurrent Shipping", "CARRIER", "ASIA_AFRICA"),
         ("CAR03", "AeroVolt Air Cargo", "CARRIER", "GLOBAL"), ("CAR04", "VoltLine Express Air", "CARRIER", "GLOBAL"),
         ("CAR05", "Continental Charter Air", "CARRIER", "GLOBAL"), ("CAR06", "SunHaul Trucking", "CARRIER", "AFRICA"),
         ("CAR07", "TerraLink Road Freight", "CARRIER", "GLOBAL"), ("CAR08", "PhotonRail Logistics", "CARRIER", "EURASIA"),
         ("CAR09", "GridWay Multimodal", "CARRIER", "GLOBAL"), ("CAR10", "Meridian Freight Forwarders", "CARRIER", "GLOBAL"),
         ("CAR11", "Cascade Customs & Brokerage", "BROKER", "GLOBAL"), ("CAR12", "LastMile Renewables Delivery", "CARRIER", "AFRICA")]
SELECTS["partner_registry"] = f"""
SELECT 'BP-' || supplier_id AS partner_id, supplier_name AS partner_name, 'SUPPLIER' AS partner_type, country, {_region('country')} AS region FROM vendor
UNION ALL SELECT 'BP-' || i, n, t, NULL, r FROM (VALUES {', '.join(str(h) for h in _HAUL)}) x(i, n, t, r)
UNION ALL SELECT printf('BP-CUST%03d', n), goal || ' Project Customer', 'CUSTOMER', goal, {_region('goal')} FROM goal_no"""


def _u(salt: str, key: str) -> str:
    return f"(CAST('0x' || substr(md5('42:{salt}:' || {key}), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE)"


_SRID = "CAST(source_record_id AS VARCHAR)"
_DRAW = _u("impute_mode", _SRID)
cte("resolved", f"""
SELECT source_record_id, printf('LOCMFG%03d', s.n) AS origin_location_id, printf('LOCDST%03d', g.n) AS destination_location_id,
  COALESCE(shipment_mode, CASE WHEN {_DRAW} < 0.62::DOUBLE THEN 'AIR' WHEN {_DRAW} < 0.62::DOUBLE + 0.29::DOUBLE THEN 'TRUCK'
    WHEN {_DRAW} < 0.62::DOUBLE + 0.29::DOUBLE + 0.06::DOUBLE THEN 'AIR_CHARTER' ELSE 'OCEAN' END) AS resolved_mode,
  CAST(shipment_mode IS NULL AS INTEGER) AS mode_imputed_flag,
  CASE WHEN fulfill_via = 'From RDC' THEN {_warehouse('destination_country')} END AS warehouse_id
FROM stg LEFT JOIN site_no s ON s.site = manufacturing_site LEFT JOIN goal_no g ON g.goal = destination_country""")
_STD = "CASE {} WHEN 'AIR' THEN 5 WHEN 'AIR_CHARTER' THEN 3 WHEN 'TRUCK' THEN 4 WHEN 'OCEAN' THEN 32 ELSE 10 END"
cte("lane", f"""
SELECT printf('LANE%05d', ROW_NUMBER() OVER (ORDER BY c.origin_location_id, c.destination_location_id, c.resolved_mode)) AS lane_id,
  c.origin_location_id, c.destination_location_id, o.location_name AS origin_name, d.location_name AS destination_name,
  c.resolved_mode AS transport_mode, d.region AS lane_region, {_STD.format('c.resolved_mode')} AS standard_transit_days,
  'MODE_REGION_STANDARD' AS transit_derivation_method
FROM (SELECT DISTINCT origin_location_id, destination_location_id, resolved_mode FROM resolved) c
JOIN loc o ON o.location_id = c.origin_location_id JOIN loc d ON d.location_id = c.destination_location_id""")
SELECTS["lane_dim"] = "SELECT * FROM lane"
cte("routed", """
SELECT r.*, lane_id FROM resolved r LEFT JOIN lane l ON l.origin_location_id = r.origin_location_id
  AND l.destination_location_id = r.destination_location_id AND l.transport_mode = r.resolved_mode""")
SELECTS["shipment_resolution"] = "SELECT * FROM routed"
_POOL = ("CASE {} WHEN 'AIR' THEN ['CAR03', 'CAR04', 'CAR10'] WHEN 'AIR_CHARTER' THEN ['CAR05', 'CAR04'] "
         "WHEN 'TRUCK' THEN ['CAR06', 'CAR07', 'CAR12'] WHEN 'OCEAN' THEN ['CAR01', 'CAR02', 'CAR09'] END")
cte("grid", f"""
SELECT 'RC-' || lane_id || '-' || carrier_id AS rate_id, carrier_id, lane_id, transport_mode, DATE '2015-01-01' AS effective_start_date,
  DATE '2099-12-31' AS effective_end_date, 'PER_KG' AS rate_basis,
  CAST(CASE transport_mode WHEN 'AIR' THEN 9.35 WHEN 'AIR_CHARTER' THEN 3.85 WHEN 'TRUCK' THEN 1.82 ELSE 1.62 END AS DECIMAL(12,4)) AS rate_per_kg,
  CAST(CASE transport_mode WHEN 'AIR' THEN 120 WHEN 'AIR_CHARTER' THEN 900 WHEN 'TRUCK' THEN 150 ELSE 800 END AS DECIMAL(12,2)) AS minimum_charge,
  CAST(CASE transport_mode WHEN 'AIR' THEN 0.18 WHEN 'AIR_CHARTER' THEN 0.18 WHEN 'TRUCK' THEN 0.25 ELSE 0.12 END AS DECIMAL(6,4)) AS fuel_percentage,
  'USD' AS currency
FROM (SELECT *, unnest({_POOL.format('transport_mode')}) AS carrier_id FROM lane)""")
SELECTS["rate_card_grid"] = ("SELECT * REPLACE (CAST(rate_per_kg AS DOUBLE) AS rate_per_kg, CAST(minimum_charge AS DOUBLE) AS minimum_charge, "
                             "CAST(fuel_percentage AS DOUBLE) AS fuel_percentage) FROM grid")
cte("moved", f"""
SELECT *, arrival - transit_days AS actual_ship_date, due - standard_days AS planned_ship_date, arrival <= DATE '2021-06-01' AS done FROM (
  SELECT s.*, r.origin_location_id, r.destination_location_id, r.resolved_mode, r.mode_imputed_flag, r.warehouse_id, r.lane_id, l.standard_transit_days AS standard_days,
    CAST(GREATEST(1, l.standard_transit_days + (s.reporting_actual_delivery_date - s.reporting_scheduled_delivery_date)) AS INTEGER) AS transit_days,
    s.reporting_scheduled_delivery_date AS due, s.reporting_actual_delivery_date AS arrival, o.country AS origin_country,
    CASE WHEN product_category IS NOT NULL THEN printf('PRD-%s-%02d', substr(product_category, 1, 3),
      s.unit_of_measure_per_pack % 5 + 1) END AS product_id, CAST(substr(z.supplier_id, 4) AS BIGINT) AS supplier_no,
    {_POOL.format('r.resolved_mode')} AS pool
  FROM stg s JOIN routed r ON r.source_record_id = s.source_record_id LEFT JOIN lane l ON l.lane_id = r.lane_id
  LEFT JOIN loc o ON o.location_id = r.origin_location_id LEFT JOIN vendor z ON z.supplier_name = s.vendor_name)""")
cte("po_no", """
SELECT g, printf('PO%06d', ROW_NUMBER() OVER (ORDER BY g)) AS po_id FROM (
  SELECT DISTINCT COALESCE('SRC:' || po_so_number, 'LINE:' || CAST(source_record_id AS VARCHAR)) AS g FROM stg)""")
cte("ship", f"""
SELECT printf('SHP%07d', m.source_record_id) AS shipment_id, m.source_record_id,
  pool[supplier_no % len(pool) + 1] AS carrier_id, lane_id, m.product_id,
  origin_location_id, destination_location_id, warehouse_id, resolved_mode AS shipment_mode, incoterm,
  LEAST(actual_ship_date, planned_ship_date) - 4 AS booking_date, planned_ship_date, actual_ship_date, due AS planned_delivery_date,
  CASE WHEN done THEN arrival END AS actual_delivery_date, line_item_quantity AS planned_quantity, line_item_quantity AS shipped_quantity,
  CASE WHEN done THEN line_item_quantity END AS delivered_quantity,
  COALESCE(CAST(weight_kg AS DECIMAL(14,2)), CAST(ROUND(COALESCE(unit_weight_kg, 0.3::DOUBLE) * line_item_quantity, 2) AS DECIMAL(14,2))) AS shipment_weight_kg,
  CAST(line_item_value_usd AS DECIMAL(16,2)) AS shipment_value_usd, CASE WHEN done THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS shipment_status,
  CAST(NOT COALESCE(origin_country = destination_country, FALSE) AS INTEGER) AS customs_required_flag,
  CAST(m.product_category = 'BATTERY_ESS' AS INTEGER) AS hazmat_flag, CAST(done AS INTEGER) AS is_delivered_flag, 1 AS ship_date_derived_flag,
  CAST(weight_kg IS NULL AS INTEGER) AS weight_imputed_flag, mode_imputed_flag, standard_days, transit_days, m.vendor_name, po_id
FROM moved m LEFT JOIN variant v ON v.product_id = m.product_id
JOIN po_no ON g = COALESCE('SRC:' || po_so_number, 'LINE:' || CAST(m.source_record_id AS VARCHAR))""")
SELECTS["shipment_fact"] = """
SELECT * REPLACE (CAST(shipment_weight_kg AS DOUBLE) AS shipment_weight_kg, CAST(shipment_value_usd AS DOUBLE) AS shipment_value_usd) FROM ship"""


def _mode(column: str, source: str) -> str:
    return (f"(SELECT po_id, {column} FROM (SELECT po_id, {column}, ROW_NUMBER() OVER (PARTITION BY po_id ORDER BY COUNT(*) DESC, {column}) AS r "
            f"FROM {source} WHERE {column} IS NOT NULL GROUP BY 1, 2) WHERE r = 1)")


cte("ship_vendor", "SELECT s.*, supplier_id FROM ship s LEFT JOIN vendor ON supplier_name = vendor_name")
SELECTS["purchase_orders"] = f"""
SELECT g.*, supplier_id, product_id, expected_ship_date - 21 AS po_created_date FROM (
  SELECT po_id, CAST(SUM(planned_quantity) AS BIGINT) AS ordered_quantity,
    CAST((CAST(SUM(shipment_value_usd) * 100 AS HUGEINT) * 200 + SUM(planned_quantity)) // (2 * SUM(planned_quantity)) AS DOUBLE) / 10000 AS unit_price, CAST(SUM(shipment_value_usd) AS DOUBLE) AS purchase_value,
    'USD' AS currency, MIN(planned_ship_date) AS expected_ship_date, MIN(planned_delivery_date) AS expected_delivery_date,
    CASE WHEN bool_and(shipment_status = 'DELIVERED') THEN 'CLOSED' ELSE 'SHIPPED' END AS po_status FROM ship GROUP BY po_id) g
LEFT JOIN {_mode('supplier_id', 'ship_vendor')} a ON a.po_id = g.po_id LEFT JOIN {_mode('product_id', 'ship')} b ON b.po_id = g.po_id"""
# Hundredths of transit elapsed at each milestone, by mode.
_AIR = [("BOOKING_CONFIRMED", -30), ("PICKUP_COMPLETED", -5), ("ORIGIN_DEPARTURE", 0), ("EXPORT_CUSTOMS", 10), ("PORT_ARRIVAL", 55),
        ("IMPORT_CUSTOMS", 75), ("WAREHOUSE_ARRIVAL", 90), ("CUSTOMER_DELIVERY", 100), ("POD_RECEIVED", 105)]
_STEPS = {
    "AIR": _AIR, "AIR_CHARTER": _AIR,
    "OCEAN": [("BOOKING_CONFIRMED", -15), ("PICKUP_COMPLETED", -2), ("ORIGIN_DEPARTURE", 0), ("EXPORT_CUSTOMS", 5), ("PORT_ARRIVAL", 85),
              ("IMPORT_CUSTOMS", 92), ("WAREHOUSE_ARRIVAL", 97), ("CUSTOMER_DELIVERY", 100), ("POD_RECEIVED", 102)],
    "TRUCK": [("BOOKING_CONFIRMED", -25), ("PICKUP_COMPLETED", -2), ("ORIGIN_DEPARTURE", 0), ("WAREHOUSE_ARRIVAL", 80),
              ("OUT_FOR_DELIVERY", 95), ("CUSTOMER_DELIVERY", 100), ("POD_RECEIVED", 103)],
}
_STEP_ROWS = ", ".join(f"('{m}', {i + 1}, '{s}', {h})" for m, steps in _STEPS.items() for i, (s, h) in enumerate(steps))
SELECTS["milestone_schedule"] = f"""
SELECT printf('MS%07d-%02d', source_record_id, n) AS milestone_id, shipment_id, step AS milestone_type, n AS milestone_sequence, planned_timestamp,
  CASE WHEN ok THEN act END AS actual_timestamp, CASE WHEN ok THEN 'COMPLETED' ELSE 'PLANNED' END AS milestone_status, CAST(NULL AS VARCHAR) AS exception_reason
FROM (SELECT *, is_delivered_flag = 1 OR act <= TIMESTAMP '2021-06-01' AS ok FROM (
  SELECT *, CAST(actual_ship_date AS TIMESTAMP) + to_seconds(h * standard_days * 864) AS planned_timestamp,
    CAST(actual_ship_date AS TIMESTAMP) + to_seconds(h * transit_days * 864) AS act
  FROM ship JOIN (VALUES {_STEP_ROWS}) t(m, n, step, h) ON m = shipment_mode))"""
cte("staged_rate", """
SELECT s.shipment_id, s.carrier_id, s.lane_id, s.actual_ship_date, s.shipment_weight_kg, r.rate_id, r.rate_basis, r.rate_per_kg, r.minimum_charge,
  r.fuel_percentage, r.currency AS rate_currency,
  CASE WHEN r.rate_id IS NOT NULL THEN 'RATED' WHEN EXISTS (SELECT 1 FROM grid x WHERE x.carrier_id = s.carrier_id AND x.lane_id = s.lane_id)
    THEN 'EXPIRED_RATE' ELSE 'MISSING_RATE' END AS rate_status,
  CAST(ROUND(CASE WHEN rate_per_kg * shipment_weight_kg > minimum_charge THEN rate_per_kg * shipment_weight_kg ELSE minimum_charge END, 2) AS DECIMAL(14,2)) AS expected_base,
  CAST(ROUND(CASE WHEN rate_per_kg * shipment_weight_kg > minimum_charge THEN rate_per_kg * shipment_weight_kg ELSE minimum_charge END * fuel_percentage, 2) AS DECIMAL(14,2)) AS expected_fuel,
  s.shipment_mode, s.shipment_status
FROM ship s LEFT JOIN grid r ON r.carrier_id = s.carrier_id AND r.lane_id = s.lane_id AND s.actual_ship_date BETWEEN r.effective_start_date AND r.effective_end_date""")
SELECTS["staged_expected_freight"] = "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("shipment_weight_kg", "rate_per_kg", "minimum_charge", "fuel_percentage", "expected_base", "expected_fuel")
) + ") FROM staged_rate"
_NAME = "carrier_id || ':' || lane_id || ':' || period_month"
SELECTS["capacity_build"] = f"""
SELECT 'CAP-' || {_NAME} AS capacity_id, carrier_id, lane_id, CAST(period_month || '-01' AS DATE) AS period_start, period_month,
  available AS available_capacity_kg, load AS booked_capacity_kg, load AS utilized_capacity_kg,
  ROUND(CASE WHEN available <> 0 THEN LEAST(100.0, load / available * 100) ELSE 0 END, 2) AS capacity_utilization_pct
FROM (SELECT * REPLACE (CAST(load AS DOUBLE) AS load), CAST(ROUND(MAX(load) OVER (PARTITION BY carrier_id, lane_id) * 1.22, 2) AS DOUBLE) AS available FROM (
  SELECT carrier_id, lane_id, strftime(actual_ship_date, '%Y-%m') AS period_month, CAST(SUM(shipment_weight_kg) AS DECIMAL(16,2)) AS load FROM ship GROUP BY 1, 2, 3))"""
SELECTS["lane_derivation"] = """
SELECT l.lane_id, origin_name, destination_name, transport_mode, COALESCE(n, 0) AS n_shipments, ROUND(ml, 2) AS median_order_lead_days,
  ROUND(mt, 2) AS median_derived_transit_days, standard_transit_days, 'MODE_REGION_STANDARD' AS derivation_method,
  CASE WHEN COALESCE(n, 0) >= 30 THEN 'HIGH' WHEN COALESCE(n, 0) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS data_sufficiency
FROM lane l LEFT JOIN (SELECT lane_id, COUNT(*) AS n, median(date_diff('day', po_sent_date, s.actual_delivery_date)) AS ml, median(transit_days) AS mt
  FROM ship s JOIN stg ON stg.source_record_id = s.source_record_id GROUP BY lane_id) x ON x.lane_id = l.lane_id"""
SELECTS["rate_reconciliation"] = """
SELECT m.scope AS reconciliation_scope, n AS n_shipments_with_freight, ROUND(o) / 100 AS median_observed_freight, ROUND(e) / 100 AS median_expected_freight,
  ROUND(e / o, 4) AS expected_to_observed_ratio
FROM (SELECT COALESCE(shipment_mode, 'ALL') AS scope, COUNT(*) AS n, median(CAST((expected_base + expected_fuel) * 100 AS BIGINT)) AS e FROM staged_rate
  WHERE expected_base IS NOT NULL AND shipment_status = 'DELIVERED' GROUP BY ROLLUP (shipment_mode)) m
LEFT JOIN (SELECT shipment_mode AS scope, median(CAST(freight_cost_usd * 100 AS BIGINT)) AS o FROM stg WHERE shipment_mode IS NOT NULL AND freight_cost_usd IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'ALL', median(CAST(freight_cost_usd * 100 AS BIGINT)) FROM stg) x ON x.scope = m.scope"""
