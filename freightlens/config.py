"""Business configuration: reporting date, thresholds, weights, owners and maps.

Everything a run may want to change is a field of :class:`Settings`; operators
take the settings (or the one value they need) as an argument.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Severities, weights, service levels, bands, score weights.
# ---------------------------------------------------------------------------
SEVERITY_WEIGHTS = {"CRITICAL": 10, "HIGH": 5, "MEDIUM": 2, "LOW": 1}
SEVERITY_SLA_HOURS = {"CRITICAL": 24, "HIGH": 72, "MEDIUM": 168, "LOW": 336}
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
ACCESSORIAL_BANDS = {
    "DEMURRAGE": "2500.00",
    "DETENTION": "900.00",
    "STORAGE": "1200.00",
    "LIFTGATE": "180.00",
    "CUSTOMS_DOC": "350.00",
}
SCORE_WEIGHTS = {
    "otif": 0.30,
    "transit_reliability": 0.20,
    "cost_competitiveness": 0.15,
    "invoice_accuracy": 0.15,
    "pod_compliance": 0.10,
    "claims": 0.10,
}
SCORE_BANDS = {"preferred": 80.0, "acceptable": 65.0, "improvement": 50.0}
GIT_AGE_BOUNDS = [7, 14, 30, 60]
ACCRUAL_AGE_BOUNDS = [30, 60, 90]

# Business owner of each exception type.
EXCEPTION_OWNERS = {
    "missing_carrier_id": "Transportation Operations",
    "invalid_lane": "Transportation Operations",
    "delivery_before_ship": "Transportation Operations",
    "over_delivery": "Warehouse Operations",
    "partial_delivery": "Warehouse Operations",
    "missing_pod": "Warehouse Operations",
    "missing_customs_doc": "Trade Compliance",
    "missing_hts_code": "Trade Compliance",
    "damaged_shipment_claim": "Logistics Analytics",
    "invoice_carrier_mismatch": "Accounts Payable",
    "incorrect_fuel_surcharge": "Accounts Payable",
    "incorrect_currency": "Accounts Payable",
    "expired_rate_card": "Procurement",
    "duplicate_invoice": "Accounts Payable",
    "duplicate_payment_risk": "Accounts Payable",
    "invoice_without_shipment": "Accounts Payable",
    "unauthorized_detention": "Accounts Payable",
    "excessive_demurrage": "Accounts Payable",
    "shipment_without_invoice": "Logistics Analytics",
    "paid_without_approval": "Accounts Payable",
    "invalid_milestone_sequence": "Transportation Operations",
    "capacity_over_100": "Transportation Operations",
    "broken_po_shipment": "Procurement",
}
DEFAULT_OWNER = "Logistics Analytics"

# Transport modes, transit standards and carrier pools.
TRANSIT_STANDARD_DAYS = {
    "AIR": 5, "AIR_CHARTER": 3, "TRUCK": 4, "OCEAN": 32, "RAIL": 10, "MULTIMODAL": 20,
}
DEFAULT_TRANSIT_DAYS = 10
CARRIER_MODE_POOL = {
    "AIR": ["CAR03", "CAR04", "CAR10"],
    "AIR_CHARTER": ["CAR05", "CAR04"],
    "TRUCK": ["CAR06", "CAR07", "CAR12"],
    "OCEAN": ["CAR01", "CAR02", "CAR09"],
    "RAIL": ["CAR08"],
    "MULTIMODAL": ["CAR09", "CAR11"],
}
IMPUTE_MODE_WEIGHTS = {"AIR": 0.62, "TRUCK": 0.29, "AIR_CHARTER": 0.06, "OCEAN": 0.03}

# Carrier master (id, name, type, primary mode, region, terms).
CARRIERS = [
    ("CAR01", "Helios Ocean Lines", "OCEAN_LINE", "OCEAN", "GLOBAL", "NET45"),
    ("CAR02", "BlueCurrent Shipping", "OCEAN_LINE", "OCEAN", "ASIA_AFRICA", "NET45"),
    ("CAR03", "AeroVolt Air Cargo", "AIR_CARGO", "AIR", "GLOBAL", "NET30"),
    ("CAR04", "VoltLine Express Air", "AIR_CARGO", "AIR", "GLOBAL", "NET30"),
    ("CAR05", "Continental Charter Air", "AIR_CARGO", "AIR_CHARTER", "GLOBAL", "NET30"),
    ("CAR06", "SunHaul Trucking", "TRUCKING", "TRUCK", "AFRICA", "NET30"),
    ("CAR07", "TerraLink Road Freight", "TRUCKING", "TRUCK", "GLOBAL", "NET30"),
    ("CAR08", "PhotonRail Logistics", "RAIL", "RAIL", "EURASIA", "NET45"),
    ("CAR09", "GridWay Multimodal", "MULTIMODAL", "MULTIMODAL", "GLOBAL", "NET45"),
    ("CAR10", "Meridian Freight Forwarders", "FORWARDER", "AIR", "GLOBAL", "NET30"),
    ("CAR11", "Cascade Customs & Brokerage", "BROKER", "MULTIMODAL", "GLOBAL", "NET30"),
    ("CAR12", "LastMile Renewables Delivery", "FINAL_MILE", "TRUCK", "AFRICA", "NET15"),
]

# Warehouses (id, name, region, type, weight capacity, pallets).
WAREHOUSES = [
    ("WH01", "Corridor West Africa DC", "AFRICA", "DISTRIBUTION_CENTER", 5000000, 8000),
    ("WH02", "Corridor Southern Africa DC", "AFRICA", "DISTRIBUTION_CENTER", 6000000, 9000),
    ("WH03", "Corridor SE Asia DC", "ASIA", "DISTRIBUTION_CENTER", 4000000, 7000),
    ("WH04", "Corridor Americas DC", "AMERICAS", "DISTRIBUTION_CENTER", 3500000, 6000),
    ("WH05", "Corridor Europe Hub", "EUROPE", "CROSS_DOCK", 3000000, 5000),
]

# Product categories (label, sku prefix, tariff prefix, flags).
PRODUCT_CATEGORIES = {
    "SOLAR_MODULE": {"label": "Solar Modules", "sku": "EQ-PVM", "hts": "8541",
                     "hazmat": 0, "temp": 0, "stack": 1},
    "INVERTER": {"label": "Inverters", "sku": "EQ-INV", "hts": "8504",
                 "hazmat": 0, "temp": 0, "stack": 1},
    "BATTERY_ESS": {"label": "Battery Energy Storage Systems", "sku": "EQ-BES", "hts": "8507",
                    "hazmat": 1, "temp": 1, "stack": 0},
    "BOS_COMPONENT": {"label": "Electrical Balance-of-System Components", "sku": "EQ-BOS",
                      "hts": "8544", "hazmat": 0, "temp": 0, "stack": 1},
}
# Fixed values: (product group | sub classification) -> category, "*" = any.
PRODUCT_CATEGORY_MAP = {
    "ARV|Adult": "SOLAR_MODULE",
    "ARV|Pediatric": "INVERTER",
    "HRDT|HIV test": "BATTERY_ESS",
    "HRDT|HIV test - Ancillary": "BOS_COMPONENT",
    "ANTM|*": "BOS_COMPONENT",
    "ACT|*": "BOS_COMPONENT",
    "MRDT|*": "BOS_COMPONENT",
}

# Cleaning vocabulary of the raw shipment file.
DATE_SENTINELS = ["Pre-PQ Process", "Date Not Captured", "N/A - From RDC"]
REFERENCE_PATTERN = r"ID#:\s*(\d+)"
WEIGHT_SENTINELS = {"Weight Captured Separately": "missing_captured_separately"}
FREIGHT_SENTINELS = {
    "Freight Included in Commodity Cost": "missing_included_in_commodity",
    "Invoiced Separately": "missing_invoiced_separately",
}
SHIPMENT_MODE_MAP = {
    "Air": "AIR", "Air Charter": "AIR_CHARTER", "Truck": "TRUCK", "Ocean": "OCEAN",
}

# Fraction of transit elapsed at each milestone, by mode.
MILESTONE_SEQUENCE = [
    "BOOKING_CONFIRMED", "PICKUP_COMPLETED", "ORIGIN_DEPARTURE", "EXPORT_CUSTOMS",
    "PORT_ARRIVAL", "IMPORT_CUSTOMS", "WAREHOUSE_ARRIVAL", "OUT_FOR_DELIVERY",
    "CUSTOMER_DELIVERY", "POD_RECEIVED",
]
_AIR_TEMPLATE = {
    "BOOKING_CONFIRMED": -0.30, "PICKUP_COMPLETED": -0.05, "ORIGIN_DEPARTURE": 0.0,
    "EXPORT_CUSTOMS": 0.10, "PORT_ARRIVAL": 0.55, "IMPORT_CUSTOMS": 0.75,
    "WAREHOUSE_ARRIVAL": 0.90, "CUSTOMER_DELIVERY": 1.0, "POD_RECEIVED": 1.05,
}
MILESTONE_TEMPLATES = {
    "OCEAN": {"BOOKING_CONFIRMED": -0.15, "PICKUP_COMPLETED": -0.02, "ORIGIN_DEPARTURE": 0.0,
              "EXPORT_CUSTOMS": 0.05, "PORT_ARRIVAL": 0.85, "IMPORT_CUSTOMS": 0.92,
              "WAREHOUSE_ARRIVAL": 0.97, "CUSTOMER_DELIVERY": 1.0, "POD_RECEIVED": 1.02},
    "AIR": _AIR_TEMPLATE,
    "AIR_CHARTER": _AIR_TEMPLATE,
    "TRUCK": {"BOOKING_CONFIRMED": -0.25, "PICKUP_COMPLETED": -0.02, "ORIGIN_DEPARTURE": 0.0,
              "WAREHOUSE_ARRIVAL": 0.80, "OUT_FOR_DELIVERY": 0.95, "CUSTOMER_DELIVERY": 1.0,
              "POD_RECEIVED": 1.03},
    "RAIL": {"BOOKING_CONFIRMED": -0.20, "PICKUP_COMPLETED": -0.02, "ORIGIN_DEPARTURE": 0.0,
             "WAREHOUSE_ARRIVAL": 0.85, "OUT_FOR_DELIVERY": 0.96, "CUSTOMER_DELIVERY": 1.0,
             "POD_RECEIVED": 1.03},
    "MULTIMODAL": {"BOOKING_CONFIRMED": -0.15, "PICKUP_COMPLETED": -0.02,
                   "ORIGIN_DEPARTURE": 0.0, "EXPORT_CUSTOMS": 0.05, "PORT_ARRIVAL": 0.80,
                   "IMPORT_CUSTOMS": 0.90, "WAREHOUSE_ARRIVAL": 0.96,
                   "CUSTOMER_DELIVERY": 1.0, "POD_RECEIVED": 1.02},
}
DEFAULT_TEMPLATE_MODE = "AIR"

# Tariff of the rate grid, by mode.
RATE_PER_KG = {"AIR": "9.3500", "AIR_CHARTER": "3.8500", "TRUCK": "1.8200", "OCEAN": "1.6200",
               "RAIL": "1.2000", "MULTIMODAL": "2.5000"}
RATE_MINIMUM = {"AIR": "120.00", "AIR_CHARTER": "900.00", "TRUCK": "150.00", "OCEAN": "800.00",
                "RAIL": "400.00", "MULTIMODAL": "600.00"}
RATE_FUEL = {"AIR": "0.1800", "AIR_CHARTER": "0.1800", "TRUCK": "0.2500", "OCEAN": "0.1200",
             "RAIL": "0.1500", "MULTIMODAL": "0.1500"}
RATE_WINDOW = ("2015-01-01", "2099-12-31")

# Fault rates used to size exception samples.
EXCEPTION_RATES = {
    "missing_carrier_id": 0.010, "invalid_lane": 0.008, "duplicate_invoice": 0.012,
    "missing_pod": 0.040, "expired_rate_card": 0.015, "invoice_carrier_mismatch": 0.010,
    "delivery_before_ship": 0.004, "over_delivery": 0.008, "unauthorized_detention": 0.015,
    "excessive_demurrage": 0.010, "incorrect_fuel_surcharge": 0.020,
    "shipment_without_invoice": 0.030, "invoice_without_shipment": 0.006,
    "duplicate_payment_risk": 0.005, "incorrect_currency": 0.006, "missing_hts_code": 0.020,
    "missing_customs_doc": 0.015, "partial_delivery": 0.020, "damaged_shipment_claim": 0.012,
}

# The records each fault type is sampled from.
EXCEPTION_POOLS = {
    **dict.fromkeys(("missing_carrier_id", "invalid_lane", "missing_pod", "delivery_before_ship", "over_delivery",
                     "partial_delivery", "shipment_without_invoice", "damaged_shipment_claim"), "shipment"),
    **dict.fromkeys(("duplicate_invoice", "expired_rate_card", "invoice_carrier_mismatch", "incorrect_fuel_surcharge",
                     "invoice_without_shipment", "duplicate_payment_risk", "incorrect_currency"), "invoice"),
    "missing_customs_doc": "customs", "unauthorized_detention": "detention", "excessive_demurrage": "demurrage",
    "missing_hts_code": "product",
}


@dataclass(frozen=True)
class Settings:
    """One run's parameters. ``as_of`` has no default on purpose."""

    as_of: dt.date
    seed: int = 42
    contract_currency: str = "USD"
    abs_threshold: str = "100.00"
    pct_threshold: str = "0.05"
    min_carrier_shipments: int = 50
    min_lane_shipments: int = 20
    low_service_pct: float = 80.0
    min_month_volume: int = 30
    min_driver_volume: int = 3
    date_shift_years: int = 10
    booking_lead_days: int = 4
    po_lead_days: int = 21
    accrual_lag_days: int = 5
    capacity_headroom: float = 0.22
    lane_sufficiency: tuple[int, int] = (30, 5)
    products_per_category: int = 5
    critical_recall_gate: float = 1.0
    overall_recall_gate: float = 0.95
    severity_weights: dict = field(default_factory=lambda: dict(SEVERITY_WEIGHTS))
    score_weights: dict = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    score_bands: dict = field(default_factory=lambda: dict(SCORE_BANDS))
    accessorial_bands: dict = field(default_factory=lambda: dict(ACCESSORIAL_BANDS))
    git_age_bounds: list = field(default_factory=lambda: list(GIT_AGE_BOUNDS))
    accrual_age_bounds: list = field(default_factory=lambda: list(ACCRUAL_AGE_BOUNDS))
