"""The logistics model derived from order and line-item tables.

Key arithmetic turns every order with lines into a shipment and hangs invoices,
milestones, claims and the rest off it, defects included, so each operator has
data that grows with its input. A table is derived on first use, landed once per
session and source folder, and read from there by every later plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.config import CARRIERS, PRODUCT_CATEGORIES, Settings
from freightlens.functions.expr import lookup, month_key
from freightlens.operators import accruals, detection, facts, freight_audit, shipments
from freightlens.operators.rules import RULES
from freightlens.session import land, source_state, still_landed

AS_OF = dt.date(2001, 6, 1)
SETTINGS = Settings(as_of=AS_OF)
MODES = ["AIR", "TRUCK", "OCEAN", "AIR_CHARTER"]
MODE_DAYS = {"AIR": 5, "TRUCK": 4, "OCEAN": 32, "AIR_CHARTER": 3}
CATEGORY_OF_TYPE = {
    "ECONOMY": "SOLAR_MODULE", "STANDARD": "SOLAR_MODULE", "MEDIUM": "INVERTER",
    "PROMO": "INVERTER", "LARGE": "BATTERY_ESS", "SMALL": "BOS_COMPONENT",
}
SOURCES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

_landed: dict[tuple[str, ...], DataFrame] = {}


def forget() -> None:
    """Derive every table anew on its next use."""
    _landed.clear()


def _key() -> Column:
    return F.col("shipment_id")


def _dec(text: str, precision: int = 12, scale: int = 2) -> Column:
    return F.lit(text).cast(f"decimal({precision},{scale})")


def _every(n: int, r: int) -> Column:
    return _key() % n == r


def _stamp(day: Column) -> Column:
    return day.cast("timestamp_ntz")


class Tower(Mapping):
    """Lazy mapping from table name to DataFrame for one source folder."""

    def __init__(self, spark: SparkSession, folder: str, landed: bool = True):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.state = "".join(source_state(spark, f"{self.folder}/{name}.parquet") for name in SOURCES)
        self.landed = landed
        self._own: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter([*SOURCES, *_BUILDERS])

    def __len__(self) -> int:
        return len(SOURCES) + len(_BUILDERS)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._own:
            return self._own[name]
        if name in SOURCES:
            frame = self._source(name)
        elif name not in _BUILDERS:
            raise KeyError(name)
        elif not self.landed:
            frame = _BUILDERS[name](self)
        else:
            slot = (self.spark.sparkContext.applicationId, self.folder, self.state, name)
            if not still_landed(_landed.get(slot)):
                _landed[slot] = land(_BUILDERS[name](self), name)
            frame = _landed[slot]
        self._own[name] = frame
        return frame

    def _source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- dimensions ------------------------------------------------------
    def _dim_carrier(self) -> DataFrame:
        slot = (F.col("s_suppkey") % 12).alias("carrier_id")

        def attribute(position: int) -> Column:
            return lookup({i: c[position] for i, c in enumerate(CARRIERS)},
                          F.col("carrier_id").cast("int"))

        return self["supplier"].select(slot).distinct().select(
            "carrier_id", attribute(1).alias("carrier_name"),
            attribute(2).alias("carrier_type"),
            F.element_at(F.array(*map(F.lit, MODES)), (F.col("carrier_id") % 4 + 1).cast("int"))
            .alias("primary_mode"),
            attribute(4).alias("operating_region"), attribute(5).alias("payment_terms"),
            F.lit("USD").alias("default_currency"), F.lit(1).alias("active_flag"),
            F.lit("SIMULATED").alias("data_class"))

    def _dim_location(self) -> DataFrame:
        places = self["nation"].join(
            self["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("location_id"),
            F.concat("n_name", F.lit(" Distribution Center")).alias("location_name"),
            F.col("n_name").alias("country"), F.col("r_name").alias("region"),
            F.lit("DISTRIBUTION_CENTER").alias("location_type"))
        hubs = self["supplier"].select(
            (F.col("s_suppkey") % 5 + 100).alias("location_id")).distinct().select(
            "location_id", F.format_string("Hub %d", "location_id").alias("location_name"),
            F.lit(None).cast("string").alias("country"), F.lit("UNKNOWN").alias("region"),
            F.lit("MANUFACTURING_SITE").alias("location_type"))
        return places.unionByName(hubs).withColumns(
            {"active_flag": F.lit(1), "data_class": F.lit("DERIVED")})

    def _dim_lane(self) -> DataFrame:
        ways = F.posexplode(F.array(*map(F.lit, MODES))).alias("mode_no", "transport_mode")
        lanes = self["nation"].join(
            self["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("destination_location_id"),
            F.concat("n_name", F.lit(" Distribution Center")).alias("destination_name"),
            F.col("r_name").alias("lane_region"), ways)
        return lanes.select(
            (F.col("destination_location_id") * 4 + F.col("mode_no")).alias("lane_id"),
            (F.col("mode_no") + 100).cast("bigint").alias("origin_location_id"),
            "destination_location_id",
            F.format_string("Hub %d", F.col("mode_no") + 100).alias("origin_name"),
            "destination_name", "transport_mode", "lane_region",
            lookup(MODE_DAYS, F.col("transport_mode")).alias("standard_transit_days"),
            F.lit("MODE_REGION_STANDARD").alias("transit_derivation_method"),
            F.lit(1).alias("active_flag"), F.lit("DERIVED").alias("data_class"))

    def _dim_product(self) -> DataFrame:
        key, category = F.col("p_partkey"), lookup(CATEGORY_OF_TYPE, F.col("p_type"))

        def trait(name: str) -> Column:
            return lookup({c: a[name] for c, a in PRODUCT_CATEGORIES.items()}, category)

        code = F.concat(trait("hts"), F.lit(".40."), F.substring(category, 1, 3))
        return self["part"].select(
            key.alias("product_id"),
            F.concat(trait("sku"), F.lit("-"), key.cast("string")).alias("product_sku"),
            category.alias("product_category"), F.col("p_name").alias("product_description"),
            F.lit("PACK").alias("unit_of_measure"),
            F.when(key % 50 != 7, code).alias("hts_code"),
            trait("hazmat").alias("hazardous_material_flag"),
            trait("temp").alias("temperature_controlled_flag"),
            F.lit(1).alias("active_flag"), F.lit("SIMULATED").alias("data_class"))

    def _dim_supplier(self) -> DataFrame:
        return self["supplier"].select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
            F.col("s_nationkey").cast("bigint").alias("supplier_location_id"))

    def _dim_rate_card(self) -> DataFrame:
        pairs = self["dim_carrier"].select("carrier_id", "primary_mode").join(
            self["dim_lane"].select("lane_id", "transport_mode"),
            F.col("primary_mode") == F.col("transport_mode"))
        mark = F.col("carrier_id") * 31 + F.col("lane_id")
        split, overlap, lapsed = mark % 5 == 1, mark % 23 == 2, mark % 17 == 0
        day = lambda text: F.lit(text).cast("date")
        last = F.when(lapsed, day("1999-06-30")).otherwise(day("2099-12-31"))
        first = F.struct(
            F.lit(1).alias("version"), day("1994-01-01").alias("effective_start_date"),
            F.when(split | overlap, day("1997-12-31")).otherwise(last)
            .alias("effective_end_date"))
        second = F.when(split | overlap, F.struct(
            F.lit(2).alias("version"),
            F.when(overlap, day("1997-07-01")).otherwise(day("1998-01-01"))
            .alias("effective_start_date"), last.alias("effective_end_date")))
        # A short promotion inside the long window keeps two windows overlapping.
        third = F.when(mark % 19 == 3, F.struct(
            F.lit(3).alias("version"), day("1996-03-01").alias("effective_start_date"),
            day("1996-04-30").alias("effective_end_date")))
        rows = pairs.withColumn("w", F.explode(F.array_compact(F.array(first, second, third))))
        version = F.col("w.version")
        per_kg = (_dec("1.5000", 12, 4) + F.col("carrier_id").cast("decimal(6,0)")
                  * _dec("0.3700", 12, 4)) * F.when(version == 2, _dec("1.10", 4, 2)).when(
                      version == 3, _dec("0.50", 4, 2)).otherwise(_dec("1.00", 4, 2))
        return rows.select(
            ((F.col("carrier_id") * 10000 + F.col("lane_id")) * 10 + version).alias("rate_id"),
            "carrier_id", "lane_id", "transport_mode", "w.effective_start_date",
            "w.effective_end_date", F.lit("PER_KG").alias("rate_basis"),
            F.round(per_kg, 4).cast("decimal(12,4)").alias("rate_per_kg"),
            (F.col("lane_id").cast("decimal(10,0)") + _dec("120.00")).cast("decimal(12,2)")
            .alias("minimum_charge"),
            (_dec("0.1200", 6, 4) + (F.col("lane_id") % 4).cast("decimal(2,0)")
             * _dec("0.0300", 6, 4)).cast("decimal(6,4)").alias("fuel_percentage"),
            F.lit("USD").alias("currency"))

    # -- facts -----------------------------------------------------------
    def _stg_shipment(self) -> DataFrame:
        return self["orders"].select(F.col("o_orderkey").alias("source_record_id"))

    def _fact_shipment(self) -> DataFrame:
        lines = self["lineitem"].groupBy(F.col("l_orderkey").alias("shipment_id")).agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
            F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("val"),
            F.min("l_suppkey").alias("supp"), F.min("l_partkey").alias("part"))
        orders = self["orders"].select(
            F.col("o_orderkey").alias("shipment_id"), "o_custkey",
            F.col("o_orderdate").cast("date").alias("ordered"))
        nation = self["customer"].select("c_custkey", F.col("c_nationkey").cast("bigint")
                                         .alias("nation"))
        rows = orders.join(lines, "shipment_id").join(
            nation, F.col("o_custkey") == F.col("c_custkey"))
        k, mode_no = _key(), (F.col("supp") % 4).cast("int")
        mode = F.element_at(F.array(*map(F.lit, MODES)), mode_no + 1)
        std = lookup(MODE_DAYS, mode)
        rows = rows.withColumns({"shipment_mode": mode, "std": std}).withColumns({
            "planned_ship_date": F.date_add("ordered", 2)})
        rows = rows.withColumns({
            "actual_ship_date": F.date_add("planned_ship_date", (k * 7 % 3).cast("int")),
            "planned_delivery_date": F.date_add("planned_ship_date", F.col("std"))})
        arrival = F.date_add("actual_ship_date", F.greatest(
            F.lit(1), (F.col("std") + k * 13 % 7 - 3).cast("int")))
        rows = rows.withColumn("arrival", arrival).withColumn(
            "done", (F.col("arrival") <= F.lit(AS_OF)) & (k % 149 != 11))
        done, qty = F.col("done"), F.col("qty")
        return rows.select(
            "shipment_id", k.alias("source_record_id"),
            F.when(_every(211, 9), -k).otherwise(
                F.col("o_custkey") * 10000 + F.year("ordered")).alias("po_id"),
            F.when(k % 97 != 5, F.col("supp") % 12).alias("carrier_id"),
            F.when(_every(113, 7), F.lit(9999).cast("bigint"))
            .otherwise(F.col("nation") * 4 + mode_no).alias("lane_id"),
            F.col("part").alias("product_id"), F.col("supp").alias("supplier_id"),
            (F.lit(100) + F.col("supp") % 5).alias("origin_location_id"),
            F.col("nation").alias("destination_location_id"),
            F.when(_every(3, 0), F.col("nation") % 5).alias("warehouse_id"),
            "shipment_mode",
            F.when(_every(3, 1), "FCA").when(_every(3, 2), "EXW").alias("incoterm"),
            F.date_sub(F.least("planned_ship_date", "actual_ship_date"), 4)
            .alias("booking_date"),
            "planned_ship_date", "actual_ship_date", "planned_delivery_date",
            F.when(done & _every(131, 17), F.date_sub("actual_ship_date", 2))
            .when(done, F.col("arrival")).alias("actual_delivery_date"),
            qty.alias("planned_quantity"), qty.alias("shipped_quantity"),
            F.when(done, F.when(_every(50, 1), F.floor(qty * 7 / 10))
                   .when(_every(125, 2), qty + 1).otherwise(qty)).alias("delivered_quantity"),
            (qty * 3).cast("decimal(14,2)").alias("shipment_weight_kg"),
            F.col("val").cast("decimal(16,2)").alias("shipment_value_usd"),
            F.when(done, "DELIVERED").otherwise("IN_TRANSIT").alias("shipment_status"),
            (k % 4 != 0).cast("int").alias("customs_required_flag"),
            (k % 10 == 0).cast("int").alias("hazmat_flag"))

    def _fact_purchase_order(self) -> DataFrame:
        whole = self["fact_shipment"].filter(F.col("po_id") > 0)
        return facts.purchase_orders(whole, SETTINGS.po_lead_days)

    def _expected_freight(self) -> DataFrame:
        return freight_audit.expected_freight(self["fact_shipment"], self["dim_rate_card"])

    def _delivered(self) -> DataFrame:
        return self["fact_shipment"].filter("shipment_status = 'DELIVERED'")

    def _fact_accessorial_charge(self) -> DataFrame:
        k = _key()
        slot = (k % 12).cast("int")
        amount = (F.when(slot == 1, 400 + 8 * k % 2300).when(slot == 2, 150 + 9 * k % 800)
                  .otherwise(100 + 10 * k % 1150))
        return self._delivered().filter(slot.between(1, 3)).select(
            (k * 10 + slot).alias("accessorial_id"), (k * 10).alias("invoice_id"),
            "shipment_id",
            F.element_at(F.array(F.lit("DEMURRAGE"), F.lit("DETENTION"), F.lit("STORAGE")), slot)
            .alias("charge_type"),
            amount.cast("decimal(12,2)").alias("charge_amount"),
            (k % 35 != slot + 1).cast("int").alias("supporting_document_flag"),
            (k % 60 != slot).cast("int").alias("contractually_allowed_flag"))

    def _fact_freight_invoice(self) -> DataFrame:
        k = _key()
        ship = self._delivered().filter(k % 33 != 1).select(
            "shipment_id", "supplier_id", F.col("carrier_id").alias("sc"), "actual_ship_date",
            "actual_delivery_date", "shipment_weight_kg")
        rate = self["expected_freight"].select("shipment_id", "expected_base",
                                               "fuel_percentage")
        extra = self["fact_accessorial_charge"].select("shipment_id", "charge_amount")
        rows = ship.join(rate, "shipment_id").join(extra, "shipment_id", "left")
        usual = F.col("supplier_id") % 12
        share = (F.when(_every(300, 14), 80).otherwise(98 + 17 * k % 5)).cast("decimal(3,0)")
        start = F.coalesce("expected_base", F.col("shipment_weight_kg") * _dec("2", 1, 0))
        base = F.round(start.cast("decimal(16,2)") * share * _dec("0.01", 3, 2), 2) \
            .cast("decimal(14,2)")
        fuel = F.round(
            F.col("base_charge") * F.coalesce("fuel_percentage", _dec("0.1500", 6, 4))
            * F.when(_every(51, 4), _dec("1.6", 2, 1)).otherwise(_dec("1.0", 2, 1)), 2)
        rows = rows.withColumn("base_charge", base).withColumn(
            "fuel_surcharge", fuel.cast("decimal(14,2)"))
        extra_charge = F.coalesce("charge_amount", _dec("0.00")).cast("decimal(14,2)")
        total = (F.col("base_charge") + F.col("fuel_surcharge") + extra_charge
                 + F.when(_every(400, 11), _dec("5.00")).otherwise(_dec("0.00")))
        pending, unpaid = _every(250, 6), _every(5, 0)
        paid = F.when(unpaid, "UNPAID").otherwise("PAID")
        number = F.concat(F.lit("FIN-"), k.cast("string"))

        def copy(offset: int, num: Column, owner: Column, pay: Column) -> Column:
            return F.struct((k * 10 + offset).alias("invoice_id"), num.alias("invoice_number"),
                            owner.alias("shipment_id"), pay.alias("payment_status"))

        copies = F.array_compact(F.array(
            copy(0, number, k, paid),
            F.when(_every(83, 3), copy(1, number, k, paid)),
            F.when(~unpaid & _every(199, 8),
                   copy(2, F.concat(number, F.lit("-R")), k, F.lit("PAID"))),
            F.when(_every(170, 12), copy(5, F.concat(number, F.lit("-O")), -k, paid))))
        rows = rows.withColumns({
            "carrier": F.when(_every(101, 3), (F.coalesce("sc", F.lit(0)) + 1) % 12)
            .otherwise(F.coalesce("sc", usual)),
            "accessorial_charge": extra_charge, "invoice_total": total.cast("decimal(14,2)"),
            "money": F.when(_every(167, 5), "EUR").otherwise("USD"),
            "approval_status": F.when(pending, "PENDING").otherwise("APPROVED"),
            "copy": F.explode(copies)})
        return rows.select(
            "copy.invoice_id", "copy.invoice_number", "copy.shipment_id",
            F.col("carrier").alias("carrier_id"),
            F.date_add("actual_delivery_date", 3).alias("invoice_date"),
            F.col("actual_ship_date").alias("service_period_start"),
            F.col("actual_delivery_date").alias("service_period_end"),
            "base_charge", "fuel_surcharge", "accessorial_charge",
            _dec("0.00", 14, 2).alias("tax_amount"), "invoice_total",
            F.col("money").alias("currency"), "approval_status", "copy.payment_status")

    def _fact_invoice_line(self) -> DataFrame:
        return facts.invoice_lines(self["fact_freight_invoice"])

    def _fact_invoice_approval(self) -> DataFrame:
        stages = ["LOGISTICS_REVIEW", "RATE_VALIDATION", "FINANCE_APPROVAL", "PAYMENT_RELEASE"]
        rows = self["fact_freight_invoice"].select(
            "invoice_id", "invoice_date", "approval_status",
            F.posexplode(F.array(*map(F.lit, stages))).alias("no", "approval_stage"))
        waits = (F.col("approval_status") == "PENDING") & (F.col("no") >= 2)
        return rows.select(
            (F.col("invoice_id") * 10 + F.col("no") + 1).alias("approval_id"), "invoice_id",
            "approval_stage", _stamp(F.date_add("invoice_date", F.col("no"))).alias(
                "submitted_timestamp"),
            F.when(waits, "PENDING").otherwise("APPROVED").alias("approval_status"))

    def _fact_proof_of_delivery(self) -> DataFrame:
        shift = F.when(_every(401, 3), -1).otherwise(1)
        return self._delivered().filter(_key() % 25 != 4).select(
            _key().alias("pod_id"), "shipment_id",
            _stamp(F.col("actual_delivery_date")).alias("delivery_timestamp"),
            _stamp(F.date_add("actual_delivery_date", shift)).alias("received_timestamp"),
            F.lit("RECEIVED").alias("pod_status"))

    def _fact_claim(self) -> DataFrame:
        k = _key()
        amount = F.round(F.col("shipment_value_usd") * _dec("0.08", 3, 2), 2)
        return self._delivered().filter((k % 40).isin(3, 8)).select(
            k.alias("claim_id"), "shipment_id",
            F.when(_every(3, 0), "DAMAGE").otherwise("SHORTAGE").alias("claim_type"),
            amount.cast("decimal(14,2)").alias("claim_amount"),
            F.when(_every(4, 0), "OPEN").otherwise("CLOSED").alias("claim_status"),
            F.when(_every(2, 0), "ROUGH_HANDLING").otherwise("PORT_CONGESTION")
            .alias("root_cause"),
            F.date_add("actual_delivery_date", 5).alias("created_date"),
            F.when(k % 4 != 0, F.date_add("actual_delivery_date", 35)).alias("closed_date"))

    def _fact_shipment_milestone(self) -> DataFrame:
        types = ["BOOKING_CONFIRMED", "ORIGIN_DEPARTURE", "IMPORT_CUSTOMS",
                 "WAREHOUSE_ARRIVAL", "CUSTOMER_DELIVERY"]
        rows = self["fact_shipment"].select(
            "shipment_id", "actual_ship_date", "shipment_status",
            F.posexplode(F.array(*map(F.lit, types))).alias("no", "milestone_type"))
        seq, moving = F.col("no") + 1, F.col("shipment_status") == "IN_TRANSIT"
        customs = (seq == 3) & ~moving & _every(61, 9)
        last = (seq == 5) & ~moving & _every(77, 5)
        status = (F.when(moving & (seq > 2), "PLANNED").when(customs | last, "MISSED")
                  .otherwise("COMPLETED"))
        early = F.when((seq == 3) & _every(90, 8), -10).otherwise(0)
        return rows.select(
            (_key() * 10 + seq).alias("milestone_id"), "shipment_id", "milestone_type",
            seq.alias("milestone_sequence"),
            _stamp(F.date_add("actual_ship_date", seq)).alias("planned_timestamp"),
            F.when(status == "COMPLETED", _stamp(F.date_add("actual_ship_date", seq + early)))
            .alias("actual_timestamp"),
            status.alias("milestone_status"),
            F.when(customs, "MISSING_CUSTOMS_DOCUMENTATION")
            .when(last, "DELIVERY_NOT_CONFIRMED").alias("exception_reason"))

    def _fact_carrier_capacity(self) -> DataFrame:
        month = month_key(F.col("actual_ship_date"))
        load = (self["fact_shipment"].filter(F.col("carrier_id").isNotNull())
                .groupBy("carrier_id", "lane_id", month.alias("period_month"))
                .agg(F.sum("shipment_weight_kg").cast("decimal(16,2)").alias("utilized")))
        return load.select(
            F.concat_ws("-", F.col("carrier_id").cast("string"),
                        F.col("lane_id").cast("string"), "period_month").alias("capacity_id"),
            "carrier_id", "lane_id",
            F.concat("period_month", F.lit("-01")).cast("date").alias("period_start"),
            "period_month", _dec("1600.00", 16, 2).alias("available_capacity_kg"),
            F.col("utilized").alias("utilized_capacity_kg"),
            F.round(F.col("utilized") * _dec("0.0625", 5, 4), 2).cast("decimal(12,2)")
            .alias("capacity_utilization_pct"))

    def _fact_accrual(self) -> DataFrame:
        originals = self["fact_freight_invoice"].filter("invoice_id % 10 = 0")
        return accruals.build_accruals(self["expected_freight"], self["fact_shipment"],
                                       originals, AS_OF, SETTINGS.accrual_lag_days)

    def _meta_exception_manifest(self) -> DataFrame:
        """Known faults, restated from the key predicates that planted them."""
        k = _key()
        done = F.col("shipment_status") == "DELIVERED"
        billed = done & (k % 33 != 1)
        planted = [
            ("missing_carrier_id", _every(97, 5), k),
            ("invalid_lane", _every(113, 7), k),
            ("delivery_before_ship", done & _every(131, 17), k),
            ("over_delivery", done & _every(125, 2), k),
            ("partial_delivery", done & _every(50, 1), k),
            ("missing_pod", done & _every(25, 4), k),
            ("shipment_without_invoice", done & _every(33, 1), k),
            ("missing_customs_doc", done & _every(61, 9), k * 10 + 3),
            ("damaged_shipment_claim", done & _every(240, 48), k),
            ("invoice_carrier_mismatch", billed & _every(101, 3), k * 10),
            ("incorrect_fuel_surcharge", billed & _every(51, 4), k * 10),
            ("incorrect_currency", billed & _every(167, 5), k * 10),
            ("duplicate_invoice", billed & _every(83, 3), k * 10 + 1),
            ("duplicate_payment_risk", billed & _every(199, 8) & (k % 5 != 0), k * 10 + 2),
            ("invoice_without_shipment", billed & _every(170, 12), k * 10 + 5),
            ("unauthorized_detention", done & ((k % 12).between(1, 3)) & (k % 60 == k % 12),
             k * 10 + k % 12),
        ]
        marks = F.array_compact(F.array(*[
            F.when(test, F.struct(F.lit(kind).alias("exception_type"),
                                  record.cast("string").alias("record_id")))
            for kind, test, record in planted]))
        moved = self["fact_shipment"].select(F.explode(marks).alias("m")).select("m.*")
        goods = self["dim_product"].filter(F.col("product_id") % 50 == 7).select(
            F.lit("missing_hts_code").alias("exception_type"),
            F.col("product_id").cast("string").alias("record_id"))
        severity = {r.exception_type: r.severity for r in RULES}
        rule = {r.exception_type: r.rule_id for r in RULES}
        kind = F.col("exception_type")
        return moved.unionByName(goods).select(
            F.concat_ws(":", kind, "record_id").alias("exception_manifest_id"), kind,
            "record_id", lookup(severity, kind).alias("severity"),
            lookup(rule, kind).alias("expected_detection_rule"))

    # -- materialised results ----------------------------------------------
    def _analytics_shipment(self) -> DataFrame:
        return shipments.analytics_base(
            self["fact_shipment"], self["dim_lane"], self["dim_location"], self["dim_product"],
            self["dim_carrier"], self["fact_proof_of_delivery"], self["fact_freight_invoice"],
            AS_OF)

    def _freight_audit(self) -> DataFrame:
        return freight_audit.audit_invoices(
            self["fact_freight_invoice"], self["expected_freight"],
            self["fact_accessorial_charge"], SETTINGS)

    def _dq_detected_exception(self) -> DataFrame:
        return detection.materialize(detection.detect(self, SETTINGS), AS_OF)

    def _dq_detection_performance(self) -> DataFrame:
        return detection.reconcile(self["meta_exception_manifest"],
                                   self["dq_detected_exception"], DETECTION_NOTES)


DETECTION_NOTES = {
    "duplicate_payment_risk": "Copies of a paid invoice are second payments too.",
    "damaged_shipment_claim": "Every open damage claim needs action, planted or not.",
    "invoice_carrier_mismatch": "A shipment without a carrier cannot disagree with it.",
}

_BUILDERS: dict[str, Callable[[Tower], DataFrame]] = {
    name: getattr(Tower, f"_{name}") for name in [
        "dim_carrier", "dim_location", "dim_lane", "dim_product", "dim_supplier",
        "dim_rate_card", "stg_shipment", "fact_shipment", "fact_purchase_order",
        "expected_freight", "fact_accessorial_charge", "fact_freight_invoice",
        "fact_invoice_line", "fact_invoice_approval", "fact_proof_of_delivery", "fact_claim",
        "fact_shipment_milestone", "fact_carrier_capacity", "fact_accrual",
        "meta_exception_manifest", "analytics_shipment", "freight_audit",
        "dq_detected_exception", "dq_detection_performance"]
}
