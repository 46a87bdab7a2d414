"""Raw, all-text shipment records spelled out of the line items.

Every line item becomes one record of the raw file's shape with the blemishes the
staging operators handle: repeated ids, sentinels, unreadable dates, pointers to
other records, blank modes and non-positive quantities.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.config import Settings
from freightlens.operators import dimensions, facts, freight_audit, staging
from freightlens.plans.tower import Tower
from freightlens.session import land, still_landed

# Countries and sites the integer keys are spelled as.
COUNTRIES = ["Angola", "Benin", "Kenya", "Ghana", "Zambia", "South Africa", "Vietnam", "Haiti",
             "Lebanon", "Kazakhstan", "Germany", "Australia", "Pakistan", "Guyana", "Nigeria",
             "Uganda", "Malawi", "Botswana", "Rwanda", "Togo", "Mali", "Senegal", "Belize",
             "Poland", "Atlantis"]
SITES = ["Plant One, India", "Works Nashik 2", "Ludwigshafen Hall", "Granville Australia",
         "Unknown Yard", "Meymac, France", "Paonta Shahib, IN", "Diagnostics Bay US"]
GROUPS = ["ARV", "HRDT", "ANTM", "ACT", "MRDT"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
STAGING = Settings(as_of=dt.date(2021, 6, 1), date_shift_years=20)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _short(day: Column) -> Column:
    """A date as ``2-Jun-06``; put together, as a formatter a row costs far more."""
    return F.concat(F.dayofmonth(day).cast("string"), F.lit("-"), _pick(MONTHS, F.month(day) - 1), F.lit("-"),
                    F.lpad((F.year(day) % 100).cast("string"), 2, "0"))


def _text(number: Column) -> Column:
    return F.coalesce(number.cast("string"), F.lit("null"))


def raw_text(tower: Tower) -> DataFrame:
    k, line = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    # Orders meet their customers first: there are fewer of them than lines. Texts of parts
    # and suppliers come last, so that no shuffle carries them.
    ordered_by = tower["orders"].join(tower["customer"], F.col("o_custkey") == F.col("c_custkey"))
    rows = (tower["lineitem"]
            .join(ordered_by, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(tower["part"], F.col("l_partkey") == F.col("p_partkey"))
            .join(tower["supplier"], F.col("l_suppkey") == F.col("s_suppkey")))
    ident = k * 10 + line
    ordered, shipped = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity").cast("bigint")
    price = F.col("l_extendedprice").cast("decimal(14,2)")
    from_dc = k % 3 == 0
    group = part % 5

    def see(kind: str) -> Column:
        target = F.when((k % 17 == 2) & (line > 2), k * 10 + 2).otherwise(k * 10 + 1)
        return F.concat(F.lit(f"See {kind}-"), _text(k), F.lit(" (ID#:"), _text(target), F.lit(")"))

    columns = {
        "ID": ident.cast("string"),
        "Project Code": F.concat(F.lit("PRJ-"), _text(F.col("o_custkey") % 20)),
        "PQ #": F.concat(F.lit("PQ-"), _text(k)),
        "PO / SO #": F.when(k % 29 != 3, F.concat(F.lit("SO-"), _text(k))),
        "ASN/DN #": F.when(line % 2 == 0, F.concat(F.lit("ASN-"), _text(ident)))
        .otherwise(F.concat(F.lit("DN-"), _text(ident))),
        "Country": _pick(COUNTRIES, F.col("c_nationkey")),
        "Managed By": F.lit("PMO - US"),
        "Fulfill Via": F.when(from_dc, "From RDC").otherwise("Direct Drop"),
        "Vendor INCO Term": F.when(from_dc, "N/A - From RDC").when(k % 3 == 1, "FCA")
        .otherwise("EXW"),
        "Shipment Mode": F.when(k % 31 != 4, _pick(["Air", "Truck", "Ocean", "Air Charter"],
                                                   supp % 4)),
        "PQ First Sent to Client Date": F.when(k % 7 == 1, "Pre-PQ Process")
        .when(k % 7 == 2, "Date Not Captured").otherwise(_short(F.date_sub(ordered, 30))),
        "PO Sent to Vendor Date": F.when(from_dc, "N/A - From RDC")
        .when(k % 11 == 5, "Date Not Captured").otherwise(_short(ordered)),
        "Scheduled Delivery Date": F.when(k % 211 == 3, "to be agreed")
        .otherwise(_short(F.date_add(shipped, 10))),
        "Delivered to Client Date": F.when(k % 307 == 4, "31-Feb-98")
        .otherwise(_short(F.date_add(shipped, (k % 9).cast("int") + 6))),
        "Delivery Recorded Date": _short(F.date_add(shipped, (k % 9).cast("int") + 8)),
        "Product Group": _pick(GROUPS, group),
        "Sub Classification": F.when((group == 0) & (part % 97 == 0), "Other")
        .when(group == 0, F.when(part % 2 == 0, "Adult").otherwise("Pediatric"))
        .when(group == 1, F.when(part % 2 == 0, "HIV test")
              .otherwise("HIV test - Ancillary")).otherwise("Malaria"),
        "Vendor": F.col("s_name"), "Item Description": F.col("p_name"),
        "Molecule/Test Type": F.col("p_type"), "Brand": F.col("p_brand"),
        "Dosage": F.when(part % 6 != 0, F.concat(_text(F.col("p_size")), F.lit("mg"))),
        "Dosage Form": F.when(group == 0, "Tablet").otherwise("Test kit"),
        "Unit of Measure (Per Pack)": F.col("p_size").cast("string"),
        "Line Item Quantity": F.when(k % 401 == 7, "0").when(k % 409 == 8, "unknown")
        .otherwise(qty.cast("string")),
        "Line Item Value": price.cast("string"),
        "Pack Price": F.col("p_retailprice").cast("decimal(12,2)").cast("string"),
        "Unit Price": (F.col("p_retailprice").cast("decimal(12,2)")
                       * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,4)")
        .cast("string"),
        "Manufacturing Site": _pick(SITES, supp % 8),
        "First Line Designation": F.when(part % 2 == 0, "Yes").otherwise("No"),
        "Weight (Kilograms)": F.when(k % 13 == 5, "Weight Captured Separately")
        .when((k % 5 == 2) & (line > 1), see("DN"))
        .otherwise(F.concat((qty * 3).cast("string"), F.lit(".5"))),
        "Freight Cost (USD)": F.when(k % 9 == 1, "Freight Included in Commodity Cost")
        .when(k % 9 == 2, "Invoiced Separately")
        .when((k % 9 == 3) & (line > 1), see("ASN"))
        .otherwise((price * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(12,2)")
                   .cast("string")),
        "Line Item Insurance (USD)": F.when(k % 8 != 0, (
            price * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")
            .cast("string")),
    }
    return rows.select(*[columns[c].alias(c) for c in staging.RAW_COLUMNS])


def faulty_lines(raw: DataFrame) -> DataFrame:
    """(opened, line): records as lines of files, some faulty; those with an open quote apart.

    Of a record's id: every 97th has a line break in its description, every 101st a field
    too many, every 103rd ten fields only, every 107th a quote that nothing closes.
    """
    ident, what = F.col("ID").cast("bigint"), F.col("Item Description")
    broken = F.when(ident % 97 == 5, F.regexp_replace(what, "^(.)", "$1\n")).otherwise(what)
    fields = [broken.alias(c) if c == "Item Description" else F.col(f"`{c}`") for c in raw.columns]
    line = F.to_csv(F.struct(*fields), {"quote": '"', "escape": '"'})
    short = F.to_csv(F.struct(*fields[:10]), {"quote": '"', "escape": '"'})
    lines = F.when(ident % 101 == 7, F.concat(line, F.lit(",surplus"))).when(ident % 103 == 9, short).otherwise(line)
    opened = (ident % 107 == 11) & (ident % 97 != 5)
    return raw.select(opened.alias("opened"), F.when(opened, F.concat(F.lit('"'), lines)).otherwise(lines).alias("line"))


_layers: dict[tuple[str, ...], dict[str, DataFrame]] = {}


def forget() -> None:
    """Stage and conform anew on the next use."""
    _layers.clear()


class Staged:
    """Staged shipments and the model conformed from them, landed layer by layer."""

    def __init__(self, tower: Tower):
        self.tower = tower
        slot = (tower.spark.sparkContext.applicationId, tower.folder, tower.state)
        self._own = _layers.setdefault(slot, {})

    def _get(self, name: str, build) -> DataFrame:
        if not still_landed(self._own.get(name)):
            self._own[name] = land(build(), name)
        return self._own[name]

    @property
    def raw(self) -> DataFrame:
        return raw_text(self.tower)

    @property
    def judged(self) -> DataFrame:
        """Raw rows with their verdict: the operator lands the rows, a reader takes what it needs."""
        if not still_landed(self._own.get("judged")):
            self._own["judged"] = staging.judge(self.raw)
        return self._own["judged"]

    @property
    def staged(self) -> DataFrame:
        """The staged rows for one reader of a few columns: not landed unless they are already."""
        if still_landed(self._own.get("stg")):
            return self._own["stg"]
        return staging.stage(staging.accepted(self.judged), STAGING.date_shift_years)

    @property
    def stg(self) -> DataFrame:
        return self._get("stg", lambda: self.staged)

    @property
    def location(self) -> DataFrame:
        return self._locations()[0]

    @property
    def xref(self) -> DataFrame:
        return self._locations()[1]

    def _locations(self) -> tuple[DataFrame, DataFrame]:
        if not still_landed(self._own.get("location")):
            dim, xref = dimensions.locations(self.stg)
            self._own["location"], self._own["xref"] = land(dim, "location"), land(xref, "xref")
        return self._own["location"], self._own["xref"]

    @property
    def product(self) -> DataFrame:
        return self._get("product", lambda: dimensions.products(
            self.stg, STAGING.products_per_category))

    @property
    def supplier(self) -> DataFrame:
        return self._get("supplier", lambda: dimensions.suppliers(self.stg, self.location))

    @property
    def resolved(self) -> DataFrame:
        return self._get("resolved", lambda: dimensions.resolve(
            self.stg, self.xref, STAGING.seed))

    @property
    def lane(self) -> DataFrame:
        return self._get("lane", lambda: dimensions.lanes(self.resolved, self.location))

    @property
    def routed(self) -> DataFrame:
        return self._get("routed", lambda: dimensions.attach_lanes(self.resolved, self.lane))

    @property
    def rate_card(self) -> DataFrame:
        return self._get("rate_card", lambda: dimensions.rate_cards(self.lane))

    @property
    def shipment(self) -> DataFrame:
        return self._get("staged_shipment", lambda: facts.assign_po(facts.derive_shipments(
            self.stg, self.routed, self.lane, self.product, self.location, self.supplier,
            STAGING), self.stg))

    @property
    def purchase_order(self) -> DataFrame:
        vendors = self.supplier.select("supplier_id", "supplier_name")
        rows = self.shipment.join(
            vendors, self.shipment["vendor_name"] == vendors["supplier_name"], "left")
        return facts.purchase_orders(rows, STAGING.po_lead_days)

    @property
    def expected(self) -> DataFrame:
        return self._get("staged_expected", lambda: freight_audit.expected_freight(
            self.shipment, self.rate_card, ("shipment_mode", "shipment_status")))
