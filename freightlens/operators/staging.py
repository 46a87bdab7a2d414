"""Staging raw, all-text shipment records: validation, parsing, references."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.config import (
    DATE_SENTINELS, FREIGHT_SENTINELS, PRODUCT_CATEGORY_MAP, REFERENCE_PATTERN,
    SHIPMENT_MODE_MAP, WEIGHT_SENTINELS,
)
from freightlens.functions.expr import lookup, number, parse_short_date
from freightlens.operators.distributed import mark_rows
from freightlens.session import land
from freightlens.sources.records import MALFORMED

# Columns of the raw file, in file order.
RAW_COLUMNS = [
    "ID", "Project Code", "PQ #", "PO / SO #", "ASN/DN #", "Country", "Managed By",
    "Fulfill Via", "Vendor INCO Term", "Shipment Mode", "PQ First Sent to Client Date",
    "PO Sent to Vendor Date", "Scheduled Delivery Date", "Delivered to Client Date",
    "Delivery Recorded Date", "Product Group", "Sub Classification", "Vendor",
    "Item Description", "Molecule/Test Type", "Brand", "Dosage", "Dosage Form",
    "Unit of Measure (Per Pack)", "Line Item Quantity", "Line Item Value", "Pack Price",
    "Unit Price", "Manufacturing Site", "First Line Designation", "Weight (Kilograms)",
    "Freight Cost (USD)", "Line Item Insurance (USD)",
]
_NO_INCOTERM = "N/A - From RDC"


@dataclass(frozen=True)
class Target:
    """One staged column: where it comes from and how it is read."""

    name: str
    source: str
    kind: str  # text | date | bigint | decimal(p,s) | custom


# The staged columns in order; "custom" ones are spelled out in stage().
TARGETS = [
    Target("source_record_id", "ID", "bigint"),
    Target("po_so_number", "PO / SO #", "text"),
    Target("asn_dn_number", "ASN/DN #", "text"),
    Target("project_code", "Project Code", "text"),
    Target("destination_country", "Country", "text"),
    Target("managed_by", "Managed By", "text"),
    Target("fulfill_via", "Fulfill Via", "text"),
    Target("incoterm", "Vendor INCO Term", "custom"),
    Target("shipment_mode_raw", "Shipment Mode", "text"),
    Target("shipment_mode", "Shipment Mode", "custom"),
    Target("missing_mode_flag", "Shipment Mode", "custom"),
    Target("pq_first_sent_date", "PQ First Sent to Client Date", "date"),
    Target("po_sent_date", "PO Sent to Vendor Date", "date"),
    Target("scheduled_delivery_date", "Scheduled Delivery Date", "date"),
    Target("actual_delivery_date", "Delivered to Client Date", "date"),
    Target("delivery_recorded_date", "Delivery Recorded Date", "date"),
    Target("product_group_raw", "Product Group", "text"),
    Target("sub_classification_raw", "Sub Classification", "text"),
    Target("product_category", "Product Group + Sub Classification", "custom"),
    Target("vendor_name", "Vendor", "text"),
    Target("item_description_raw", "Item Description", "text"),
    Target("manufacturing_site", "Manufacturing Site", "text"),
    Target("first_line_designation", "First Line Designation", "custom"),
    Target("unit_of_measure_per_pack", "Unit of Measure (Per Pack)", "bigint"),
    Target("line_item_quantity", "Line Item Quantity", "bigint"),
    Target("line_item_value_usd", "Line Item Value", "decimal(14,2)"),
    Target("pack_price_usd", "Pack Price", "decimal(12,2)"),
    Target("unit_price_usd", "Unit Price", "decimal(12,4)"),
    Target("weight_kg", "Weight (Kilograms)", "custom"),
    Target("weight_source", "Weight (Kilograms)", "custom"),
    Target("freight_cost_usd", "Freight Cost (USD)", "custom"),
    Target("freight_cost_source", "Freight Cost (USD)", "custom"),
    Target("line_item_insurance_usd", "Line Item Insurance (USD)", "decimal(12,2)"),
    Target("reporting_scheduled_delivery_date", "Scheduled Delivery Date", "custom"),
    Target("reporting_actual_delivery_date", "Delivered to Client Date", "custom"),
]


def parse_date(text: Column, sentinels: list[str] = DATE_SENTINELS) -> Column:
    """Short date, NULL for a sentinel or anything unreadable."""
    return F.when(~text.isin(*sentinels), parse_short_date(text))


def product_category(group: Column, sub: Column,
                     mapping: dict[str, str] = PRODUCT_CATEGORY_MAP) -> Column:
    """Category by (group, sub), else by (group, any), else NULL."""
    return F.coalesce(lookup(mapping, F.concat_ws("|", group, sub)),
                      lookup(mapping, F.concat(group, F.lit("|*"))))


def judge(raw: DataFrame) -> DataFrame:
    """Add ``rejection_reason``: NULL for a good row, else the first failed test.

    A malformed record is rejected before anything is read from it. Every copy of a
    repeated id is rejected, not all but one. The rows land once, with what is wrong with each
    by itself, and stay where they are: only their ids are shuffled, and a bit a row says whose
    id is repeated.
    """
    faulty = F.col(MALFORMED).isNotNull() if MALFORMED in raw.columns else F.lit(False)
    qty = number(F.col("Line Item Quantity"))
    own = (F.when(F.col("ID").try_cast("bigint").isNull(), "unparseable ID")
           .when(parse_short_date(F.col("Scheduled Delivery Date")).isNull(),
                 "unparseable scheduled delivery date")
           .when(parse_short_date(F.col("Delivered to Client Date")).isNull(),
                 "unparseable actual delivery date")
           .when(qty.isNull() | (qty <= 0), "non-positive or non-numeric quantity"))
    rows = land(raw.withColumns({"_row": F.monotonically_increasing_id(), "_own": own}), "raw-rows")
    ids = rows.filter(~faulty).select("ID", "_row")
    copies = ids.groupBy("ID").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(F.col("ID").alias("_dup"))
    repeated = ids.join(copies, ids["ID"].eqNullSafe(copies["_dup"]), "left_semi")
    reason = F.when(faulty, "malformed record").when(F.col("_repeated"), "duplicate ID").otherwise(F.col("_own"))
    judged = (mark_rows(rows, "_row", repeated, "_repeated")
              .withColumn("rejection_reason", reason).drop("_row", "_own", "_repeated"))
    judged._landed_at = rows._landed_at
    return judged


def rejects(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("rejection_reason").isNotNull())


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("rejection_reason").isNull()).drop("rejection_reason", MALFORMED)


def reject_ledger(judged: DataFrame, as_of) -> DataFrame:
    """Rejected rows with their payload as JSON; the id hashes payload and reason.

    The payload of a malformed record is its text as it stands in the file.
    """
    columns = [c for c in judged.columns if c not in ("rejection_reason", MALFORMED)]
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
    if MALFORMED in judged.columns:
        payload = F.coalesce(F.col(MALFORMED), payload)
    return rejects(judged).select(
        F.sha2(F.concat_ws("|", payload, "rejection_reason"), 256).alias("reject_id"),
        F.col("ID").alias("source_record_id"), "rejection_reason",
        payload.alias("raw_payload"), F.lit(as_of).alias("rejected_on"))


@dataclass(frozen=True)
class Reference:
    """A numeric text column that may point at another row ("... (ID#:n)")."""

    column: str
    labels: dict[str, str]
    kind: str
    value: str
    source: str
    pattern: str = REFERENCE_PATTERN

    def direct(self) -> Column:
        return F.col(f"`{self.column}`").try_cast(self.kind)

    def pointer(self) -> Column:
        return F.nullif(F.regexp_extract(F.col(f"`{self.column}`"), self.pattern, 1), F.lit("")).try_cast("bigint")


def resolve_references(rows: DataFrame, *references: Reference) -> DataFrame:
    """Add each reference's ``value`` and ``source``, which says where the value came from.

    One hop, against rows that hold a number themselves. Pointers and what they may point
    at are looked up as narrow rows (id, column, number), all columns in one join; rows with a
    pointer meet the numbers found by one join on their id, all others stay where they are.
    """
    key, which = F.col("ID").try_cast("bigint"), range(len(references))

    cells = F.array(*[F.struct(F.lit(i).alias("_column"), references[i].pointer().alias("_target")) for i in which])
    pointers = rows.select(key.alias("_id"), F.explode(cells).alias("_c")).select("_id", "_c.*").filter(F.col("_target").isNotNull())
    numbers = [references[i].direct().cast("decimal(38,10)").alias(f"_number{i}") for i in which]
    targets = rows.select(key.alias("_target"), *numbers).dropna("all", subset=[f"_number{i}" for i in which])
    found = pointers.join(targets, "_target").groupBy("_id").agg(*[
        F.max(F.when(F.col("_column") == i, F.col(f"_number{i}"))).alias(f"_found{i}") for i in which])
    points = reduce(Column.__or__, [r.pointer().isNotNull() for r in references])
    hits = [f"_found{i}" for i in which]
    pointing = rows.filter(points).join(found, key == F.col("_id"), "left").select(*rows.columns, *hits)
    plain = rows.filter(~points).select("*", *[F.lit(None).cast(found.schema[h].dataType).alias(h) for h in hits])
    joined = plain.unionByName(pointing)
    added = {}
    for i, r in enumerate(references):
        text, pointer, direct, hit = F.col(f"`{r.column}`"), r.pointer(), r.direct(), F.col(f"_found{i}").cast(r.kind)
        added[r.value] = F.coalesce(F.when(pointer.isNotNull(), hit), direct)
        added[r.source] = (F.when(pointer.isNotNull() & hit.isNotNull(), "resolved_reference")
                           .when(pointer.isNotNull(), "missing_unresolved_reference")
                           .when(direct.isNotNull(), "direct")
                           .otherwise(F.coalesce(lookup(r.labels, text), F.lit(""))))
    return joined.withColumns(added).drop(*hits)


REFERENCES = [
    Reference("Weight (Kilograms)", WEIGHT_SENTINELS, "decimal(12,2)", "weight_kg", "weight_source"),
    Reference("Freight Cost (USD)", FREIGHT_SENTINELS, "decimal(12,2)", "freight_cost_usd", "freight_cost_source"),
]


def stage(good: DataFrame, shift_years: int) -> DataFrame:
    """The 35 staged columns of accepted raw rows.

    All but the references are read first, so that rows with a pointer move as what they hold
    and not as their texts.
    """
    found = {name for r in REFERENCES for name in (r.value, r.source)}
    mode, term = F.col("Shipment Mode"), F.col("Vendor INCO Term")
    months = 12 * shift_years

    def shifted(column: str) -> Column:
        return F.add_months(parse_short_date(F.col(column)), months)

    custom = {
        "incoterm": F.when(term != _NO_INCOTERM, term),
        "shipment_mode": lookup(SHIPMENT_MODE_MAP, mode),
        "missing_mode_flag": mode.isNull().cast("int"),
        "product_category": product_category(F.col("Product Group"),
                                             F.col("Sub Classification")),
        "first_line_designation": F.coalesce(
            (F.col("First Line Designation") == "Yes").cast("int"), F.lit(0)),
        "reporting_scheduled_delivery_date": shifted("Scheduled Delivery Date"),
        "reporting_actual_delivery_date": shifted("Delivered to Client Date"),
    }

    def read(t: Target) -> Column:
        if t.kind == "custom":
            return custom[t.name]
        text = F.col(f"`{t.source}`")
        if t.kind == "text":
            return text
        if t.kind == "date":
            return parse_date(text)
        if t.kind == "bigint":
            return number(text).try_cast("bigint")
        return text.try_cast(t.kind)

    own = [read(t).alias(t.name) for t in TARGETS if t.name not in found]
    rows = good.select("ID", *[F.col(f"`{r.column}`") for r in REFERENCES], *own)
    return resolve_references(rows, *REFERENCES).select(*[t.name for t in TARGETS])
