"""Receipt units per transaction.

Receipts are pre-aggregated per (warehouse, document) before they meet the
document table, so a document holding a third of all receipt lines is one
partial-aggregated row by the time it is shuffled. The document match is by
number only: a document listed k times for a vendor multiplies the units by
k but not the distinct item count, exactly as the row-level join would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.config import RECEIPT_TRAN_TYPE, TRANSFER_DOCUMENT, PlanConfig
from dockplan.functions.numeric import ieee_div_sql
from dockplan.sources.tables import at_location


def countable_receipts(receipts: DataFrame) -> DataFrame:
    """Receipts of one transaction type with a non-zero quantity."""
    return receipts.where((F.col("tran_type") == F.lit(RECEIPT_TRAN_TYPE)) & (F.col("tran_qty") != F.lit(0.0)))


def received_since(receipts: DataFrame, cfg: PlanConfig) -> DataFrame:
    return receipts if cfg.upt_since is None else receipts.where(F.col("tran_date") >= F.lit(cfg.upt_since))


def receipt_filter(receipts: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Receipts of the sites, one transaction type, non-zero quantity.

    The source reads all history (its date filter is commented out); with
    ``cfg.upt_since`` set, only receipts on or after that date count (D12).
    """
    return received_since(countable_receipts(at_location(receipts, "wh_id", cfg.locations)), cfg)


def document_vendors(docs: DataFrame, vendors: DataFrame) -> DataFrame:
    """(document, vendor) links of non-transfer documents with their multiplicity."""
    d = docs.where(F.col("document_type") != F.lit(TRANSFER_DOCUMENT))
    return (
        d.join(vendors, "vendor_key", "inner")
        .groupBy("document_number", "vendor_number", "vendor_name")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def document_upt(receipts: DataFrame, docs: DataFrame, vendors: DataFrame) -> DataFrame:
    """Units, distinct items and units per transaction per vendor document, of receipts or of their day states."""
    per_doc = receipts.groupBy("wh_id", "control_number").agg(
        F.count_distinct("item_number").alias("num_unique_skus"), F.sum("tran_qty").alias("_units"))
    links = document_vendors(docs, vendors)
    j = per_doc.join(links, per_doc.control_number == links.document_number, "inner")
    units = "(_units * CAST(links AS DOUBLE))"
    return j.selectExpr(
        "vendor_number",
        "vendor_name",
        "wh_id",
        "control_number",
        "CAST(num_unique_skus AS BIGINT) AS num_unique_skus",
        f"{units} AS num_units",
        f"{ieee_div_sql(units, 'num_unique_skus')} AS upt",
    )


def mean_upt(by_document: DataFrame) -> DataFrame:
    """Mean document UPT per vendor and warehouse, unweighted by volume."""
    return by_document.groupBy("vendor_number", "vendor_name", "wh_id").agg(F.avg("upt").alias("avg_upt"))


def receipt_upt_by_document(receipts: DataFrame, docs: DataFrame, vendors: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Units, distinct items and units per transaction per vendor document (A4, A5)."""
    return document_upt(receipt_filter(receipts, cfg), docs, vendors)


def vendor_upt(receipts: DataFrame, docs: DataFrame, vendors: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Mean document UPT per vendor and warehouse, unweighted by volume."""
    return mean_upt(receipt_upt_by_document(receipts, docs, vendors, cfg))
