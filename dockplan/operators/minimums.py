"""Vendor planning minimums: type, amount, overrides, container rule, MOQ floor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockplan.config import (
    CONTAINER_MOQ,
    CONTAINER_MOQ_BELOW,
    DELIVERY_CONTAINER,
    DELIVERY_FULL_TRUCK,
    FULL_TRUCK_WEIGHT_MOQ,
    FULL_TRUCK_WEIGHT_MOQ_BELOW,
    MIN_UNDEFINED,
    PlanConfig,
)
from dockplan.functions.numeric import dbl, text
from dockplan.sources.tables import at_location, at_snapshot

# Priority order of the minimum columns: the first non-NULL one applies.
MINIMUM_COLUMNS = (
    ("case", "vendor_planning_minimum_case"),
    ("cube", "vendor_planning_minimum_cube"),
    ("dollar", "vendor_planning_minimum_dollar_amount"),
    ("pallet", "vendor_planning_minimum_pallet"),
    ("unit", "vendor_planning_minimum_units"),
    ("weight", "vendor_planning_minimum_weight"),
)


def min_type_sql() -> str:
    """Label of the first non-NULL minimum, else ``undefined`` (B1)."""
    whens = " ".join(f"WHEN {col} IS NOT NULL THEN {text(label)}" for label, col in MINIMUM_COLUMNS)
    return f"(CASE {whens} ELSE {text(MIN_UNDEFINED)} END)"


def min_amount_sql(override_amount: str | None, fallback: float) -> str:
    """First non-NULL minimum, then the vendor's override amount, then ``fallback`` (B2)."""
    cols = [c for _, c in MINIMUM_COLUMNS]
    if override_amount is not None:
        cols.append(override_amount)
    cols.append(dbl(fallback))
    return f"CAST(coalesce({', '.join(cols)}) AS DOUBLE)"


def container_type_sql(delivery: str, vtype: str) -> str:
    """Container vendors plan in cube, whatever unit their amount is in."""
    return f"(CASE WHEN {delivery} = {text(DELIVERY_CONTAINER)} THEN 'cube' ELSE {vtype} END)"


def moq_sql(delivery: str, vtype: str, amount: str) -> str:
    """Minimum order quantity with the container and full-truck floors."""
    return (
        f"CAST(CASE WHEN {delivery} = {text(DELIVERY_CONTAINER)} AND {amount} < {dbl(CONTAINER_MOQ_BELOW)}"
        f" THEN {dbl(CONTAINER_MOQ)}"
        f" WHEN {delivery} = {text(DELIVERY_FULL_TRUCK)} AND {vtype} = 'weight'"
        f" AND {amount} < {dbl(FULL_TRUCK_WEIGHT_MOQ_BELOW)} THEN {dbl(FULL_TRUCK_WEIGHT_MOQ)}"
        f" ELSE {amount} END AS DOUBLE)"
    )


def min_type() -> Column:
    return F.expr(min_type_sql())


def min_amount(override_amount: str | None, fallback: float) -> Column:
    return F.expr(min_amount_sql(override_amount, fallback))


def container_type(delivery: str, vtype: str) -> Column:
    return F.expr(container_type_sql(delivery, vtype))


def moq(delivery: str, vtype: str, amount: str) -> Column:
    return F.expr(moq_sql(delivery, vtype, amount))


def vendors_at(vendor_location: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Vendor-location rows of the as-of day, locations and status of ``cfg``."""
    v = at_snapshot(vendor_location, "snapshot_date", cfg.as_of)
    v = at_location(v, "location_code", cfg.locations)
    if cfg.vendor_status is not None:
        v = v.where(F.col("vendor_status") == F.lit(cfg.vendor_status))
    return v


def with_overrides(v: DataFrame, overrides: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Attach the per-vendor override row.

    A vendor on several lists keeps the row of the first one: smallest
    ``priority`` where the table has that column, then delivery type and
    amount, so a duplicate never multiplies demand.
    """
    rank = ["priority"] if "priority" in overrides.columns else []
    first = F.min(F.struct(*[F.coalesce(F.col(c).cast("long"), F.lit((1 << 63) - 1)).alias(c) for c in rank],
                           "delivery_type", "min_amount"))
    ov = overrides.groupBy("vendor_number").agg(first.alias("_ov")).select(
        "vendor_number",
        F.col("_ov.delivery_type").alias("_ov_delivery"),
        F.col("_ov.min_amount").alias("_ov_amount"),
    )
    return v.join(ov, "vendor_number", "left")


def vendor_minimums(vendor_location: DataFrame, cfg: PlanConfig, overrides: DataFrame | None = None) -> DataFrame:
    """Vendor x location with delivery type (overridden), minimum type and amount.

    Covers B1-B4: the container rule is applied to ``vendor_min_type`` and the
    raw label stays in ``raw_min_type``.
    """
    v = vendors_at(vendor_location, cfg)
    need_ov = overrides is not None and (cfg.use_min_override or cfg.use_delivery_override)
    if need_ov:
        v = with_overrides(v, overrides, cfg)
    delivery = "vendor_delivery_type"
    if need_ov and cfg.use_delivery_override:
        delivery = "coalesce(_ov_delivery, vendor_delivery_type)"
    ov_amount = "_ov_amount" if (need_ov and cfg.use_min_override) else None
    v = v.withColumns(
        {
            "raw_min_type": F.expr(min_type_sql()),
            "min_planning_amount": F.expr(min_amount_sql(ov_amount, cfg.min_fallback)),
            "vendor_delivery_type": F.expr(delivery),
        }
    )
    v = v.withColumn("vendor_min_type", F.expr(container_type_sql("vendor_delivery_type", "raw_min_type")))
    v = v.withColumn("moq", F.expr(moq_sql("vendor_delivery_type", "vendor_min_type", "min_planning_amount")))
    if need_ov:
        v = v.drop("_ov_delivery", "_ov_amount")
    return v
