"""Weekly demand in the vendor's unit and truckload measures.

Arguments are column names or SQL snippets; each ``*_sql`` function returns
SQL text and the plain function parses it into a Column (one JVM call).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockplan.config import (
    CUBE_PER_TRUCK,
    MIN_TYPES,
    PALLET_HEIGHT,
    PALLET_LENGTH,
    PALLET_WIDTH,
    PALLETS_PER_TRUCK,
    WEIGHT_PER_TRUCK,
    WEIGHT_PER_TRUCK_HORIZON,
    PlanConfig,
)
from dockplan.functions.numeric import dbl, greatest_sql, ieee_div_sql, in_list, least_sql, text


def weekly_qty_snapshot_sql(daily_rate: str, vtype: str, days: int = 7) -> str:
    """Daily rate x 7 with a missing rate as 0; NULL for an undefined minimum."""
    return f"(CASE WHEN {vtype} IN {in_list(MIN_TYPES)} THEN {snapshot_qty_sql(daily_rate, days)} END)"


def snapshot_qty_sql(daily_rate: str, days: int = 7) -> str:
    return f"(coalesce({daily_rate}, 0.0D) * {dbl(days)})"


def weekly_qty_horizon_sql(horizon_sum: str, weeks: float) -> str:
    """Horizon forecast sum spread over ``weeks`` weeks."""
    return f"({horizon_sum} / {dbl(weeks)})"


def weekly_uom_sql(vtype: str, qty: str, unit_cube: str, unit_cost: str, pallet_qty: str, unit_weight: str,
                   case_qty: str) -> str:
    """Weekly demand expressed in the unit of the vendor's minimum."""
    return (
        f"(CASE WHEN {vtype} = 'cube' THEN {qty} * {unit_cube}"
        f" WHEN {vtype} = 'dollar' THEN {qty} * {unit_cost}"
        f" WHEN {vtype} = 'pallet' THEN {ieee_div_sql(qty, pallet_qty)}"
        f" WHEN {vtype} = 'unit' THEN {qty}"
        f" WHEN {vtype} = 'weight' THEN {qty} * {unit_weight}"
        f" WHEN {vtype} = 'case' THEN {ieee_div_sql(qty, case_qty)} END)"
    )


def masked_attr_sql(vtype: str, label: str, value: str) -> str:
    """The unit attribute that applies to the minimum type, else 0."""
    return f"CAST(CASE WHEN {vtype} = {text(label)} THEN {value} ELSE 0.0D END AS DOUBLE)"


def truckloads_by_type_sql(vtype: str, qty: str, unit_cube: str, pallet_qty: str, unit_weight: str,
                           cfg: PlanConfig) -> str:
    """Cube, pallet or weight truckloads by type; otherwise the least of the three."""
    cube = f"(({qty} * {unit_cube}) / {dbl(CUBE_PER_TRUCK)})"
    pallet = f"({ieee_div_sql(qty, pallet_qty)} / {dbl(PALLETS_PER_TRUCK)})"
    weight = f"(({qty} * {unit_weight}) / {dbl(WEIGHT_PER_TRUCK)})"
    return (
        f"(CASE WHEN {vtype} = 'cube' THEN {cube} WHEN {vtype} = 'pallet' THEN {pallet}"
        f" WHEN {vtype} = 'weight' THEN {weight}"
        f" ELSE {least_sql(cube, pallet, weight, nulls=cfg.null_extrema)} END)"
    )


def weekly_weight_sql(qty: str, unit_weight: str) -> str:
    """Weekly forecast weight."""
    return f"({qty} * {unit_weight})"


def truckloads_weight_sql(qty: str, unit_weight: str) -> str:
    """Truckloads by weight at the horizon report's truck weight."""
    return f"(({qty} * {unit_weight}) / {dbl(WEIGHT_PER_TRUCK_HORIZON)})"


def truckloads_pallet_sql(qty: str, eq_pallets: str) -> str:
    """Truckloads by equivalent pallets."""
    return f"(({qty} * {eq_pallets}) / {dbl(PALLETS_PER_TRUCK)})"


def weekly_qty_snapshot(daily_rate: str, vtype: str, days: int = 7) -> Column:
    return F.expr(weekly_qty_snapshot_sql(daily_rate, vtype, days))


def weekly_uom(vtype: str, qty: str, unit_cube: str, unit_cost: str, pallet_qty: str, unit_weight: str,
               case_qty: str) -> Column:
    return F.expr(weekly_uom_sql(vtype, qty, unit_cube, unit_cost, pallet_qty, unit_weight, case_qty))


def truckloads_by_type(vtype: str, qty: str, unit_cube: str, pallet_qty: str, unit_weight: str,
                       cfg: PlanConfig) -> Column:
    return F.expr(truckloads_by_type_sql(vtype, qty, unit_cube, pallet_qty, unit_weight, cfg))


def eq_pallets(product_dims: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Equivalent pallets per live, set-up product.

    ``is true`` / ``is false`` keep only known flags: NULL flags drop the row.
    """
    p = product_dims.where("setup_completed_flag <=> true AND discontinued_flag <=> false")
    pallets = greatest_sql(
        f"height / {dbl(PALLET_HEIGHT)}",
        f"length / {dbl(PALLET_LENGTH)}",
        f"width / {dbl(PALLET_WIDTH)}",
        nulls=cfg.null_extrema,
    )
    return p.selectExpr("item", "weight", "weight_uom", f"{pallets} AS eq_pallets")
