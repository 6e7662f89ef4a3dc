"""The three vendor ordering reports as compositions of the operators.

``tables`` is a ``{name: DataFrame}`` of the logical inputs (see
``dockplan.sources``). Each report is lazy: nothing runs until an action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.config import PlanConfig
from dockplan.functions.numeric import is_finite_value, not_pos_infinity
from dockplan.operators import cadence, demand, minimums, receipts

SNAPSHOT_COLUMNS = (
    *cadence.GROUP_KEYS,
    "num_orders_per_week",
    "avg_upt",
    "moqs_per_order",
    "forecast_qty_per_order",
    "truckloads_per_order",
)

HORIZON_COLUMNS = (
    *cadence.GROUP_KEYS,
    "avg_per_week_in_qty",
    "avg_per_week_in_uom",
    "avg_fcst_wt",
    "truckloads_wt_per_week",
    "truckloads_pl_per_week",
    "num_orders_per_week",
)

WEEKLY_PLAN_COLUMNS = (
    *cadence.GROUP_KEYS,
    "num_orders_per_week",
    "avg_per_week_in_qty",
    "moqs_per_order",
    "forecast_qty_per_order",
    "truckloads_per_order",
)


def vendor_minimums(tables: dict, cfg: PlanConfig) -> DataFrame:
    return minimums.vendor_minimums(tables["vendor_location"], cfg, tables.get("vendor_override"))


def item_rows(tables: dict, cfg: PlanConfig) -> DataFrame:
    vmin = vendor_minimums(tables, cfg)
    if cfg.demand == "snapshot":
        return demand.snapshot_item_rows(tables, vmin, cfg)
    return demand.horizon_item_rows(tables, vmin, cfg)


def vendor_weekly(tables: dict, cfg: PlanConfig) -> DataFrame:
    return cadence.vendor_weekly(item_rows(tables, cfg), cfg)


def finite_rows(df: DataFrame) -> DataFrame:
    """Keep rows whose truckloads per order is a number and MOQs per order is not +Infinity."""
    return df.where(is_finite_value("truckloads_per_order") & not_pos_infinity("moqs_per_order"))


def _with_upt(base: DataFrame, tables: dict, cfg: PlanConfig) -> DataFrame:
    if not cfg.with_upt:
        return base.withColumn("avg_upt", F.lit(None).cast("double"))
    upt = receipts.vendor_upt(tables["receipt_log"], tables["procurement_docs"], tables["vendors"], cfg)
    if cfg.upt_join_on_location:
        upt = upt.select("vendor_number", F.col("wh_id").alias("location_code"), "avg_upt")
        return base.join(upt, ["vendor_number", "location_code"], "left")
    # The source matches UPT on the vendor only (J11); one site per run keeps it 1:1.
    return base.join(upt.select("vendor_number", "avg_upt"), "vendor_number", "left")


#: What a row takes from the rows of its vendor in the source's self-join.
JOINED_MEASURES = ("moq", "vendor_delivery_type", "avg_per_week_in_uom", "avg_per_week_in_qty", "truckloads_per_week")


def report_self_join_classes(tables: dict, cfg: PlanConfig) -> DataFrame:
    """The source's vendor-only self-join (J12) as classes: one row for each pair of different rows, with its multiplicities.

    A vendor's k rows give k^2 in the source. Measures take the joined row's
    sums and MOQ, the own row's orders. Both sides are grouped first, the own
    side by all of its columns and the joined side by its measures, so equal
    rows are one: the join's rows grow with different rows, and ``own_rows`` x
    ``joined_rows`` source rows stand behind each.
    """
    base = vendor_weekly(tables, cfg)
    weekly = _with_upt(base, tables, cfg)
    own = weekly.groupBy(*weekly.columns).agg(F.count(F.lit(1)).alias("own_rows"))
    joined = base.groupBy("vendor_number", *[F.col(c).alias(f"_d_{c}") for c in JOINED_MEASURES]).agg(F.count(F.lit(1)).alias("joined_rows"))
    measured = cadence.per_order_measures(
        own.join(joined, "vendor_number", "inner"),
        uom="_d_avg_per_week_in_uom",
        qty="_d_avg_per_week_in_qty",
        moq_col="_d_moq",
        delivery="_d_vendor_delivery_type",
        trucks="_d_truckloads_per_week",
    )
    out = measured.select(*SNAPSHOT_COLUMNS, "own_rows", "joined_rows")
    return finite_rows(out) if cfg.finite_filter else out


def expanded(classes: DataFrame) -> DataFrame:
    """The rows behind the classes, each as often as the source has it."""
    once = classes.withColumn("_own", F.explode(F.array_repeat(F.lit(0), F.col("own_rows").cast("int"))))
    twice = once.withColumn("_joined", F.explode(F.array_repeat(F.lit(0), F.col("joined_rows").cast("int"))))
    return twice.drop("own_rows", "joined_rows", "_own", "_joined")


def report_snapshot(tables: dict, cfg: PlanConfig) -> DataFrame:
    """Snapshot report: weekly demand from the daily rate, UPT, per-order measures."""
    if cfg.compat_self_join:
        return expanded(report_self_join_classes(tables, cfg))
    out = cadence.per_order_measures(_with_upt(vendor_weekly(tables, cfg), tables, cfg)).select(*SNAPSHOT_COLUMNS)
    return finite_rows(out) if cfg.finite_filter else out


def report_horizon(tables: dict, cfg: PlanConfig) -> DataFrame:
    """Forward-forecast report over all locations with weight/pallet truckloads."""
    weekly = vendor_weekly(tables, cfg)
    return weekly.select(*HORIZON_COLUMNS)


def report_weekly_plan(tables: dict, cfg: PlanConfig) -> DataFrame:
    """Forecast report with overrides and per-order measures; feeds levelling."""
    weekly = vendor_weekly(tables, cfg)
    out = cadence.per_order_measures(weekly).select(*WEEKLY_PLAN_COLUMNS)
    return finite_rows(out) if cfg.finite_filter else out
