"""Item-level demand: forecast aggregates, item-vendor joins, item rows.

Join plan for scale: the forecast is summed per (item, area) first, so the
91 daily rows of a horizon collapse map-side before any shuffle; every later
join on the item side keys on (item, location), which lets Spark keep one
hash partitioning through the forecast, item-vendor and item-location joins.
Vendor and override dimensions are joined on (vendor, location) without a
hint; AQE broadcasts them while their measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockplan.config import PlanConfig
from dockplan.operators import loads
from dockplan.sources.tables import at_location, at_snapshot, in_horizon

VENDOR_ATTRS = (
    "vendor_name",
    "vendor_min_type",
    "vendor_delivery_type",
    "vendor_purchaser_code",
    "vendor_shipment_method_code",
    "vendor_distribution_method",
)


def forecast_window(forecast: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Forecast rows of the as-of snapshot, horizon and locations."""
    f = at_snapshot(forecast, "snapshot_date", cfg.as_of)
    f = in_horizon(f, "forecast_date", cfg.as_of, cfg.horizon_days)
    return at_location(f, "area", cfg.locations)


def forecast_horizon(forecast: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Horizon sums per (item, area): base and commercial in one pass (A1, A2)."""
    return (
        forecast_window(forecast, cfg)
        .groupBy("item", "area")
        .agg(F.sum("base_qty").alias("base_forecast"), F.sum("commercial_qty").alias("commercial_forecast"))
    )


def item_vendors_at(ilv: DataFrame, cfg: PlanConfig) -> DataFrame:
    return at_location(at_snapshot(ilv, "snapshot_date", cfg.as_of), "location_code", cfg.locations)


def forecast_by_vendor(forecast: DataFrame, ilv: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Horizon sums, then every item-vendor row of the item and area.

    No primary-vendor filter: each vendor of an item gets the full forecast.
    Written as the left join it is; the later inner join on the vendor makes it
    inner and Catalyst plans it so.
    """
    agg = forecast_horizon(forecast, cfg)
    v = item_vendors_at(ilv, cfg).select(
        F.col("item").alias("_ilv_item"), F.col("location_code").alias("_ilv_loc"), "vendor_number", "vendor_uom_qty"
    )
    j = agg.join(v, (agg.item == v._ilv_item) & (agg.area == v._ilv_loc), "left")
    return j.drop("_ilv_item", "_ilv_loc")


def forecast_by_primary_vendor(forecast: DataFrame, ilv: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Horizon sums per (item, area, primary vendor) (A1, A2 with the vendor key).

    The source joins primary item-vendor rows to daily forecast rows and sums;
    summing per (item, area) first and then adding the sum once per matching
    primary row gives the same totals, duplicates included, with the daily rows
    collapsed before the join.
    """
    agg = forecast_horizon(forecast, cfg)
    v = (
        item_vendors_at(ilv, cfg)
        .where("primary_vendor_flag <=> true AND vendor_number IS NOT NULL")
        .select(F.col("item"), F.col("location_code").alias("area"), "vendor_number")
    )
    return (
        agg.join(v, ["item", "area"], "inner")
        .groupBy("item", "area", "vendor_number")
        .agg(F.sum("base_forecast").alias("base_forecast"), F.sum("commercial_forecast").alias("commercial_forecast"))
    )


def forecast_by_primary_vendor_uoms(forecast: DataFrame, ilv: DataFrame, cfg: PlanConfig) -> DataFrame:
    """``forecast_by_primary_vendor`` joined to the item-vendor rows of its key (J5), in one join.

    The source joins the item-vendor table a second time on (item, location,
    vendor), primary or not, and de-duplicates the item rows afterwards, so
    what that join contributes is the set of distinct unit quantities of the
    key. Here one join on (item, area) brings every item-vendor row; an
    aggregate per (item, area, vendor, unit qty) and a window per (item, area,
    vendor) then give the primary sums and the distinct quantities. Both keep
    the (item, area) hash partitioning of the join, so no further shuffle of
    the item-vendor table or the forecast is needed.
    """
    agg = forecast_horizon(forecast, cfg)
    v = (
        item_vendors_at(ilv, cfg)
        .where("vendor_number IS NOT NULL")
        .selectExpr(
            "item", "location_code AS area", "vendor_number", "primary_vendor_flag <=> true AS _primary",
            "vendor_uom_qty",
        )
    )
    j = agg.join(v, ["item", "area"], "inner")
    per_qty = j.groupBy("item", "area", "vendor_number", "vendor_uom_qty").agg(
        F.expr("sum(CASE WHEN _primary THEN base_forecast END)").alias("_base"),
        F.expr("sum(CASE WHEN _primary THEN commercial_forecast END)").alias("_commercial"),
        F.expr("count_if(_primary)").alias("_primary_rows"),
    )
    w = Window.partitionBy("item", "area", "vendor_number")
    out = per_qty.withColumns(
        {
            "_key_primary_rows": F.sum("_primary_rows").over(w),
            "base_forecast": F.sum("_base").over(w),
            "commercial_forecast": F.sum("_commercial").over(w),
        }
    )
    return out.where("_key_primary_rows > 0").select(
        "item", "area", "vendor_number", "base_forecast", "commercial_forecast", "vendor_uom_qty"
    )


def eligible_items(ilv: DataFrame, inv: DataFrame, cfg: PlanConfig) -> tuple[DataFrame, DataFrame]:
    """The six item predicates of the snapshot report, on each input.

    With ``cfg.eligible_item_filters`` off only the snapshot and location
    predicates apply.
    """
    i = item_vendors_at(ilv, cfg)
    s = at_location(at_snapshot(inv, "snapshot_date", cfg.as_of), "location_code", cfg.locations)
    if cfg.eligible_item_filters:
        i = i.where(
            "product_discontinued_flag <=> false AND product_published_flag <=> true"
            " AND primary_vendor_flag <=> true AND purchase_source_location IS NULL"
        )
        s = s.where("managed_flag <=> true AND location_discontinued_flag <=> false")
    return i, s


def _vendor_side(vmin: DataFrame, cfg: PlanConfig) -> DataFrame:
    cols = ["vendor_number", "location_code", *VENDOR_ATTRS, "moq"]
    if cfg.lead_time_from == "vendor_location":
        cols.append("vendor_lead_time_business_days")
    return vmin.select(*cols)


def snapshot_item_rows(tables: dict, vmin: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Item rows of the snapshot report: J1, J2, J3, B6, B7, B9."""
    ilv, inv = eligible_items(tables["item_location_vendor"], tables["inventory_snapshot"], cfg)
    ilv = ilv.select(
        "item", "location_code", "vendor_number", "vendor_lead_time_business_days",
        F.col(cfg.case_divisor).alias("case_qty"),
    )
    inv = inv.select("item", "location_code", "daily_forecast_qty")
    m = tables["item_master"]
    j = (
        inv.join(ilv, ["item", "location_code"], "inner")
        .join(m, "item", "inner")
        .join(_vendor_side(vmin, cfg), ["vendor_number", "location_code"], "inner")
    )
    vt = "vendor_min_type"
    qty_any = loads.snapshot_qty_sql("daily_forecast_qty", cfg.days_per_week)
    uom = loads.weekly_uom_sql(vt, qty_any, "unit_cube", "unit_cost", "pallet_qty", "unit_weight", "case_qty")
    trucks = loads.truckloads_by_type_sql(vt, qty_any, "unit_cube", "pallet_qty", "unit_weight", cfg)
    return j.selectExpr(
        "item", "vendor_number", "location_code", *VENDOR_ATTRS, "moq", "vendor_lead_time_business_days",
        f"{uom} AS weekly_uom",
        f"{loads.weekly_qty_snapshot_sql('daily_forecast_qty', vt, cfg.days_per_week)} AS weekly_qty",
        f"{trucks} AS truckloads",
    )


def horizon_item_rows(tables: dict, vmin: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Item rows of the forecast reports: J4, J5, J8, J2, J9, B6-B13, A8."""
    ilv = tables["item_location_vendor"]
    if cfg.forecast_vendor_join == "after_sum":
        # Every item-vendor row of the 4-key already carries its own unit
        # quantity, and the DISTINCT below makes a second join on the same
        # key add nothing, so the column is carried from the first join.
        f = forecast_by_vendor(tables["forecast"], ilv, cfg)
    else:
        f = forecast_by_primary_vendor_uoms(tables["forecast"], ilv, cfg)
    if cfg.vendors is not None:
        f = f.where(F.col("vendor_number").isin(list(cfg.vendors)))
    f = f.withColumnRenamed("area", "location_code")
    if cfg.item_location_exists:
        f = f.join(tables["item_location"], ["item", "location_code"], "left_semi")
    f = f.join(tables["item_master"], "item", "inner")
    if cfg.product_dims:
        f = f.join(loads.eq_pallets(tables["product_dims"], cfg), "item", "inner")
    j = f.join(_vendor_side(vmin, cfg), ["vendor_number", "location_code"], "inner")

    vt = "vendor_min_type"
    qty = loads.weekly_qty_horizon_sql("commercial_forecast", cfg.weeks_in_horizon)
    uom = loads.weekly_uom_sql(vt, qty, "unit_cube", "unit_cost", "pallet_qty", "unit_weight", "vendor_uom_qty")
    cols = [
        "item", "location_code", "vendor_number", *VENDOR_ATTRS, "vendor_lead_time_business_days", "moq",
        f"{loads.masked_attr_sql(vt, 'cube', 'unit_cube')} AS m_unit_cube",
        f"{loads.masked_attr_sql(vt, 'dollar', 'unit_cost')} AS m_unit_cost",
        f"{loads.masked_attr_sql(vt, 'pallet', 'pallet_qty')} AS m_pallet_qty",
        f"{loads.masked_attr_sql(vt, 'weight', 'unit_weight')} AS m_unit_weight",
        f"{loads.masked_attr_sql(vt, 'case', 'vendor_uom_qty')} AS m_vendor_uom_qty",
        "commercial_forecast",
        f"{qty} AS weekly_qty",
        f"{uom} AS weekly_uom",
    ]
    if cfg.truckloads == "weight_pallet":
        cols += [
            "weight", "weight_uom",
            f"{loads.weekly_weight_sql(qty, 'unit_weight')} AS weekly_weight",
            f"{loads.truckloads_weight_sql(qty, 'unit_weight')} AS truckloads_wt",
            f"{loads.truckloads_pallet_sql(qty, 'eq_pallets')} AS truckloads_pl",
        ]
    else:
        cols += [
            "base_forecast",
            f"{loads.truckloads_by_type_sql(vt, qty, 'unit_cube', 'pallet_qty', 'unit_weight', cfg)} AS truckloads",
        ]
    rows = j.selectExpr(*cols)
    return rows.distinct() if cfg.distinct_items else rows
