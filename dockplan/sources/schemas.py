"""Explicit schemas of the logical input tables (names bind by name, never by position)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VENDOR_LOCATION = _schema(
    ("snapshot_date", DT),
    ("location_code", S),
    ("vendor_number", S),
    ("vendor_name", S),
    ("vendor_delivery_type", S),
    ("vendor_purchaser_code", S),
    ("vendor_shipment_method_code", S),
    ("vendor_distribution_method", S),
    ("vendor_status", S),
    ("vendor_lead_time_business_days", I),
    ("vendor_planning_minimum_case", D),
    ("vendor_planning_minimum_cube", D),
    ("vendor_planning_minimum_dollar_amount", D),
    ("vendor_planning_minimum_pallet", D),
    ("vendor_planning_minimum_units", D),
    ("vendor_planning_minimum_weight", D),
)

ITEM_LOCATION_VENDOR = _schema(
    ("snapshot_date", DT),
    ("item", L),
    ("location_code", S),
    ("vendor_number", S),
    ("vendor_lead_time_business_days", I),
    ("vendor_uom_qty", D),
    ("base_uom_qty", D),
    ("primary_vendor_flag", B),
    ("product_discontinued_flag", B),
    ("product_published_flag", B),
    ("purchase_source_location", S),
)

ITEM_MASTER = _schema(("item", L), ("unit_cube", D), ("unit_cost", D), ("pallet_qty", D), ("unit_weight", D))

ITEM_LOCATION = _schema(("item", L), ("location_code", S))

INVENTORY_SNAPSHOT = _schema(
    ("snapshot_date", DT),
    ("item", L),
    ("location_code", S),
    ("daily_forecast_qty", D),
    ("managed_flag", B),
    ("location_discontinued_flag", B),
)

FORECAST = _schema(
    ("snapshot_date", DT),
    ("item", L),
    ("area", S),
    ("forecast_date", DT),
    ("base_qty", D),
    ("commercial_qty", D),
)

PRODUCT_DIMS = _schema(
    ("item", L),
    ("height", D),
    ("length", D),
    ("width", D),
    ("weight", D),
    ("unit_of_measure", S),
    ("weight_uom", S),
    ("setup_completed_flag", B),
    ("discontinued_flag", B),
)

RECEIPT_LOG = _schema(
    ("wh_id", S), ("control_number", S), ("item_number", S), ("tran_type", I), ("tran_qty", D), ("tran_date", DT)
)

PROCUREMENT_DOCS = _schema(("document_number", S), ("vendor_key", L), ("document_type", S))

VENDORS = _schema(("vendor_key", L), ("vendor_number", S), ("vendor_name", S))

VENDOR_OVERRIDE = _schema(("vendor_number", S), ("delivery_type", S), ("min_amount", D))

PLAN_ROWS = _schema(
    ("location_code", S),
    ("vendor_number", S),
    ("vendor_name", S),
    ("vendor_lead_time_business_days", I),
    ("weekly_units", L),
    ("orders", I),
)

SCHEMAS: dict[str, T.StructType] = {
    "vendor_location": VENDOR_LOCATION,
    "item_location_vendor": ITEM_LOCATION_VENDOR,
    "item_master": ITEM_MASTER,
    "item_location": ITEM_LOCATION,
    "inventory_snapshot": INVENTORY_SNAPSHOT,
    "forecast": FORECAST,
    "product_dims": PRODUCT_DIMS,
    "receipt_log": RECEIPT_LOG,
    "procurement_docs": PROCUREMENT_DOCS,
    "vendors": VENDORS,
    "vendor_override": VENDOR_OVERRIDE,
}
