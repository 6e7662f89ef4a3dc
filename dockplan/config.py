"""One configuration object for every report variant.

The three reports differ in about fifteen settings (demand source, item
filters, overrides, truckload measure, cadence rules, per-order measures).
Each setting is a field here, so one set of DataFrame functions serves all
three; the presets at the bottom give the three known shapes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Category labels and planning constants the reports compare
# against. They must stay exactly as written for results to agree.
DELIVERY_CONTAINER = "Shipping Container"
DELIVERY_FULL_TRUCK = "FTL (Full Truck Load)"
DELIVERY_LESS_TRUCK = "LTL (Less Truck Load)"
DELIVERY_SMALL_PARCEL = "Small Parcel"

MIN_TYPES = ("case", "cube", "dollar", "pallet", "unit", "weight")
MIN_UNDEFINED = "undefined"

CUBE_PER_TRUCK = 4150000.0
PALLETS_PER_TRUCK = 26.0
WEIGHT_PER_TRUCK = 42000.0
WEIGHT_PER_TRUCK_HORIZON = 43000.0
CONTAINER_MOQ_BELOW = 4.0e6
CONTAINER_MOQ = 4.15e6
FULL_TRUCK_WEIGHT_MOQ_BELOW = 38000.0
FULL_TRUCK_WEIGHT_MOQ = 42000.0
PALLET_HEIGHT = 40.0
PALLET_LENGTH = 59.0
PALLET_WIDTH = 48.0
MAX_ORDERS_PER_WEEK = 5
RECEIVING_DAYS = 5
MAX_UNITS_PER_DAY = 1500000
RECEIPT_TRAN_TYPE = 151
TRANSFER_DOCUMENT = "Transfer"
UNKNOWN_MINIMUM = 123456789.0


@dataclass(frozen=True)
class PlanConfig:
    """Settings of one report run. Never reads the clock: ``as_of`` is given."""

    as_of: dt.date
    # None means every location.
    locations: tuple[str, ...] | None = None
    # Vendor status kept; None keeps every status.
    vendor_status: str | None = "Enabled"

    # Demand: "snapshot" (daily leading rate x 7) or "horizon" (forecast sum).
    demand: str = "horizon"
    horizon_days: int = 91
    weeks_in_horizon: float = 12.0
    days_per_week: int = 7
    # "after_sum": aggregate the forecast, then attach every item-vendor row.
    # "primary_before_sum": primary item-vendor rows only, summed per vendor.
    forecast_vendor_join: str = "primary_before_sum"

    # Item filters of the snapshot report (six predicates).
    eligible_item_filters: bool = False
    # Product dimension filter and pallet equivalents (horizon report).
    product_dims: bool = False
    # Existence of the item at the location.
    item_location_exists: bool = True
    # De-duplicate whole item rows before the vendor roll-up.
    distinct_items: bool = True

    # Which item-vendor column divides for case minimums.
    case_divisor: str = "vendor_uom_qty"  # or "base_uom_qty"
    # Lead time from "vendor_location" or "item_vendor".
    lead_time_from: str = "vendor_location"

    # Missing planning minimum: per-vendor override amount first, then this.
    use_min_override: bool = True
    min_fallback: float = UNKNOWN_MINIMUM
    # Delivery type from the override table (first match) else the source.
    use_delivery_override: bool = False

    # "by_type" (cube / pallet / weight, else the least) or "weight_pallet".
    truckloads: str = "by_type"
    # NULL inside least/greatest: "propagate" (unknown) or "skip".
    null_extrema: str = "propagate"

    house_ship_methods: tuple[str, ...] = ("HOUSE", "HOUSE.COM")
    single_order_delivery_types: tuple[str, ...] = (DELIVERY_LESS_TRUCK, DELIVERY_SMALL_PARCEL)

    with_upt: bool = False
    upt_join_on_location: bool = False
    upt_since: dt.date | None = None
    finite_filter: bool = False
    # Reproduce the vendor-only self-join of the snapshot report (k^2 rows).
    compat_self_join: bool = False
    # Optional vendor drill-down, applied before the roll-up.
    vendors: tuple[str, ...] | None = None

    # Levelling.
    week_start: dt.date = dt.date(2019, 8, 12)
    receiving_days: int = RECEIVING_DAYS
    max_units_per_day: int = MAX_UNITS_PER_DAY
    # No schedule for a location when any of its vendors is infeasible (as the
    # source gives no schedule when its model is infeasible).
    all_or_nothing: bool = False

    def __post_init__(self):
        choices = {
            "demand": ("snapshot", "horizon"),
            "forecast_vendor_join": ("after_sum", "primary_before_sum"),
            "case_divisor": ("vendor_uom_qty", "base_uom_qty"),
            "lead_time_from": ("vendor_location", "item_vendor"),
            "truckloads": ("by_type", "weight_pallet"),
            "null_extrema": ("propagate", "skip"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"PlanConfig.{name} must be one of {allowed}, got {getattr(self, name)!r}")
        if self.with_upt and not self.upt_join_on_location and (self.locations is None or len(self.locations) != 1):
            raise ValueError("with_upt over several locations needs upt_join_on_location: a vendor has a rate per site")
        if self.receiving_days < 1 or self.horizon_days < 1 or self.weeks_in_horizon <= 0:
            raise ValueError("receiving_days, horizon_days and weeks_in_horizon must be positive")

    def with_(self, **kw) -> "PlanConfig":
        return replace(self, **kw)


def snapshot_report(as_of: dt.date, location: str | None) -> PlanConfig:
    """Inventory-snapshot report with receipt UPT and the finite filter."""
    return PlanConfig(
        as_of=as_of,
        locations=None if location is None else (location,),
        upt_join_on_location=location is None,
        vendor_status=None,
        demand="snapshot",
        eligible_item_filters=True,
        item_location_exists=False,
        distinct_items=False,
        case_divisor="base_uom_qty",
        lead_time_from="item_vendor",
        use_min_override=False,
        min_fallback=1.0,
        truckloads="by_type",
        single_order_delivery_types=(),
        with_upt=True,
        finite_filter=True,
    )


def horizon_report(as_of: dt.date, vendors: tuple[str, ...] | None = None) -> PlanConfig:
    """Forward-forecast report over all locations, weight and pallet loads."""
    return PlanConfig(
        as_of=as_of,
        locations=None,
        vendor_status="Enabled",
        demand="horizon",
        weeks_in_horizon=12.86,
        forecast_vendor_join="after_sum",
        product_dims=True,
        truckloads="weight_pallet",
        vendors=vendors,
    )


def weekly_plan(as_of: dt.date, location: str | None = None) -> PlanConfig:
    """Forecast report with overrides and per-order measures; feeds levelling."""
    return PlanConfig(
        as_of=as_of,
        locations=None if location is None else (location,),
        upt_join_on_location=location is None,
        vendor_status="Enabled",
        demand="horizon",
        weeks_in_horizon=12.0,
        forecast_vendor_join="primary_before_sum",
        use_delivery_override=True,
        truckloads="by_type",
    )
