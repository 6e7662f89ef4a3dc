"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver tables through the bindings, so its work grows
with them. Double columns go through ``stable_round`` so that results taken
in another summation order hash equal (SURVEY section 5).
"""

from __future__ import annotations

import datetime as dt
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockplan import config
from dockplan.functions.numeric import ieee_div_sql, stable_round_sql
from dockplan.functions.ordering import ordered_index
from dockplan.operators import cadence, demand, leveling, loads, receipts
from dockplan.operators import schedule as sched
from dockplan.operators.receipt_states import ReceiptStates, upt_from_states
from dockplan.plans import reports
from dockplan.sources import AS_OF, SITE, at_location, at_snapshot, bind, read_layout, write_layout
from dockplan.stages import Stages, kept, stage_dir

SNAP = config.snapshot_report(AS_OF, SITE)
HOR = config.horizon_report(AS_OF)
WP = config.weekly_plan(AS_OF)
EVERY_SITE = config.snapshot_report(AS_OF, None)
ALL_SITES_UPT = EVERY_SITE
ONE_SITE = WP.with_(locations=(SITE,))
DRILL_VENDORS = ("V3", "V17", "V42", "V58")
UPT_SINCE = dt.date(1999, 1, 1)


def finish(df: DataFrame) -> DataFrame:
    """Stable rounding of every double column; other columns unchanged."""
    cols = [
        f"{stable_round_sql(f'`{f.name}`')} AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
        for f in df.schema.fields
    ]
    return df.selectExpr(*cols)


class _LazyTables(dict):
    """``{name: DataFrame}`` that defines a logical table on first use only."""

    def __init__(self, binding):
        super().__init__()
        self._binding = binding

    def __missing__(self, name):
        df = self._binding.table(name)
        self[name] = df
        return df

    def get(self, name, default=None):
        try:
            return self[name]
        except AttributeError:
            return default


_BINDINGS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _t(spark: SparkSession, sf_dir: str) -> dict:
    """Logical tables of one driver folder, defined once per session and folder.

    Only the lazy plan definitions are shared between queries (as a program
    would call ``read_tables`` once); nothing is persisted, so every run scans
    and computes from the files again.
    """
    folders = _BINDINGS.setdefault(spark, {})
    key = sf_dir.rstrip("/")
    if key not in folders:
        folders[key] = _LazyTables(bind(spark, sf_dir))
    return folders[key]


# -- scans, projections, filters ---------------------------------------------

def q_scan_item_vendor(spark, d):
    return _t(spark, d)["item_location_vendor"]


def q_scan_snapshot(spark, d):
    return finish(at_snapshot(_t(spark, d)["forecast"], "snapshot_date", AS_OF))


def q_scan_location(spark, d):
    return at_location(_t(spark, d)["vendor_location"], "location_code", [SITE])


def q_project_item_vendor(spark, d):
    ilv = _t(spark, d)["item_location_vendor"]
    return ilv.select(
        "item",
        "location_code",
        "vendor_number",
        F.col("vendor_uom_qty").alias("case_qty"),
        (F.col("product_published_flag") & ~F.col("product_discontinued_flag")).alias("live_item"),
    )


def q_filter_eligible_items(spark, d):
    t = _t(spark, d)
    ilv, _ = demand.eligible_items(t["item_location_vendor"], t["inventory_snapshot"], EVERY_SITE)
    return ilv.select("item", "location_code", "vendor_number", "vendor_lead_time_business_days", "base_uom_qty")


def q_filter_in_list(spark, d):
    v = _t(spark, d)["vendor_location"]
    return v.where(F.col("vendor_shipment_method_code").isin(*SNAP.house_ship_methods)).select(
        "location_code", "vendor_number", "vendor_shipment_method_code"
    )


def q_receipt_filter(spark, d):
    return receipts.receipt_filter(_t(spark, d)["receipt_log"], EVERY_SITE)


# -- joins -----------------------------------------------------------------

def _j1(t):
    ilv, inv = demand.eligible_items(t["item_location_vendor"], t["inventory_snapshot"], EVERY_SITE)
    return inv.select("item", "location_code", "daily_forecast_qty").join(
        ilv.select("item", "location_code", "vendor_number", "base_uom_qty"), ["item", "location_code"], "inner"
    )


def q_join_inventory_item_vendor(spark, d):
    return finish(_j1(_t(spark, d)))


def q_join_item_master(spark, d):
    t = _t(spark, d)
    return finish(_j1(t).join(t["item_master"], "item", "inner"))


def q_receipt_join(spark, d):
    t = _t(spark, d)
    r = receipts.receipt_filter(t["receipt_log"], EVERY_SITE)
    docs = t["procurement_docs"].where(F.col("document_type") != "Transfer")
    j = r.join(docs, r.control_number == docs.document_number, "inner").join(t["vendors"], "vendor_key", "inner")
    return j.select("wh_id", "control_number", "item_number", "tran_qty", "vendor_number", "vendor_name")


def q_forecast_horizon(spark, d):
    return finish(demand.forecast_horizon(_t(spark, d)["forecast"], HOR))


def q_forecast_by_vendor(spark, d):
    t = _t(spark, d)
    return finish(demand.forecast_by_vendor(t["forecast"], t["item_location_vendor"], HOR))


def q_forecast_by_primary_vendor(spark, d):
    t = _t(spark, d)
    return finish(demand.forecast_by_primary_vendor(t["forecast"], t["item_location_vendor"], WP))


def q_join_demand_item_vendor(spark, d):
    t = _t(spark, d)
    return finish(demand.forecast_by_primary_vendor_uoms(t["forecast"], t["item_location_vendor"], WP))


def q_join_demand_vendor(spark, d):
    t = _t(spark, d)
    f = demand.forecast_by_vendor(t["forecast"], t["item_location_vendor"], HOR)
    v = reports.vendor_minimums(t, HOR).select(
        "vendor_number", F.col("location_code").alias("area"), "vendor_min_type", "moq"
    )
    out = f.join(v, ["vendor_number", "area"], "inner")
    return finish(out.select("item", "area", "vendor_number", "commercial_forecast", "vendor_min_type", "moq"))


def q_item_location_exists(spark, d):
    t = _t(spark, d)
    f = demand.forecast_horizon(t["forecast"], HOR).withColumnRenamed("area", "location_code")
    out = f.join(t["item_location"], ["item", "location_code"], "left_semi")
    return finish(out.select("item", "location_code", "commercial_forecast"))


def q_eq_pallets(spark, d):
    return finish(loads.eq_pallets(_t(spark, d)["product_dims"], HOR))


def q_delivery_type_override(spark, d):
    v = reports.vendor_minimums(_t(spark, d), WP)
    return finish(v.select("location_code", "vendor_number", "vendor_delivery_type", "vendor_min_type",
                           "min_planning_amount", "moq"))


# -- minimums ----------------------------------------------------------------

def q_planning_minimum(spark, d):
    v = reports.vendor_minimums(_t(spark, d), EVERY_SITE)
    return finish(v.select("location_code", "vendor_number", "raw_min_type", "min_planning_amount"))


def q_planning_minimum_fallback(spark, d):
    v = reports.vendor_minimums(_t(spark, d), HOR)
    return finish(v.select("location_code", "vendor_number", "raw_min_type", "min_planning_amount"))


def q_container_type(spark, d):
    v = reports.vendor_minimums(_t(spark, d), HOR)
    return v.select("location_code", "vendor_number", "vendor_delivery_type", "raw_min_type", "vendor_min_type")


def q_moq_floor(spark, d):
    v = reports.vendor_minimums(_t(spark, d), HOR)
    return finish(v.select("location_code", "vendor_number", "vendor_delivery_type", "vendor_min_type",
                           "min_planning_amount", "moq"))


# -- item measures -------------------------------------------------------------

def _items(spark, d, cfg):
    return reports.item_rows(_t(spark, d), cfg)


def q_weekly_qty_snapshot(spark, d):
    return finish(_items(spark, d, EVERY_SITE).select("item", "location_code", "vendor_number", "weekly_qty"))


def q_weekly_qty_horizon(spark, d):
    return finish(_items(spark, d, HOR).select("item", "location_code", "vendor_number", "weekly_qty"))


def q_weekly_uom(spark, d):
    return finish(_items(spark, d, WP).select("item", "location_code", "vendor_number", "vendor_min_type",
                                              "weekly_uom"))


def q_unit_attr_mask(spark, d):
    return finish(_items(spark, d, WP).select("item", "location_code", "vendor_number", "m_unit_cube",
                                              "m_unit_cost", "m_pallet_qty", "m_unit_weight", "m_vendor_uom_qty"))


def q_truckloads_by_type(spark, d):
    return finish(_items(spark, d, EVERY_SITE).select("item", "location_code", "vendor_number", "vendor_min_type",
                                                "truckloads"))


def q_weekly_weight(spark, d):
    return finish(_items(spark, d, HOR).select("item", "location_code", "vendor_number", "weekly_weight"))


def q_truckloads_weight_pallet(spark, d):
    return finish(_items(spark, d, HOR).select("item", "location_code", "vendor_number", "truckloads_wt",
                                               "truckloads_pl"))


def q_item_weekly(spark, d):
    return finish(_items(spark, d, WP).drop("base_forecast"))


# -- roll-up and cadence -------------------------------------------------------

def q_vendor_weekly(spark, d):
    return finish(reports.vendor_weekly(_t(spark, d), WP))


def q_order_cadence(spark, d):
    w = reports.vendor_weekly(_t(spark, d), WP)
    return w.select("location_code", "vendor_number", "num_orders_per_week")


def q_order_cadence_clamp(spark, d):
    w = reports.vendor_weekly(_t(spark, d), EVERY_SITE)
    w = w.withColumn("_ratio", F.expr(ieee_div_sql("avg_per_week_in_uom", "moq")))
    return w.select("location_code", "vendor_number", "vendor_lead_time_business_days",
                    cadence.cadence_clamp("_ratio").alias("orders_clamped"))


def q_per_order_measures(spark, d):
    w = reports.vendor_weekly(_t(spark, d), WP)
    m = cadence.per_order_measures(w)
    return finish(m.select("location_code", "vendor_number", "num_orders_per_week", "moqs_per_order",
                           "forecast_qty_per_order", "truckloads_per_order"))


# -- receipts ------------------------------------------------------------------

def q_receipt_upt_by_document(spark, d):
    t = _t(spark, d)
    return finish(receipts.receipt_upt_by_document(t["receipt_log"], t["procurement_docs"], t["vendors"],
                                                   ALL_SITES_UPT))


def q_vendor_upt(spark, d):
    t = _t(spark, d)
    return finish(receipts.vendor_upt(t["receipt_log"], t["procurement_docs"], t["vendors"], ALL_SITES_UPT))


def q_vendor_upt_since(spark, d):
    t = _t(spark, d)
    cfg = ALL_SITES_UPT.with_(upt_since=UPT_SINCE)
    return finish(receipts.vendor_upt(t["receipt_log"], t["procurement_docs"], t["vendors"], cfg))


# -- reports -------------------------------------------------------------------

def q_report_snapshot(spark, d):
    return finish(reports.report_snapshot(_t(spark, d), SNAP))


def q_report_with_upt(spark, d):
    return finish(reports.report_snapshot(_t(spark, d), EVERY_SITE.with_(finite_filter=False)))


def q_vendor_upt_from_days(spark, d):
    """UPT from day states: history up to a day folded first, then the days since, then one day again."""
    t = _t(spark, d)
    states = ReceiptStates(spark, f"{stage_dir(spark)}/receipts-{uuid.uuid4().hex}")
    states.fold(t["receipt_log"].where(F.col("tran_date") < F.lit(UPT_SINCE)))
    states.fold(t["receipt_log"])
    states.fold(t["receipt_log"], {UPT_SINCE})
    return finish(upt_from_states(states.read(), t["procurement_docs"], t["vendors"], ALL_SITES_UPT))


def q_report_self_join_classes(spark, d):
    """The self-join's different rows, with how often each stands in the report."""
    classes = finish(reports.report_self_join_classes(_t(spark, d), EVERY_SITE.with_(compat_self_join=True)))
    copies = F.sum(F.col("own_rows") * F.col("joined_rows")).alias("copies")
    return classes.groupBy(*reports.SNAPSHOT_COLUMNS).agg(copies)


def _from_layout(spark, d) -> dict:
    """The folder's tables, those that join on (item, location) read from a bucketed layout written for this run."""
    tables = _t(spark, d)
    root = f"{stage_dir(spark)}/layout-{uuid.uuid4().hex}"
    write_layout(tables, root, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = _LazyTables(bind(spark, d))
    out.update(read_layout(spark, root))
    return out


def q_stored_report_weekly_plan(spark, d):
    return finish(reports.report_weekly_plan(_from_layout(spark, d), WP))


def q_stored_report_snapshot(spark, d):
    return finish(reports.report_snapshot(_from_layout(spark, d), EVERY_SITE))


def q_report_self_join(spark, d):
    return finish(reports.report_snapshot(_t(spark, d), EVERY_SITE.with_(compat_self_join=True)))


def q_report_snapshot_all_sites(spark, d):
    return finish(reports.report_snapshot(_t(spark, d), EVERY_SITE))


def q_report_horizon(spark, d):
    return finish(reports.report_horizon(_t(spark, d), HOR))


def q_report_horizon_drilldown(spark, d):
    return finish(reports.report_horizon(_t(spark, d), HOR.with_(vendors=DRILL_VENDORS)))


def q_report_weekly_plan(spark, d):
    return finish(reports.report_weekly_plan(_t(spark, d), WP))


def q_filter_finite(spark, d):
    return finish(reports.finite_rows(reports.report_weekly_plan(_t(spark, d), WP)))


def q_report_sorted(spark, d):
    r = reports.report_weekly_plan(_t(spark, d), WP)
    return finish(r.orderBy("location_code", "vendor_number", "vendor_lead_time_business_days"))


# -- levelling -----------------------------------------------------------------

def _report_plan(spark, d):
    return leveling.plan_rows(reports.report_weekly_plan(_t(spark, d), WP))


def _fixture_sized(spark, d):
    t = _t(spark, d)
    return leveling.order_size(leveling.plan_dedupe(t["plan_rows"]), WP)


def _fixture_days(spark, d):
    return leveling.level_days(_fixture_sized(spark, d), WP)


def q_plan_input(spark, d):
    return _report_plan(spark, d)


def q_plan_dedupe(spark, d):
    return leveling.plan_dedupe(_report_plan(spark, d))


def q_order_size(spark, d):
    s = _fixture_sized(spark, d)
    return finish(s.select("location_code", "vendor_number", "weekly_units", "orders", "order_size", "order_units"))


def q_candidate_days(spark, d):
    c = leveling.candidate_days(_t(spark, d)["plan_rows"], WP)
    return c.select("location_code", "vendor_number", "day_index", "receive_date")


def q_level_days(spark, d):
    return _fixture_days(spark, d).select("location_code", "vendor_number", "orders", "day_index", "units")


def q_audit_schedule(spark, d):
    """The finished weekly schedule against its plan, both as stored."""
    return weekly_audit(_t(spark, d), WP)


def q_day_load(spark, d):
    return leveling.day_load(_fixture_days(spark, d))


def q_peak_load(spark, d):
    return leveling.peak_load(_fixture_days(spark, d))


def q_level_gap(spark, d):
    return leveling.level_gap(kept(_fixture_days(spark, d)), WP)


def q_infeasible_vendors(spark, d):
    sized = leveling.order_size(leveling.plan_dedupe(_report_plan(spark, d)), WP)
    return finish(leveling.infeasible_vendors(sized, WP))


def q_order_dates(spark, d):
    dated = leveling.with_dates(_fixture_days(spark, d), WP)
    return dated.select("location_code", "vendor_number", "day_index", "receive_date", "order_date")


def q_vendors_by_day(spark, d):
    dated = leveling.with_dates(_fixture_days(spark, d), WP)
    days = kept(dated.select("location_code", "receive_date", "vendor_number"))
    return ordered_index(days, order=["vendor_number"], group=["location_code", "receive_date"], name="position")


def _fixture_attrs(spark, d):
    t = _t(spark, d)
    v = reports.vendor_minimums(t, WP.with_(vendor_status=None)).select(
        "location_code",
        "vendor_number",
        leveling.trunc_long("moq").alias("moq"),
        F.col("vendor_min_type").alias("unit"),
        F.col("vendor_delivery_type").alias("delivery_type"),
        F.col("vendor_purchaser_code").alias("purchaser_code"),
        F.col("vendor_shipment_method_code").alias("ship_code"),
        F.col("vendor_distribution_method").alias("dist_code"),
    )
    return v


def q_schedule(spark, d):
    lv = _fixture_days(spark, d).join(_fixture_attrs(spark, d), ["location_code", "vendor_number"], "left")
    return sched.schedule(kept(leveling.with_dates(lv, WP)))


def weekly_sized(tables: dict, cfg: config.PlanConfig) -> DataFrame:
    """Plan rows of the weekly report with their order sizes."""
    plan = leveling.plan_dedupe(leveling.plan_rows(reports.report_weekly_plan(tables, cfg)))
    return leveling.order_size(plan, cfg)


def _stages(tables: dict, stages: Stages | None) -> Stages:
    return stages or Stages(tables["forecast"].sparkSession)


def weekly_schedule(tables: dict, cfg: config.PlanConfig, stages: Stages | None = None) -> DataFrame:
    """End-to-end weekly plan: report, plan rows, levelling, dates, schedule.

    The sized plan and the levelled days are stages: written once, and read by
    all that follows. So the fact tables are scanned once, a lost executor
    recomputes no report, and a run with named ``stages`` that is started again
    goes on behind its last finished one.
    """
    stages = _stages(tables, stages)
    sized = stages.keep("sized", lambda: weekly_sized(tables, cfg))
    dated = stages.keep("dated", lambda: leveling.with_dates(leveling.level_days(sized, cfg), cfg))
    return sched.schedule(dated)


def weekly_audit(tables: dict, cfg: config.PlanConfig, stages: Stages | None = None) -> DataFrame:
    """The audit of the weekly schedule (L4), over the stored schedule and the stored plan."""
    stages = _stages(tables, stages)
    finished = stages.keep("schedule", lambda: weekly_schedule(tables, cfg, stages))
    return leveling.audit_schedule(finished, stages.keep("sized", lambda: weekly_sized(tables, cfg)), cfg)


def q_weekly_schedule(spark, d):
    return weekly_schedule(_t(spark, d), WP)


def q_weekly_schedule_site(spark, d):
    """The plan of one site, the shape the report is run in."""
    return weekly_schedule(_t(spark, d), ONE_SITE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
