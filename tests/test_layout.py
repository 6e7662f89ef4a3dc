"""Bucketed tables: equal results, and no exchange where (item, location) meets."""

import pytest

from dockplan.operators import demand
from dockplan.plans import catalog, reports
from dockplan.plans.catalog import EVERY_SITE, SNAP, WP
from dockplan.sources import layout, read_layout, write_layout

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layout"))
    write_layout(catalog._t(spark, SF), root, 8)
    return root, read_layout(spark, root)


@pytest.fixture()
def sort_merge(spark):
    """No broadcast: the plans of tables too large for one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.enabled", True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stored_rows_are_the_rows(spark, stored):
    for name, df in stored[1].items():
        assert rows_of(df.select(*sorted(df.columns))) == rows_of(catalog._t(spark, SF)[name].select(*sorted(df.columns)))


def test_inventory_meets_item_vendors_without_an_exchange(stored, sort_merge):
    ilv, inv = demand.eligible_items(stored[1]["item_location_vendor"], stored[1]["inventory_snapshot"], EVERY_SITE)
    j = inv.join(ilv, ["item", "location_code"])
    assert "SortMergeJoin" in plan(j) and "Exchange" not in plan(j)
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan(j)


def test_forecast_meets_item_vendors_without_an_exchange(spark, stored, sort_merge):
    f = demand.forecast_by_primary_vendor_uoms(stored[1]["forecast"], stored[1]["item_location_vendor"], WP)
    assert "SortMergeJoin" in plan(f) and "Exchange" not in plan(f)
    exists = f.withColumnRenamed("area", "location_code").join(stored[1]["item_location"], ["item", "location_code"], "left_semi")
    assert "Exchange" not in plan(exists)
    t = catalog._t(spark, SF)
    want = demand.forecast_by_primary_vendor_uoms(t["forecast"], t["item_location_vendor"], WP)
    assert rows_of(catalog.finish(f)) == rows_of(catalog.finish(want))


def test_reports_are_the_same(spark, stored):
    t = catalog._t(spark, SF)
    mixed = {**{n: t[n] for n in ("vendor_location", "item_master", "product_dims", "receipt_log", "procurement_docs", "vendors", "vendor_override")},
             **stored[1]}
    for report, cfg in ((reports.report_weekly_plan, WP), (reports.report_snapshot, SNAP)):
        assert rows_of(catalog.finish(report(mixed, cfg))) == rows_of(catalog.finish(report(t, cfg)))


def test_another_session_finds_the_layout(spark, stored):
    """Without the catalog's entries the tables are registered again, with bucketing and partitions."""
    root, tables = stored
    want = tables["forecast"].count()
    for name in layout.KEYS:
        for t in spark.catalog.listTables():
            if t.name.startswith("layout_") and t.name.endswith(name):
                spark.sql(f"DROP TABLE {t.name}")
    again = read_layout(spark, root)
    assert again["forecast"].count() == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Exchange" not in again["forecast"].groupBy("item", "area").count()._jdf.queryExecution().sparkPlan().toString()
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {[t.name for t in spark.catalog.listTables() if t.name.endswith('forecast')][0]}").collect()}
        assert described["Num Buckets"] == "8"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_layout(spark, str(tmp_path))
