"""Row counts of the driver-table binding and report shapes (FIXTURES.md part 2)."""

import pytest
from pyspark.sql import functions as F

from dockplan.plans import catalog
from dockplan.sources import bind

SF = "/root/testdata/sf0.001"

TABLES = {
    "vendor_location": 50,
    "item_location_vendor": 3000,
    "item_master": 200,
    "item_location": 909,
    "product_dims": 193,
    "forecast": 6000,
    "inventory_snapshot": 198,
}

SHAPES = {
    "report_self_join": 2531,  # all sites
    "report_horizon": 50,
    "report_weekly_plan": 50,
    "vendor_upt": 50,
    "level_days": 150,
}


@pytest.mark.parametrize("name,expected", sorted(TABLES.items()))
def test_binding_counts(spark, name, expected):
    assert bind(spark, SF).table(name).count() == expected


def test_documents_without_second_copies(spark):
    docs = bind(spark, SF).table("procurement_docs")
    assert docs.distinct().count() == 826
    assert docs.count() > 826  # the duplicated documents exercise the fan-out


@pytest.mark.parametrize("key,expected", sorted(SHAPES.items()))
def test_report_shapes(spark, key, expected):
    assert catalog.QUERIES[key](spark, SF).count() == expected


def test_weekly_plan_reaches_every_branch(spark):
    df = catalog.QUERIES["report_weekly_plan"](spark, "/root/testdata/sf0.01")
    cad = {r[0]: r[1] for r in df.groupBy("num_orders_per_week").count().collect()}
    assert cad == {1: 386, 2: 27, 3: 6, 4: 5, 5: 24, None: 11}
    types = {r[0] for r in df.select("vendor_min_type").distinct().collect()}
    assert types == {"case", "cube", "dollar", "pallet", "unit", "weight", "undefined"}
    assert df.where(F.col("moqs_per_order") == float("inf")).count() == 19
