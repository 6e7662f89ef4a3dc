"""The production path: logical tables as Parquet datasets read with explicit schemas.

Snapshot tables are written partitioned by ``snapshot_date``; the as-of
predicate must prune partitions, and the report must equal the one computed
on the in-memory binding.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dockplan import config
from dockplan.plans import reports
from dockplan.sources import bind, read_tables

SF = "/root/testdata/sf0.001"
SNAPSHOT_TABLES = ("vendor_location", "item_location_vendor", "inventory_snapshot", "forecast")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    b = bind(spark, SF)
    for name, df in b.all().items():
        w = df.write.mode("overwrite")
        if name in SNAPSHOT_TABLES:
            # a second, older snapshot that the as-of predicate must skip
            old = df.withColumn("snapshot_date", F.lit(dt.date(1999, 12, 31)))
            df = df.unionByName(old)
            w = df.write.mode("overwrite").partitionBy("snapshot_date")
        w.parquet(f"{root}/{name}")
    return root


def test_report_from_storage_equals_binding(spark, stored):
    cfg = config.weekly_plan(dt.date(2000, 1, 1))
    from_disk = reports.report_weekly_plan(read_tables(spark, stored), cfg)
    from_bind = reports.report_weekly_plan(bind(spark, SF).all(), cfg)
    assert from_disk.count() == from_bind.count() == 50
    assert from_disk.exceptAll(from_bind).count() == 0


def test_snapshot_predicate_prunes_partitions(spark, stored):
    cfg = config.horizon_report(dt.date(2000, 1, 1))
    plan = reports.report_horizon(read_tables(spark, stored), cfg)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "(snapshot_date" in plan and "= 2000-01-01)" in plan
