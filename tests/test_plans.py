"""Plan checks: pushdown into the scans, no global sort, no Python in the reports."""

import pytest

from dockplan.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["report_weekly_plan", "report_horizon", "report_snapshot", "vendor_upt"])
def test_report_plans(spark, key):
    p = _plan(catalog.QUERIES[key](spark, SF))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "FlatMapGroupsInPandas" not in p
    assert "Sort [" not in p or "true, 0" not in p  # no global ORDER BY sort
    assert "PushedFilters" in p


def test_projection_pruned(spark):
    df = catalog.QUERIES["forecast_horizon"](spark, SF)
    p = _plan(df)
    # the forecast reads only the columns it needs from lineitem
    assert "l_extendedprice" not in p and "l_tax" not in p


def test_no_python_in_levelling(spark):
    for key in ("level_days", "weekly_schedule", "audit_schedule"):
        p = _plan(catalog.QUERIES[key](spark, SF))
        assert "Pandas" not in p and "Python" not in p


REPORTS = ("report_weekly_plan", "report_horizon", "report_snapshot", "report_snapshot_all_sites", "vendor_upt", "delivery_type_override")


def test_building_a_report_starts_no_job(spark):
    spark.range(1).count()
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy"))
    for key in REPORTS:
        catalog.QUERIES[key](spark, SF)  # files are listed and their schemas read once
    spark.sparkContext.setJobGroup("lazy", "plan building")
    try:
        for key in REPORTS:
            catalog.QUERIES[key](spark, SF)
        assert jobs() == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
