"""Registered queries against their DuckDB oracles on sf0.001 (the driver checks sf0.01).

Set DOCKPLAN_FULL_ORACLE=1 to run every key; by default the reports, UPT and
levelling keys run.
"""

import os

import pytest

import __spark_entry__ as E
from dockplan.plans import catalog
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
DEFAULT = ["report_weekly_plan", "report_horizon", "report_snapshot", "report_self_join", "vendor_upt",
           "weekly_schedule", "schedule", "audit_schedule", "level_days", "weekly_schedule_site", "infeasible_vendors",
           "planning_minimum_fallback", "item_weekly", "report_snapshot_all_sites", "vendor_upt_since"]
KEYS = sorted(catalog.QUERIES) if os.environ.get("DOCKPLAN_FULL_ORACLE") else DEFAULT


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, con, key):
    r = compare(spark, con, SF, key, E.queries()[key], E.oracle_sql().get(key))
    assert r.get("match", True), r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
