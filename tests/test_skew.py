"""Skew guards: one location with most vendors follows the same rule as any other."""

import datetime as dt

from dockplan import config
from dockplan.operators import leveling

CFG = config.weekly_plan(dt.date(2000, 1, 1))
PLAN = ("location_code string, vendor_number string, vendor_name string, vendor_lead_time_business_days int, "
        "weekly_units long, orders int")


def test_a_large_location_changes_nothing_for_a_small_one(spark):
    small = [("SMALL", f"W{i}", "n", 1, 10 + i, 1 + i % 5) for i in range(10)]
    big = [("BIG", f"V{i}", "n", 1, 50 + i * 37 % 1000, 1 + i % 5) for i in range(6000)]
    alone, beside = (
        leveling.level_days(leveling.order_size(spark.createDataFrame(rows, PLAN), CFG), CFG)
        .where("location_code = 'SMALL'").select("vendor_number", "day_index")
        for rows in (small, small + big))
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, beside.collect()))


def test_peak_stays_near_the_mean(spark):
    big = [("BIG", f"V{i}", "n", 1, 50 + i * 37 % 1000, 1 + i % 4) for i in range(3000)]
    lv = leveling.level_days(leveling.order_size(spark.createDataFrame(big, PLAN), CFG), CFG)
    g = leveling.level_gap(lv, CFG).collect()[0]
    assert g["gap"] <= g["largest_order"] and g["peak"] <= 1.01 * g["lower_bound"]
