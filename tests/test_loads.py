import math

from pyspark.sql import functions as F

from dockplan import config
from dockplan.operators import loads

CFG = config.weekly_plan(__import__("datetime").date(2000, 1, 1))


def test_weekly_qty_snapshot(spark):
    df = spark.createDataFrame([(None, "unit"), (None, "undefined"), (2.0, "cube")], "d double, t string")
    got = [r[0] for r in df.select(loads.weekly_qty_snapshot("d", "t")).collect()]
    assert got == [0.0, None, 14.0]


def test_weekly_uom(spark):
    df = spark.createDataFrame(
        [("pallet", 12.0, 48.0, 1.0), ("pallet", 12.0, 0.0, 1.0), ("case", 0.0, 1.0, 0.0), ("undefined", 5.0, 1.0, 1.0)],
        "t string, q double, pq double, cq double")
    got = [r[0] for r in df.select(loads.weekly_uom("t", "q", "1.0D", "1.0D", "pq", "1.0D", "cq")).collect()]
    assert got[0] == 0.25 and got[1] == math.inf and math.isnan(got[2]) and got[3] is None


def test_truckloads_by_type(spark):
    df = spark.createDataFrame([("cube", 10.0, 41500.0, 10.0, 1.0), ("dollar", 10.0, None, 10.0, 1.0),
                                ("dollar", 10.0, 4150.0, 1.0, 4200.0)],
                               "t string, q double, cube double, pq double, w double")
    got = [r[0] for r in df.select(loads.truckloads_by_type("t", "q", "cube", "pq", "w", CFG)).collect()]
    assert abs(got[0] - 0.1) < 1e-12 and got[1] is None and abs(got[2] - 0.01) < 1e-12


def test_eq_pallets(spark):
    dims = spark.createDataFrame([(1, 80.0, 59.0, 24.0, 1.0, "EA", "LB", True, False),
                                  (2, 80.0, 59.0, 24.0, 1.0, "EA", "LB", None, False),
                                  (3, None, 59.0, 24.0, 1.0, "EA", "LB", True, False)],
                                 "item long, height double, length double, width double, weight double, "
                                 "unit_of_measure string, weight_uom string, setup_completed_flag boolean, "
                                 "discontinued_flag boolean")
    got = {r["item"]: r["eq_pallets"] for r in loads.eq_pallets(dims, CFG).collect()}
    assert got == {1: 2.0, 3: None}
