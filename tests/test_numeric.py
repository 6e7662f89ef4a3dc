import math

from pyspark.sql import functions as F

from dockplan.functions.numeric import greatest_of, ieee_div, is_finite_value, least_of, not_pos_infinity, stable_round


def test_ieee_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(ieee_div("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])
    assert got[3] == 2.0 and got[4] is None and got[5] is None


def test_extrema_propagate_or_skip(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (4.0, 2.0, 3.0)], "a double, b double, c double")
    prop = [r[0] for r in df.select(least_of("a", "b", "c")).collect()]
    skip = [r[0] for r in df.select(least_of("a", "b", "c", nulls="skip")).collect()]
    big = [r[0] for r in df.select(greatest_of("a", "b", "c")).collect()]
    assert prop == [None, 2.0] and skip == [1.0, 2.0] and big == [None, 4.0]


def test_finite_filters(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (float("inf"),), (float("-inf"),)], "x double")
    fin = [r[0] for r in df.where(is_finite_value("x")).collect()]
    not_inf = df.where(not_pos_infinity("x")).collect()
    assert sorted(fin) == [float("-inf"), 1.0, float("inf")]
    # <> 'Infinity' keeps NaN and -Infinity, drops NULL and +Infinity
    vals = [r[0] for r in not_inf]
    assert len(vals) == 3 and any(math.isnan(v) for v in vals) and float("-inf") in vals


def test_stable_round(spark):
    df = spark.createDataFrame([(0.1234565,), (float("inf"),), (float("nan"),), (2.0 / 3.0,)], "x double")
    got = [r[0] for r in df.select(stable_round("x")).collect()]
    assert got[0] == 0.123457 and got[1] == math.inf and math.isnan(got[2]) and got[3] == 0.666667
