import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockplan.functions.calendar import busday_add, busday_sub


def test_goldens(spark):
    df = spark.createDataFrame([(dt.date(2019, 8, 12), 0), (dt.date(2019, 8, 12), 1), (dt.date(2019, 8, 12), 5),
                                (dt.date(2019, 8, 16), 10)], "d date, n int")
    got = [r[0] for r in df.select(busday_sub("d", "n")).collect()]
    assert got == [dt.date(2019, 8, 12), dt.date(2019, 8, 9), dt.date(2019, 8, 5), dt.date(2019, 8, 2)]


def test_against_numpy(spark):
    start = dt.date(2019, 7, 1)
    days = [start + dt.timedelta(days=i) for i in range(28)]
    pairs = [(d, n) for d in days if d.weekday() < 5 for n in range(0, 61, 3)]
    df = spark.createDataFrame(pairs, "d date, n int")
    got = df.select("d", "n", busday_sub("d", "n").alias("s"), busday_add("d", "n").alias("a")).collect()
    for r in got:
        assert r["s"] == np.busday_offset(r["d"], -r["n"]).astype(dt.date)
        assert r["a"] == np.busday_offset(r["d"], r["n"]).astype(dt.date)


def test_weekend_start_is_error(spark):
    df = spark.createDataFrame([(dt.date(2019, 8, 17), 1)], "d date, n int")
    with pytest.raises(Exception):
        df.select(busday_sub("d", "n")).collect()
