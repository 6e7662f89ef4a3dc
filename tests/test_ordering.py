"""Positions must not depend on partitions, payload columns, size or retries."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockplan.functions import ordering
from dockplan.functions.ordering import ordered_index, running_total, running_totals

ROWS = 24_000


def _rows(spark):
    """Payload columns beside the keys, ties in the first key, one group with nine tenths of the rows."""
    return spark.range(0, ROWS).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7 + 1).otherwise(F.lit(0)).alias("g"),
        ((F.col("id") * 104729) % 1009).alias("v"), F.col("id").alias("k"),
        F.repeat(F.lit("payload"), 5).alias("p1"), F.rand(3).alias("p2"), (F.col("id") % 5).alias("w"))


@pytest.mark.parametrize("partitions", [2, 4, 16, 200])
def test_matches_a_window_at_any_partition_count(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = _rows(spark).repartition(partitions)
        got = running_total(df, order=[-F.col("v"), "k"], group=["g"], value=F.col("w"), name="t")
        w = Window.partitionBy("g").orderBy(F.col("v").desc(), "k").rowsBetween(Window.unboundedPreceding, -1)
        ref = df.withColumn("t", F.coalesce(F.sum("w").over(w), F.lit(0)))
        assert got.select("g", "k", "t").exceptAll(ref.select("g", "k", "t")).count() == 0 and got.count() == ROWS
        serial = ordered_index(df, order=["v", "k"], name="i").select("i", "v", "k").orderBy("i").collect()
        assert [r["i"] for r in serial] == list(range(ROWS))
        assert [(r["v"], r["k"]) for r in serial] == sorted((r["v"], r["k"]) for r in serial)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_group_is_spread(spark):
    ranked = ordered_index(_rows(spark), order=["v", "k"], group=["g"], name="i", buckets=16)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan
    hot = _rows(spark).where("g = 0")
    sizes = ordered_index(hot, order=["v", "k"], name="i", buckets=16).select((F.col("i") * 16 / hot.count()).cast("int").alias("b"))
    assert sizes.distinct().count() == 16


@pytest.mark.parametrize("buckets", [2, 10, 64, 65, 300, 2000])
def test_matches_a_window_at_any_bucket_count(spark, buckets):
    """One level of bounds, two levels, and more bounds than a gap has keys."""
    df = _rows(spark).drop("p1", "p2")
    got = running_totals(df, order=[-F.col("v"), "k"], group=["g"], values={"t": F.col("w"), "i": F.lit(1)}, buckets=buckets)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "k").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("t", F.coalesce(F.sum("w").over(w), F.lit(0))).withColumn("i", F.count(F.lit(1)).over(w))
    assert got.select(*ref.columns).exceptAll(ref).count() == 0 and got.count() == ROWS


def test_buckets_follow_the_rows(spark, monkeypatch):
    """No ceiling, even buckets, and few tuples on the driver: the upper bounds alone."""
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", ROWS // 400)
    df = _rows(spark).where("g = 0").select("v", "k")
    n = df.count()
    bounds = ordering.key_bounds(df, ["v", "k"], [], n * 400 // ROWS, n)
    sizes = [r["count"] for r in bounds.bucket(df, ["v", "k"]).groupBy("_bucket").count().collect()]
    assert 200 <= len(sizes) <= 600 and max(sizes) <= 8 * n / len(sizes)
    assert bounds.n_upper <= 40 and bounds.lower.count() <= bounds.n_upper + 1


def test_bisection_counts_smaller_bounds(spark):
    for n in (0, 1, 2, 3, 7, 8, 9, 31):
        bounds = F.array(*[F.struct(F.lit(2 * i).alias("k0")) for i in range(n)]) if n else F.array().cast("array<struct<k0:int>>")
        df = spark.range(-1, 70).select("id", ordering.below(bounds, F.struct(F.col("id").cast("int").alias("k0")), n).alias("b"))
        assert all(r["b"] == sum(2 * i < r["id"] for i in range(n)) for r in df.collect())


def test_small_and_empty(spark):
    df = spark.createDataFrame([(2,), (1,)], "x int")
    assert sorted(tuple(r) for r in ordered_index(df, order=["x"], name="i").collect()) == [(1, 0), (2, 1)]
    assert ordered_index(df.limit(0), order=["x"], name="i").count() == 0


def test_null_group_and_sort_keys_kept(spark):
    df = spark.createDataFrame([(None, 3), (None, None), ("a", 2), ("a", 5), (None, 2)], "g string, v int")
    key = lambda t: (t[0] is None, t[0] or "", t[1] is not None, t[1] or 0)
    got = sorted(((r["g"], r["v"], r["i"]) for r in ordered_index(df, order=["v"], group=["g"], name="i").collect()), key=key)
    assert got == sorted([(None, None, 0), (None, 2, 1), (None, 3, 2), ("a", 2, 0), ("a", 5, 1)], key=key)
