"""Distributed positions and running sums under a total order.

``running_totals`` gives every row the sums of values over the rows before it
in its group, without sending a group to one task. Rows are cut into buckets
by bounds of the sort key, so a row's bucket is a pure function of its key:
sums per (group, bucket) give the offsets, a window inside (group, bucket) the
rest. The evaluations agree whatever the partitioning, the number of
partitions, retries or the size of the data.

The number of buckets follows the rows (``ROWS_PER_BUCKET``), without a
ceiling. Bounds have two levels. The upper ones, about the square root of the
buckets, stand in the plan as literals; the lower ones are a table with one
array for each gap between two upper ones, joined on that gap. Both are
searched by bisection. Only the upper bounds' key tuples reach the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.stages import kept

#: Keys sampled per bound.
SAMPLES_PER_BOUND = 32
#: Rows that a bucket should hold.
ROWS_PER_BUCKET = 100_000
#: Buckets up to which the upper level alone is enough.
ONE_LEVEL = 64


def _key(order: list) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)])


def _literal(value, data_type) -> Column:
    if value is None or isinstance(value, (bool, int, float, str, dt.date, dt.datetime, Decimal)):
        return F.lit(value).cast(data_type)
    raise TypeError(f"no literal for a sort key of type {type(value).__name__}")


def below(bounds: Column, key: Column, most: int) -> Column:
    """How many of the ascending ``bounds``, at most ``most``, are smaller than the key: bisection in O(log) steps."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(max(1, most.bit_length())))])
    n = F.size(bounds)

    def step(at: Column, width: Column) -> Column:
        return F.when((at + width <= n) & (F.get(bounds, at + width - 1) < key), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


@dataclass
class Bounds:
    """Upper bounds as one literal array; ``lower`` has (_gap, _lower), the sorted bounds inside each gap, or is None."""

    upper: Column | None
    n_upper: int
    lower: DataFrame | None
    n_lower: int

    def bucket(self, df: DataFrame, order: list) -> DataFrame:
        """``df`` with ``_bucket``, ascending with the key."""
        key = _key(order)
        gap = F.lit(0) if self.upper is None else below(self.upper, key, self.n_upper)
        if self.lower is None:
            return df.withColumn("_bucket", gap.cast("long"))
        inside = F.when(F.col("_lower").isNull(), 0).otherwise(below(F.col("_lower"), key, self.n_lower))
        out = df.withColumn("_gap", gap).join(self.lower, "_gap", "left")
        return out.withColumn("_bucket", F.col("_gap").cast("long") * (self.n_lower + 1) + inside).drop("_gap", "_lower")


def key_sample(df: DataFrame, order: list, group: list[str], rows: int, wanted: int) -> DataFrame:
    """Keys of about ``wanted`` of the rows, chosen by a hash of group and key, so by the data alone."""
    keys = df.select(_key(order).alias("_key"), F.xxhash64(*group, _key(order)).alias("_hash"))
    if wanted < rows:
        keys = keys.where(F.pmod("_hash", F.lit(1 << 40)) < int(wanted / rows * (1 << 40)))
    return keys.select("_key.*")


def _upper_bounds(keys: DataFrame, rows: int, bounds: int) -> tuple[Column | None, int]:
    """About ``bounds`` evenly spaced keys of a small sample, as a literal array. Picked in Spark; only they reach the driver."""
    columns = keys.columns
    wanted = (bounds + 1) * SAMPLES_PER_BOUND
    if wanted < rows:
        keys = keys.where(F.pmod(F.xxhash64(F.lit(1), *columns), F.lit(1 << 40)) < int(wanted / rows * (1 << 40)))
    placed = keys.withColumn("_at", F.row_number().over(Window.orderBy(*columns)))  # a bounded sample
    picked = placed.where(F.col("_at") % SAMPLES_PER_BOUND == 0).drop("_at").distinct().orderBy(*columns).collect()
    if not picked:
        return None, 0
    types = [f.dataType for f in keys.schema.fields]
    literals = [F.struct(*[_literal(v, t).alias(c) for v, t, c in zip(r, types, columns)]) for r in picked]
    return F.array(*literals), len(literals)


def key_bounds(df: DataFrame, order: list, group: list[str], buckets: int, rows: int) -> Bounds:
    """Bounds for about ``buckets`` buckets of ``rows`` rows."""
    if buckets <= 1 or not rows:
        return Bounds(None, 0, None, 0)
    if buckets <= ONE_LEVEL:
        wanted = buckets * SAMPLES_PER_BOUND
        return Bounds(*_upper_bounds(key_sample(df, order, group, rows, wanted), min(rows, wanted), buckets - 1), None, 0)
    wanted = buckets * SAMPLES_PER_BOUND
    sample = kept(key_sample(df, order, group, rows, wanted))
    n = sample.count()
    upper, n_upper = _upper_bounds(sample, n, math.isqrt(buckets))
    # Inside a gap, about as many sampled keys as the gaps' mean; every so-many-th is a bound.
    key = F.struct(*[F.col(c) for c in sample.columns])
    gap = F.lit(0) if upper is None else below(upper, key, n_upper)
    per_bound = max(1, n // buckets)
    place = F.row_number().over(Window.partitionBy("_gap").orderBy(*sample.columns))
    lower = sample.withColumn("_gap", gap).withColumn("_at", place).where(F.col("_at") % per_bound == 0)
    lower = kept(lower.groupBy("_gap").agg(F.array_sort(F.collect_set(key)).alias("_lower")))
    return Bounds(upper, n_upper, lower, lower.agg(F.max(F.size("_lower"))).first()[0] or 0)


def running_totals(
    df: DataFrame,
    order: list,
    group: list[str] | tuple[str, ...] = (),
    values: dict[str, Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add a column for each of ``values``: its sum over the earlier rows of the group.

    ``order`` lists ascending sort keys (negate a number to descend; NULLs
    first) and must be total inside a group. ``df`` is evaluated several times
    (rows, bounds, sums): give a stored table where it is costly. Taking the
    bounds runs jobs.
    """
    group, values = list(group), dict(values or {})
    rows = df.count()
    bounds = key_bounds(df, order, group, buckets or math.ceil(rows / ROWS_PER_BUCKET), rows)
    placed = bounds.bucket(df, order).withColumns({f"_v{i}": v.cast("long") for i, v in enumerate(values.values())})
    sums = placed.groupBy(*group, "_bucket").agg(*[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(values))])
    # One row per (group, bucket).
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    renamed = {g: f"_g{i}" for i, g in enumerate(group)}
    offsets = sums.select(*[F.col(g).alias(r) for g, r in renamed.items()], F.col("_bucket").alias("_b"), *[
        F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_o{i}") for i in range(len(values))])
    inside = Window.partitionBy(*group, "_bucket").orderBy(_key(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_l{i}": F.coalesce(F.sum(f"_v{i}").over(inside), F.lit(0)) for i in range(len(values))})
    on = F.col("_bucket") == F.col("_b")
    for g, r in renamed.items():
        on = on & F.col(g).eqNullSafe(F.col(r))  # a NULL group is a group like any other
    out = local.join(offsets, on).withColumns({name: (F.col(f"_o{i}") + F.col(f"_l{i}")).cast("long") for i, name in enumerate(values)})
    return out.drop("_bucket", "_b", *renamed.values(), *[f"_{c}{i}" for c in "vlo" for i in range(len(values))])


def running_total(df: DataFrame, order: list, group: list[str] | tuple[str, ...] = (), value: Column | None = None,
                  name: str = "before", buckets: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group."""
    return running_totals(df, order, group, {name: F.lit(1) if value is None else value}, buckets)


def ordered_index(df: DataFrame, order: list, group: list[str] | tuple[str, ...] = (), name: str = "idx",
                  buckets: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of the row in its group under ``order``."""
    return running_total(df, order, group, None, name, buckets)
