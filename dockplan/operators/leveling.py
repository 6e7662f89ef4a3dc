"""Delivery-day levelling: spread each vendor's weekly orders over receiving days.

Vendor i needs s_i units on exactly n_i of D days; minimise the heaviest day.
With integer units an optimum puts ceil(s_i / n_i) on each chosen day, so the
job is to choose the days (L3), in two steps that are the same at every size.

* ``deal`` deals the orders out in falling size, as a running total that no
  single task computes. A location's peak then exceeds its mean day by its
  largest order at most.
* ``improved`` searches around the deal. Per location a fixed number of rounds
  takes the best move or swap of orders between the heaviest day (or, where
  nothing helps that, the next one) and a lighter one, such that both end
  below the heavier one's load. Candidates are a bounded
  pool of a location's vendors, spread over their days and sizes by ranks that
  limit groups before the shuffle: a small location has all of its vendors in
  it, a large one orders of every size. No round raises the peak, so
  the deal's guarantee stays.

The result need not be the optimum; ``level_gap`` reports the distance to a
lower bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.config import PlanConfig
from dockplan.functions.calendar import busday_sub, receive_day_date
from dockplan.functions.numeric import stable_round_sql
from dockplan.functions.ordering import running_total, running_totals
from dockplan.stages import kept

_LONG_MAX = 9.2e18

#: Vendors of a location among which the search moves orders, and its rounds.
POOL_VENDORS = 96
ROUNDS = 32


def trunc_long_sql(c: str) -> str:
    """int(x): truncate toward zero; NULL for NaN, Infinity and NULL.

    ``x`` is first taken through ``stable_round``: a double sum that is a
    whole number in exact arithmetic can come out as 5.9999999999 or 6.0
    depending on the summation order (which changes with partitioning), and
    truncation would turn that last-bit noise into a whole unit.
    """
    return (
        f"(CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < {_LONG_MAX!r}D"
        f" THEN CAST({stable_round_sql(c)} AS BIGINT) END)"
    )


def trunc_long(c: str) -> Column:
    return F.expr(trunc_long_sql(c))


def plan_rows(report: DataFrame) -> DataFrame:
    """Report rows bound to plan names by name (S4; decisions D1, D2)."""
    return report.selectExpr(
        "location_code",
        "vendor_number",
        "vendor_name",
        "vendor_lead_time_business_days",
        f"{trunc_long_sql('avg_per_week_in_qty')} AS weekly_units",
        "CAST(num_orders_per_week AS INT) AS orders",
        f"{trunc_long_sql('moq')} AS moq",
        "vendor_min_type AS unit",
        "vendor_delivery_type AS delivery_type",
        "vendor_purchaser_code AS purchaser_code",
        "vendor_shipment_method_code AS ship_code",
        "vendor_distribution_method AS dist_code",
    )


def plan_dedupe(plan: DataFrame) -> DataFrame:
    """One row per (location, vendor): the greatest under a total order (A10).

    The source keeps whichever row was fetched last. Here the row with the
    largest weekly units wins, ties broken by the remaining columns in order,
    as a max over a struct: an ordinary aggregate with a map-side partial, so
    a vendor with many rows is combined before the shuffle.
    """
    key = ["location_code", "vendor_number"]
    first = [c for c in ("weekly_units", "orders") if c in plan.columns]
    rest = first + [c for c in plan.columns if c not in key and c not in first]
    picked = plan.groupBy(*key).agg(F.max(F.struct(*[F.col(c) for c in rest])).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def order_size(plan: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Units per order s/n and whole units per chosen day ceil(s/n) (L1)."""
    valid = "weekly_units IS NOT NULL AND orders IS NOT NULL AND orders >= 1"
    ratio = "CAST(weekly_units AS DOUBLE) / CAST(orders AS DOUBLE)"
    return plan.withColumns(
        {
            "order_size": F.expr(f"CASE WHEN {valid} THEN {ratio} END"),
            "order_units": F.expr(f"CASE WHEN {valid} THEN CAST(greatest(ceil({ratio}), 0) AS BIGINT) END"),
        }
    )


def infeasible_reason(cfg: PlanConfig) -> Column:
    s, n, u = F.col("weekly_units"), F.col("orders"), F.col("order_units")
    return (
        F.when(s.isNull(), F.lit("demand unknown"))
        .when(n.isNull() | (n < 1) | (n > cfg.receiving_days), F.lit("orders outside 1..%d" % cfg.receiving_days))
        .when(u > F.lit(cfg.max_units_per_day), F.lit("order above daily capacity"))
    )


def infeasible_vendors(sized: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Vendors no schedule can serve, with the first failing rule."""
    r = sized.withColumn("reason", infeasible_reason(cfg))
    return r.where(F.col("reason").isNotNull()).select(
        "location_code", "vendor_number", "weekly_units", "orders", "order_units", "reason"
    )


def feasible(sized: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Vendors that can be scheduled; with ``cfg.all_or_nothing``, none of a
    location that has an infeasible vendor (a left anti join on the location)."""
    ok = sized.where(infeasible_reason(cfg).isNull())
    if cfg.all_or_nothing:
        bad = sized.where(infeasible_reason(cfg).isNotNull()).select("location_code").distinct()
        ok = ok.join(bad, "location_code", "left_anti")
    return ok


def candidate_days(plan: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Every vendor with every receiving day and its date."""
    g = plan.withColumn("day_index", F.explode(F.sequence(F.lit(1), F.lit(cfg.receiving_days))))
    return g.withColumn("receive_date", receive_day_date(F.lit(cfg.week_start), F.col("day_index")))


def deal(able: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Feasible vendors with the days of a first deal as bits of ``_days``.

    Vendors of a location come in falling order size, each taking as many
    consecutive slots as it has orders. D slots make a round, and round r
    starts on day r, so the days take turns at the largest orders of a round. A
    vendor has fewer than D slots, so its days differ; one with an order on
    every day adds the same to all and takes no slot. The first slot of a
    vendor is a running total over its location, at any size.
    """
    d = cfg.receiving_days
    dealt = running_total(able, order=[-F.col("order_units"), "vendor_number"], group=["location_code"],
                          value=F.expr(f"CASE WHEN orders >= {d} THEN 0 ELSE orders END"), name="_slot")
    day = f"CASE WHEN orders >= {d} THEN m ELSE (_slot + m + (_slot + m) div {d}) % {d} END"
    bits = f"aggregate(sequence(0, orders - 1), 0, (days, m) -> days | shiftleft(1, CAST({day} AS INT)))"
    return dealt.withColumn("_days", F.expr(bits)).drop("_slot")


def search_pool(dealt: DataFrame, cfg: PlanConfig, vendors: int = POOL_VENDORS) -> DataFrame:
    """(location_code, pool): at most ``vendors`` vendors of a location, an array of (vendor, units, days).

    Vendors are ranked among those with the same days and size to a power of
    two; all first ones of such a class come before any second. Both ranks
    limit their groups, so a location with a third of all rows is a few rows a
    task. Days are those of the deal.
    """
    movable = dealt.where((F.col("orders") < cfg.receiving_days) & (F.col("order_units") > 0))
    movable = movable.select("location_code", "vendor_number", "order_units", "_days", F.floor(F.log2("order_units")).alias("_octave"))
    largest = [F.desc("order_units"), "vendor_number"]
    in_class = Window.partitionBy("location_code", "_days", "_octave").orderBy(*largest)
    in_location = Window.partitionBy("location_code").orderBy("_nth", *largest)
    few = movable.withColumn("_nth", F.row_number().over(in_class)).where(F.col("_nth") <= vendors)
    few = few.withColumn("_at", F.row_number().over(in_location)).where(F.col("_at") <= vendors)
    vendor = F.struct(F.col("vendor_number").alias("vendor"), F.col("order_units").alias("units"), F.col("_days").alias("days"))
    return few.groupBy("location_code").agg(F.array_sort(F.collect_list(vendor)).alias("pool"))


def _on(days: str, day: str) -> str:
    return f"(shiftright({days}, {day}) & 1) = 1"


def search_sql(cfg: PlanConfig, rounds: int) -> str:
    """The pool after the rounds, from columns ``loads`` and ``pool``, as one parsed expression.

    A vendor a with an order on day p and none on day t gives it to t, and
    takes from it the order of a vendor b (none, of no units, for a move) that
    has one there and none on p. With a difference in load of f and in units of
    u, both days end at least min(u, f - u) below p's load, so an exchange is
    worth -min(u, f - u) = greatest(-u, u - f), and helps where that is below
    0; the least is best, ties by day and vendors. Days p come by falling load,
    a lighter one only where nothing helps the heavier: that may make room for
    those in a later round. Where no exchange helps, none will in a later round.
    """
    last = cfg.receiving_days - 1
    found = "struct<worse:bigint,target:int,vendor:string,other:string,units:bigint,source:int>"
    exchange = ("named_struct('worse', greatest(b.units - a.units, a.units - b.units + p.less + s.loads[t]), 'target', t, "
                "'vendor', a.vendor, 'other', b.vendor, 'units', a.units - b.units, 'source', p.at)")
    takers = (f"concat(array(named_struct('vendor', '', 'units', 0L, 'days', 0)), "
              f"filter(s.pool, b -> {_on('b.days', 't')} AND NOT {_on('b.days', 'p.at')}))")
    givers = f"filter(s.pool, a -> {_on('a.days', 'p.at')} AND NOT {_on('a.days', 't')})"
    to_day = (f"transform(array({takers}), others -> array_min(flatten(transform({givers}, "
              f"a -> filter(transform(others, b -> {exchange}), e -> e.worse < 0)))))[0]")
    best = (f"aggregate(array_sort(transform(s.loads, (load, i) -> named_struct('less', -load, 'at', i))), CAST(NULL AS {found}), "
            f"(found, p) -> CASE WHEN found IS NOT NULL THEN found ELSE array_min(transform(sequence(0, {last}), t -> {to_day})) END)")
    loads = "transform(s.loads, (load, i) -> load - CASE i WHEN x.source THEN x.units WHEN x.target THEN -x.units ELSE 0 END)"
    pool = ("transform(s.pool, v -> named_struct('vendor', v.vendor, 'units', v.units, 'days', CASE WHEN v.vendor IN (x.vendor, x.other) "
            "THEN v.days ^ (shiftleft(1, x.source) | shiftleft(1, x.target)) ELSE v.days END))")
    after = (f"transform(array({best}), x -> CASE WHEN x IS NULL THEN named_struct('loads', s.loads, 'pool', s.pool, 'done', true) "
             f"ELSE named_struct('loads', {loads}, 'pool', {pool}, 'done', false) END)[0]")
    return (f"aggregate(sequence(1, {rounds}), named_struct('loads', loads, 'pool', pool, 'done', false), "
            f"(s, r) -> CASE WHEN s.done THEN s ELSE {after} END).pool")


def improved(dealt: DataFrame, cfg: PlanConfig, rounds: int = ROUNDS, vendors: int = POOL_VENDORS) -> DataFrame:
    """``dealt`` (evaluated three times) with the days after the search. One row a location holds its loads and its pool."""
    of_day = [f"CAST(sum(CASE WHEN {_on('_days', str(i))} THEN order_units ELSE 0 END) AS BIGINT)" for i in range(cfg.receiving_days)]
    loads = F.expr(f"array({', '.join(of_day)})")
    start = dealt.groupBy("location_code").agg(loads.alias("loads"))
    pool = search_pool(dealt, cfg, vendors).withColumnRenamed("location_code", "_location")
    start = start.join(pool, F.col("location_code").eqNullSafe(F.col("_location")))

    moved = start.select("_location", F.explode(F.expr(search_sql(cfg, rounds))).alias("_v"))
    moved = moved.select("_location", F.col("_v.vendor").alias("_vendor"), F.col("_v.days").alias("_new"))
    same = F.col("location_code").eqNullSafe(F.col("_location")) & (F.col("vendor_number") == F.col("_vendor"))
    out = dealt.join(moved, same, "left")
    return out.withColumn("_days", F.coalesce("_new", "_days")).drop("_location", "_vendor", "_new")


def level_days(sized: DataFrame, cfg: PlanConfig, rounds: int = ROUNDS) -> DataFrame:
    """Feasible vendors x chosen days with units per day (L3). The deal is written before it is searched."""
    able = feasible(sized, cfg)
    chosen = improved(kept(deal(able, cfg)), cfg, rounds)
    days = F.expr(f"filter(sequence(1, {cfg.receiving_days}), x -> {_on('_days', 'x - 1')})")
    out = chosen.withColumn("day_index", F.explode(days)).drop("_days")
    return out.withColumn("units", F.col("order_units"))


def with_dates(levelled: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Receive date of the day and order date counted back in business days."""
    out = levelled.withColumn("receive_date", receive_day_date(F.lit(cfg.week_start), F.col("day_index")))
    return out.withColumn("order_date", busday_sub(F.col("receive_date"), F.col("vendor_lead_time_business_days")))


def day_load(levelled: DataFrame) -> DataFrame:
    """Units per location and receiving day."""
    return levelled.groupBy("location_code", "day_index").agg(F.sum("units").cast("long").alias("load"))


def peak_load(levelled: DataFrame) -> DataFrame:
    """Heaviest day per location: the objective."""
    return day_load(levelled).groupBy("location_code").agg(F.max("load").alias("peak"))


def ranked_bound(levelled: DataFrame, cfg: PlanConfig) -> DataFrame:
    """(location_code, ranked): the greatest of the bounds by rank, over orders that are not of every day.

    Of the kD + 1 largest orders k + 1 share a day, so the peak is at least the
    sum of the k + 1 smallest of these, for every k. With P the running total
    of the orders by falling size that is P(kD + 1) - P(k(D - 1)), so each k
    needs two ranks, which meet in one aggregate.
    """
    d = cfg.receiving_days
    orders = levelled.where(F.col("orders") < d).select("location_code", "vendor_number", "day_index", "units")
    placed = running_totals(orders, order=[-F.col("units"), "vendor_number", "day_index"], group=["location_code"],
                            values={"_rank": F.lit(1), "_before": F.col("units")})
    rank, total = F.col("_rank") + 1, F.col("_before") + F.col("units")
    last = F.struct(((rank - 1) / d).cast("long").alias("k"), F.lit(1).alias("side"), total.alias("sum"))
    first = F.struct((rank / (d - 1)).cast("long").alias("k"), F.lit(0).alias("side"), (-total).alias("sum"))
    ends = F.concat(F.when((rank - 1) % d == 0, F.array(last)).otherwise(F.array().cast("array<struct<k:bigint,side:int,sum:bigint>>")),
                    F.when(rank % (d - 1) == 0, F.array(first)).otherwise(F.array().cast("array<struct<k:bigint,side:int,sum:bigint>>")))
    ends = placed.select("location_code", F.explode(ends).alias("e")).select("location_code", "e.*")
    by_k = ends.groupBy("location_code", "k").agg(F.max("side").alias("reached"), F.sum("sum").alias("bound")).where("reached = 1")
    # Rank 0 has no row; its total is 0, and k = 0 gives the largest order.
    return by_k.groupBy("location_code").agg(F.max("bound").cast("long").alias("ranked"))


def level_gap(levelled: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Peak against the greatest lower bound: the mean day, the largest order, the bounds by rank.

    Orders of every day add the same to each, so they stand beside the bounds
    of the others. ``levelled`` is evaluated several times.
    """
    d = cfg.receiving_days
    daily = F.col("orders") >= d
    tot = levelled.groupBy("location_code").agg(
        F.sum("units").cast("long").alias("total_units"), F.max("units").cast("long").alias("largest_order"),
        F.coalesce(F.sum(F.when(daily & (F.col("day_index") == 1), F.col("units"))), F.lit(0)).cast("long").alias("_daily"),
    )
    ranked = ranked_bound(levelled, cfg).withColumnRenamed("location_code", "_location")
    g = tot.join(peak_load(levelled), "location_code", "inner")
    g = g.join(ranked, F.col("location_code").eqNullSafe(F.col("_location")), "left")
    mean = F.expr(f"(total_units + {d - 1}) div {d}")
    bound = F.greatest(mean, F.col("_daily") + F.coalesce("ranked", F.lit(0))).cast("long")
    return g.select(
        "location_code",
        "total_units",
        "largest_order",
        "peak",
        bound.alias("lower_bound"),
        (F.col("peak") - bound).cast("long").alias("gap"),
    )


def audit_schedule(schedule: DataFrame, sized: DataFrame, cfg: PlanConfig) -> DataFrame:
    """One row per rule with its violations in a finished schedule (L4).

    The schedule is checked as its readers get it, against the sized plan and
    the reported peak, none of which it computed itself: one aggregate over the
    schedule rows, one over the vendors, one over the days of a location.
    """
    d = cfg.receiving_days
    plan = feasible(sized, cfg).select("location_code", "vendor_number", "weekly_units", "orders", "order_size")
    day = F.lit(cfg.week_start)
    first, last = receive_day_date(day, F.lit(1)), receive_day_date(day, F.lit(d))
    keyed = schedule.select("serial_no", "location_code", "vendor_number", "receive_date", "units")
    vendors = keyed.groupBy("location_code", "vendor_number").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_distinct("receive_date").alias("_days"), F.sum("units").alias("_units"),
        F.max("units").alias("_largest"), F.min("units").alias("_smallest"))
    pv = plan.withColumn("_planned", F.lit(True)).join(vendors, ["location_code", "vendor_number"], "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rules = {
        "days_equal_orders": zero("_days") != zero("orders"),
        "rows_equal_orders": zero("_rows") != zero("orders"),
        "units_cover_demand": zero("_units") < zero("weekly_units"),
        "units_at_least_order_size": F.col("_smallest").cast("double") < F.col("order_size"),
        "units_within_capacity": zero("_largest") > F.lit(cfg.max_units_per_day),
        "vendor_in_plan": F.col("_planned").isNull(),
    }
    of_vendors = pv.agg(*[F.count(F.when(c, 1)).alias(k) for k, c in rules.items()])
    # The deal's guarantee: no day above the location's mean day by more than its largest order.
    loads = keyed.groupBy("location_code", "receive_date").agg(F.sum("units").alias("_load"))
    per_location = plan.groupBy("location_code").agg(
        F.sum(F.ceil("order_size") * F.col("orders")).alias("_total"), F.max(F.ceil("order_size")).alias("_order"))
    over = loads.join(per_location, "location_code", "left").where(
        F.coalesce(F.col("_load") * d > F.col("_total") + F.col("_order") * d, F.lit(True)))
    of_loads = over.agg(F.count(F.lit(1)).alias("day_load_near_mean"))
    # Serials 1..n are dense and unique when their count, range and distinct count agree; each must follow its predecessor.
    after = keyed.select((F.col("serial_no") + 1).alias("serial_no"), F.struct("receive_date", "location_code", "vendor_number").alias("_previous"))
    step = keyed.join(after, "serial_no").where(F.struct("receive_date", "location_code", "vendor_number") < F.col("_previous"))
    of_order = step.agg(F.count(F.lit(1)).alias("serial_in_order"))
    of_rows = keyed.agg(
        (F.count(F.lit(1)) - F.count_distinct("serial_no")
         + F.abs(F.coalesce(F.max("serial_no"), F.lit(0)) - F.count(F.lit(1)))).alias("serial_dense"),
        F.count(F.when(~F.coalesce(F.col("receive_date").between(first, last), F.lit(False)), 1)).alias("receive_date_in_week"))
    parts = [of_vendors, of_loads, of_order, of_rows]
    out = [p.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in p.columns]),
                                                F.array(*[F.col(c).cast("long") for c in p.columns]))).alias("rule", "violations")) for p in parts]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])
