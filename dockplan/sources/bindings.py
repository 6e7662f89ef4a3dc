"""Derive the logical planning tables from the driver's TPC-H-style tables.

The planning reports read vendor, item and forecast tables that the driver
does not ship. Each logical table is defined here as a DataFrame over
``part``, ``supplier``, ``region``, ``nation``, ``customer``, ``orders`` and
``lineitem`` (rules in FIXTURES.md part 2), so every report's work grows with
the driver tables. Location = region name, vendor number = ``'V' || suppkey``,
item = ``p_partkey``.

Location grids (item x location, vendor x location) are built by exploding
the location key range (min and max key, read once as a two-value aggregate)
and joining the location dimension on its key: a linear fan-out by the
number of locations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockplan.config import (
    DELIVERY_CONTAINER,
    DELIVERY_FULL_TRUCK,
    DELIVERY_LESS_TRUCK,
    DELIVERY_SMALL_PARCEL,
)

AS_OF = dt.date(2000, 1, 1)
SITE = "EUROPE"

# Driver table schemas (read from the Parquet files), so reads skip inference.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}
DRIVER_TABLES = tuple(DRIVER_SCHEMAS)


def _vendor_number(key: Column) -> Column:
    return F.concat(F.lit("V"), key.cast("string"))


class DriverTables:
    """Lazy logical tables over one driver folder (``.../sf0.01``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self._cache: dict[str, DataFrame] = {}

    # -- raw driver tables -------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        key = f"raw:{name}"
        if key not in self._cache:
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            df = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            if name in self.SPREAD:
                df = self._spread(df)
            self._cache[key] = df
        return self._cache[key]

    # Fact tables whose per-row work (joins, projections) follows the scan.
    SPREAD = ("lineitem", "orders")

    def _spread(self, df: DataFrame) -> DataFrame:
        """Spread a scan that has fewer splits than cores (one row group per file).

        The driver files hold one row group each, so one task would read and
        process every row. Multi-file inputs already have at least as many
        splits as cores and are left as they are.
        """
        try:
            cores = self.spark.sparkContext.defaultParallelism
            splits = df.rdd.getNumPartitions()
        except Exception:  # no RDD access (Spark Connect): leave the scan as is
            return df
        return df.repartition(cores) if splits < cores else df

    def _scalars(self) -> tuple[int, int, int]:
        """Location key range and supplier count: three aggregates, read once."""
        if not hasattr(self, "_scalar_values"):
            lo, hi = self.raw("region").agg(F.min("r_regionkey"), F.max("r_regionkey")).first()
            (n,) = self.raw("supplier").agg(F.count(F.lit(1))).first()
            self._scalar_values = (int(lo), int(hi), int(n))
        return self._scalar_values

    def _with_locations(self, df: DataFrame) -> DataFrame:
        """Every row once per location (region), as an explode + key join."""
        region = self.raw("region")
        lo, hi, _ = self._scalars()
        grid = df.withColumn("r_regionkey", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
        return grid.join(region, "r_regionkey", "inner")

    def _lineitem_region(self) -> DataFrame:
        """Line items with the customer's region (forecast area / warehouse)."""
        li = self.raw("lineitem")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        r = self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, "n_regionkey")
        )

    def _control_number(self) -> Column:
        months = F.year("l_shipdate") * 12 + F.month("l_shipdate")
        return F.concat(F.lit("PO"), F.col("l_suppkey").cast("string"), F.lit("-"), months.cast("string"))

    # -- logical tables ----------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = getattr(self, f"_{name}")()
        return self._cache[name]

    def _vendor_location(self) -> DataFrame:
        s = self.raw("supplier")
        g = self._with_locations(s)
        key = F.col("s_suppkey")
        k = (F.lit(1) + key % 4).cast("double")
        m8 = key % 8
        delivery = (
            F.when(key % 5 == 0, DELIVERY_CONTAINER)
            .when(key % 5 == 1, DELIVERY_FULL_TRUCK)
            .when(key % 5 == 2, DELIVERY_LESS_TRUCK)
            .when(key % 5 == 3, DELIVERY_SMALL_PARCEL)
            .otherwise("Prepaid")
        )
        ship = F.when(key % 7 == 0, "HOUSE").when(key % 7 == 1, "HOUSE.COM").otherwise("COLLECT")
        return g.select(
            F.lit(self.as_of).alias("snapshot_date"),
            F.col("r_name").alias("location_code"),
            _vendor_number(key).alias("vendor_number"),
            F.col("s_name").alias("vendor_name"),
            delivery.alias("vendor_delivery_type"),
            F.concat(F.lit("B"), (F.col("s_nationkey") % 4).cast("string")).alias("vendor_purchaser_code"),
            ship.alias("vendor_shipment_method_code"),
            F.when(key % 2 == 0, "DIRECT").otherwise("DISTRIBUTOR").alias("vendor_distribution_method"),
            F.when(F.col("s_acctbal") >= 0, "Enabled").otherwise("Disabled").alias("vendor_status"),
            ((key * 3 + F.col("r_regionkey")) % 23).cast("int").alias("vendor_lead_time_business_days"),
            F.when(m8 == 0, F.lit(0.4) * k).alias("vendor_planning_minimum_case"),
            F.when(m8 == 1, F.lit(5000.0) * k).alias("vendor_planning_minimum_cube"),
            F.when(m8 == 2, F.lit(1000.0) * k).alias("vendor_planning_minimum_dollar_amount"),
            F.when(m8 == 3, F.lit(0.04) * k).alias("vendor_planning_minimum_pallet"),
            F.when(key % 40 == 14, F.lit(0.0))
            .when(m8.isin(4, 7), F.lit(2.0) * k)
            .alias("vendor_planning_minimum_units"),
            F.when(m8.isin(5, 7), F.lit(20.0) * k).alias("vendor_planning_minimum_weight"),
        )

    def _item_location_vendor(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_size")
        n = F.lit(self._scalars()[2])
        g = self._with_locations(p).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        pk = F.col("p_partkey")
        mix = pk * 7 + F.col("r_regionkey") * 13 + F.col("k") * F.col("k") * 11
        uom = F.when(pk % 53 == 0, F.lit(0.0)).otherwise((F.lit(1) + F.col("p_size") % 12).cast("double"))
        return g.select(
            F.lit(self.as_of).alias("snapshot_date"),
            pk.alias("item"),
            F.col("r_name").alias("location_code"),
            _vendor_number(mix % n).alias("vendor_number"),
            (mix % 9).cast("int").alias("vendor_lead_time_business_days"),
            uom.alias("vendor_uom_qty"),
            uom.alias("base_uom_qty"),
            (F.col("k") == 0).alias("primary_vendor_flag"),
            (pk % 47 == 0).alias("product_discontinued_flag"),
            (pk % 37 != 0).alias("product_published_flag"),
            F.when(pk % 59 == 0, F.lit("X")).alias("purchase_source_location"),
        ).repartition("item", "location_code").distinct()

    def _item_master(self) -> DataFrame:
        p = self.raw("part")
        pk = F.col("p_partkey")
        return p.select(
            pk.alias("item"),
            F.when(pk % 89 != 0, F.col("p_size") * F.lit(100.0)).alias("unit_cube"),
            (F.col("p_retailprice") * F.lit(0.6)).alias("unit_cost"),
            F.when(pk % 97 == 0, F.lit(0.0)).otherwise((F.col("p_size") + 20).cast("double")).alias("pallet_qty"),
            (F.col("p_size") * F.lit(0.5)).alias("unit_weight"),
        )

    def _item_location(self) -> DataFrame:
        g = self._with_locations(self.raw("part").select("p_partkey"))
        return g.where((F.col("p_partkey") + F.col("r_regionkey")) % 11 != 0).select(
            F.col("p_partkey").alias("item"), F.col("r_name").alias("location_code")
        )

    def _product_dims(self) -> DataFrame:
        p = self.raw("part")
        pk, size = F.col("p_partkey"), F.col("p_size")
        return p.where(pk % 29 != 0).select(
            pk.alias("item"),
            F.when(pk % 83 != 0, size * F.lit(0.8)).alias("height"),
            (size * F.lit(1.1)).alias("length"),
            (size * F.lit(0.9)).alias("width"),
            (size * F.lit(0.5)).alias("weight"),
            F.lit("EA").alias("unit_of_measure"),
            F.lit("LB").alias("weight_uom"),
            (pk % 31 != 0).alias("setup_completed_flag"),
            (pk % 61 == 0).alias("discontinued_flag"),
        )

    def _forecast(self) -> DataFrame:
        return self._lineitem_region().select(
            F.lit(self.as_of).alias("snapshot_date"),
            F.col("l_partkey").alias("item"),
            F.col("r_name").alias("area"),
            F.to_date("l_shipdate").alias("forecast_date"),
            (F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("base_qty"),
            F.col("l_quantity").alias("commercial_qty"),
        )

    def _inventory_snapshot(self) -> DataFrame:
        f = self.table("forecast")
        start = F.lit(self.as_of)
        rate = (
            f.where(F.col("forecast_date").between(start, F.date_add(start, 89)))
            .groupBy("item", "area")
            .agg((F.sum("commercial_qty") / F.lit(90.0)).alias("daily_forecast_qty"))
        )
        return rate.select(
            F.lit(self.as_of).alias("snapshot_date"),
            "item",
            F.col("area").alias("location_code"),
            "daily_forecast_qty",
            (F.col("item") % 41 != 0).alias("managed_flag"),
            (F.col("item") % 43 == 0).alias("location_discontinued_flag"),
        )

    def _receipt_log(self) -> DataFrame:
        return self._lineitem_region().select(
            F.col("r_name").alias("wh_id"),
            self._control_number().alias("control_number"),
            F.col("l_partkey").cast("string").alias("item_number"),
            F.when(F.col("l_returnflag") == "R", F.lit(951)).otherwise(F.lit(151)).alias("tran_type"),
            F.when(F.col("l_linenumber") == 7, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("tran_qty"),
            F.to_date("l_shipdate").alias("tran_date"),
        )

    def _procurement_docs(self) -> DataFrame:
        li = self.raw("lineitem")
        docs = li.select(
            self._control_number().alias("document_number"),
            F.col("l_suppkey").alias("vendor_key"),
            F.when(F.month("l_shipdate") == 12, "Transfer").otherwise("Purchase").alias("document_type"),
        ).distinct()
        # A second row for some documents: the receipt join must keep the fan-out.
        return docs.unionAll(docs.where(F.col("vendor_key") % 10 == 0))

    def _vendors(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            F.col("s_suppkey").alias("vendor_key"),
            _vendor_number(F.col("s_suppkey")).alias("vendor_number"),
            F.col("s_name").alias("vendor_name"),
        )

    def _vendor_override(self) -> DataFrame:
        s = self.raw("supplier")
        key = F.col("s_suppkey")
        delivery = F.when(
            key % 31 == 0,
            F.when(key % 3 == 0, DELIVERY_LESS_TRUCK)
            .when(key % 3 == 1, DELIVERY_SMALL_PARCEL)
            .otherwise(DELIVERY_CONTAINER),
        )
        amount = F.when(key % 16 == 6, F.lit(25.0))
        return s.select(
            _vendor_number(key).alias("vendor_number"),
            delivery.alias("delivery_type"),
            amount.alias("min_amount"),
        ).where(F.col("delivery_type").isNotNull() | F.col("min_amount").isNotNull())

    def _plan_rows(self) -> DataFrame:
        """Vendor-location levelling input independent of the reports."""
        g = self._with_locations(self.raw("supplier"))
        key, rk = F.col("s_suppkey"), F.col("r_regionkey")
        return g.select(
            F.col("r_name").alias("location_code"),
            _vendor_number(key).alias("vendor_number"),
            F.col("s_name").alias("vendor_name"),
            ((key * 3 + rk) % 23).cast("int").alias("vendor_lead_time_business_days"),
            ((key * 7919 + rk * 101) % 997).cast("long").alias("weekly_units"),
            ((key * 37 + rk * 11) % 5 + 1).cast("int").alias("orders"),
        )

    def all(self) -> dict[str, DataFrame]:
        names = (
            "vendor_location",
            "item_location_vendor",
            "item_master",
            "item_location",
            "inventory_snapshot",
            "forecast",
            "product_dims",
            "receipt_log",
            "procurement_docs",
            "vendors",
            "vendor_override",
        )
        return {n: self.table(n) for n in names}


def bind(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DriverTables:
    return DriverTables(spark, sf_dir, as_of)
