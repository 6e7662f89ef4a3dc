"""A storage layout for the tables that join on (item, location): bucketed and sorted by that key.

``write_layout`` stores each of them as an external catalog table, partitioned by snapshot day and cut into the same number of buckets
by the same key, one sorted file a bucket and day. ``read_layout`` gives them back with their bucketing, in another session too, so
the joins and sums on (item, location) meet without an exchange; one snapshot is still one folder. The key is the pair, so
neither a location nor an item with a large share of the rows fills a bucket.

The layout is committed by a marker with its number of buckets, written last; a writer that died leaves no layout. Every write goes to
folders of its own, so readers of an earlier one are not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockplan.sources.schemas import SCHEMAS

#: Tables that join on it, each with its names for the key.
KEYS = {
    "item_location_vendor": ("item", "location_code"),
    "item_location": ("item", "location_code"),
    "inventory_snapshot": ("item", "location_code"),
    "forecast": ("item", "area"),
}
DAY = "snapshot_date"
MARKER = "written timestamp, version string, buckets int"


def _table_name(version: str, name: str) -> str:
    return f"layout_{version}_{name}"


def write_layout(tables: dict[str, DataFrame], root: str, buckets: int) -> None:
    """Store the tables of ``KEYS`` below ``root``. A bucket of a snapshot should hold some hundred megabytes."""
    spark = tables["forecast"].sparkSession
    version = uuid.uuid4().hex
    for name, key in KEYS.items():
        df = tables[name].select(*SCHEMAS[name].fieldNames())
        # The exchange deals rows as buckets do, so a task writes one bucket.
        writer = df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).format("parquet")
        if DAY in df.columns:
            writer = writer.partitionBy(DAY)
        writer.option("path", f"{root.rstrip('/')}/{version}/{name}").saveAsTable(_table_name(version, name))
    marker = spark.range(0, 1, 1, 1).select(F.current_timestamp().alias("written"), F.lit(version).alias("version"), F.lit(buckets).alias("buckets"))
    marker.write.mode("append").json(f"{root.rstrip('/')}/layouts")


def read_layout(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last committed layout below ``root``, with their bucketing."""
    try:
        layouts = spark.read.schema(MARKER).json(f"{root.rstrip('/')}/layouts").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        layouts = []
    if not layouts:
        raise FileNotFoundError(f"no layout is committed at {root}")
    last = max(layouts, key=lambda r: (r["written"], r["version"]))
    out = {}
    for name, key in KEYS.items():
        table = _table_name(last["version"], name)
        if not spark.catalog.tableExists(table):
            schema = SCHEMAS[name]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by_day = f"PARTITIONED BY ({DAY})" if DAY in schema.fieldNames() else ""
            keys = ", ".join(key)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by_day} CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                      f"INTO {last['buckets']} BUCKETS LOCATION '{root.rstrip('/')}/{last['version']}/{name}'")
            if by_day:
                spark.catalog.recoverPartitions(table)
        out[name] = spark.table(table)
    return out
