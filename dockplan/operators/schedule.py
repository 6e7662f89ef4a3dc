"""Schedule assembly and CSV sink."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockplan.functions.ordering import ordered_index
from dockplan.stages import kept

ROWS_PER_FILE = 1_000_000
#: Names of part files have five digits; with more files their order would not be that of their numbers.
MOST_FILES = 99_999

SCHEDULE_COLUMNS = (
    "serial_no",
    "location_code",
    "vendor_number",
    "order_date",
    "receive_date",
    "lead_time",
    "units",
    "vendor_name",
    "moq",
    "unit",
    "delivery_type",
    "purchaser_code",
    "ship_code",
    "dist_code",
)


def schedule(dated: DataFrame) -> DataFrame:
    """Schedule rows numbered from 1 by (receive date, location, vendor).

    The serial number comes from buckets with key bounds plus their
    offsets, not from a global window, so no single task sees every row.
    ``dated`` is evaluated several times: give a stored table.
    """
    rows = dated.select(
        "location_code",
        "vendor_number",
        "order_date",
        "receive_date",
        F.col("vendor_lead_time_business_days").alias("lead_time"),
        F.col("units").cast("long").alias("units"),
        "vendor_name",
        F.col("moq").cast("long").alias("moq"),
        "unit",
        "delivery_type",
        "purchaser_code",
        "ship_code",
        "dist_code",
    )
    numbered = ordered_index(rows, order=["receive_date", "location_code", "vendor_number"], name="_i")
    return numbered.withColumn("serial_no", F.col("_i") + F.lit(1)).select(*SCHEDULE_COLUMNS)


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def recover_schedule(spark: SparkSession, path: str) -> bool:
    """Put back the schedule that a run had moved aside when it died before its own stood there; True if one was."""
    store, at = _store(spark, path)
    if store.exists(at):
        return False
    aside = store.globStatus(_store(spark, f"{path}.replaced-*")[1])
    if not aside:
        return False
    last = max(aside, key=lambda s: s.getModificationTime())
    return store.rename(last.getPath(), at)


def write_schedule(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """CSV with a header in serial order, replacing what is at ``path`` only when complete.

    A range exchange on the serial number gives every file one range of them,
    sorted; part files are numbered by range, so reading them in name order
    gives 1, 2, 3, ... . They are written to a folder beside ``path`` and
    swapped in by two renames: a run that fails before leaves the old schedule
    as it was, and one that dies between the two leaves it beside, where
    ``recover_schedule`` (called here too) finds it. Values are quoted when needed.
    """
    spark = df.sparkSession
    recover_schedule(spark, path)
    rows = kept(df)
    files = min(MOST_FILES, max(1, math.ceil(rows.count() / rows_per_file)))
    attempt = uuid.uuid4().hex
    side, aside = f"{path}.writing-{attempt}", f"{path}.replaced-{attempt}"
    ordered = rows.repartitionByRange(files, "serial_no").sortWithinPartitions("serial_no")
    ordered.write.option("header", True).csv(side)
    store, at = _store(spark, path)
    new, old = _store(spark, side)[1], _store(spark, aside)[1]
    replaced = store.exists(at)
    if replaced and not store.rename(at, old):
        raise OSError(f"{path} cannot be moved aside; the new schedule is at {side}")
    if not store.rename(new, at):
        if replaced:
            store.rename(old, at)
        raise OSError(f"the new schedule cannot be moved to {path}; it is at {side}")
    if replaced:
        store.delete(old, True)
