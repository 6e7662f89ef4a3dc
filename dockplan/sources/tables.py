"""Scans: logical tables from storage, snapshot-day and location predicates.

``read_tables`` is the production entry: each logical table is a Parquet
dataset (ideally partitioned by ``snapshot_date``) read with its explicit
schema, so the snapshot predicate prunes partitions and only the referenced
columns are read. ``at_snapshot`` / ``at_location`` are plain ``where``
clauses that Catalyst pushes into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockplan.sources.schemas import SCHEMAS


def read_tables(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for ``<root>/<name>`` Parquet datasets."""
    root = root.rstrip("/")
    names = list(names) if names is not None else list(SCHEMAS)
    return {n: spark.read.schema(SCHEMAS[n]).parquet(f"{root}/{n}") for n in names}


def at_snapshot(df: DataFrame, col: str, as_of: dt.date) -> DataFrame:
    """Rows of one snapshot day. ``as_of`` is a parameter, never the clock."""
    return df.where(F.col(col) == F.lit(as_of))


def at_location(df: DataFrame, col: str, locations: Iterable[str] | None) -> DataFrame:
    """Rows of the given locations; all rows when ``locations`` is None."""
    if locations is None:
        return df
    locs = list(locations)
    if len(locs) == 1:
        return df.where(F.col(col) == F.lit(locs[0]))
    return df.where(F.col(col).isin(locs))


def in_horizon(df: DataFrame, col: str, start: dt.date, days: int) -> DataFrame:
    """Inclusive date range of ``days`` days from ``start``."""
    s = F.lit(start)
    return df.where(F.col(col).between(s, F.date_add(s, days - 1)))
