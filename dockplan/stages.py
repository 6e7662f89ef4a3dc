"""Stage boundaries: tables that are written once to the shared folder and read back by every later use.

A plan that uses a table in several places would otherwise compute it in each of them, and a lost executor would send Spark
back to the first scan. ``kept`` writes one table; ``Stages`` keeps named tables of one run, so that a run that is started again
under its name goes on after its last finished stage.

A stage is committed by a marker, a one-row JSON table that is written after the data and names the folder they are in and their
schema. Every attempt writes to a folder of its own, so an attempt that died, or two that ran at once, never mix their files: what
no marker names does not exist. Of several markers the smallest folder name counts, and all readers agree on it.

The folder is ``spark.checkpoint.dir``, which driver and executors share. Only a local session without it gets a temporary one.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockplan.session import checkpoint_dir

MARKER = "folder string, schema string"


def stage_dir(spark: SparkSession) -> str:
    folder = checkpoint_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="dockplan-stages-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def kept(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once, to a folder that no other attempt uses, and read back."""
    spark = df.sparkSession
    path = f"{folder or stage_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Stages:
    """Named tables of one run. ``run`` is the name to go on under; without one the run is new."""

    def __init__(self, spark: SparkSession, run: str | None = None, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or stage_dir(spark)}/run-{run or uuid.uuid4().hex}"

    def committed(self, name: str) -> DataFrame | None:
        """The stage's table, or None where no attempt has finished."""
        try:
            markers = self.spark.read.schema(MARKER).json(f"{self.folder}/{name}.committed").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if not markers:
            return None
        folder, schema = min(markers)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.folder}/{folder}")

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of the stage: read back if it is committed, else built, written and committed."""
        done = self.committed(name)
        if done is not None:
            return done
        df = build()
        folder = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{folder}")
        marker = self.spark.range(0, 1, 1, 1).select(F.lit(folder).alias("folder"), F.lit(df.schema.json()).alias("schema"))
        marker.write.mode("append").json(f"{self.folder}/{name}.committed")
        return self.committed(name)
