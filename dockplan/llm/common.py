"""Helpers shared by the operators of this subpackage: reading, text, scratch tables.

Nothing here depends on a machine-local folder. Intermediate tables go to the
shared folder named by ``spark.checkpoint.dir``; only a session without that
setting (a local test) gets a temporary one.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import math
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, and tab to carriage return.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, a null being the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``modulus`` (null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(c: Column) -> Column:
    """Maximal runs of non-space characters, in order; no words give an empty array."""
    bare = F.btrim(c, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session; set here only where none is named."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="dockplan-llm-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends at a table that outlives executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_hash(df: DataFrame, column: str, share: float) -> DataFrame:
    """About that share of the rows: those whose hash of the column is below a threshold. A filter, without a sort or a limit."""
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(column), F.lit(1 << 40)) < int(share * (1 << 40)))


def power_of_two_at_least(n: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, n))))


_SHIPPED: set[str] = set()


#: Rows that go to a Python task at a time: texts are long, and Spark's own default holds ten thousand of them.
BATCH_ROWS = 1_000


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application: executors see none of the driver's folders.

    A session that has no batch size of its own gets ``BATCH_ROWS``, so that a task's memory stays small.
    """
    context = spark.sparkContext
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_ROWS)
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="dockplan-ship-")) / "dockplan.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


#: Codes of glibc's ``mallopt``: fixed values.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3
LARGE_BLOCK = 1 << 20


@functools.cache
def frugal() -> None:
    """Blocks of ``LARGE_BLOCK`` bytes or more leave this worker process as soon as they are freed; by default the C library
    raises that size to that of the largest block freed so far, and keeps what is smaller."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(M_MMAP_THRESHOLD, LARGE_BLOCK)
        libc.mallopt(M_TRIM_THRESHOLD, LARGE_BLOCK)
    except (AttributeError, OSError):  # not glibc
        pass


def trim() -> None:
    """Free memory of Arrow and the C library goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def give_back() -> None:
    """Free memory goes back to the system: a worker that turns to another operator does not hold the last one's peak."""
    gc.collect()
    trim()


_KEPT: dict = {}


def forget() -> None:
    """Drop what this worker process keeps for earlier tasks: the one that starts needs none of it."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def worker_cache(name, make):
    """The one cache that a worker process keeps between tasks: asking for another one drops it first.

    Workers are reused by all queries of a session, so caches of several operators would add up.
    """
    if name not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[name] = make()
    return _KEPT[name]
