"""Weighted rendezvous sharding (operator 10).

Every (record key, shard) pair gets a pseudo-random draw u in (0, 1); the record goes to the shard with the
smallest ``-ln(u) / weight``. A shard's draws do not depend on the other shards, so adding one moves only the
records the new shard wins, and shares follow the weights. Assignment is one projection, without a shuffle.

Slots number the rows of a shard 0, 1, 2, ... A shard is first cut into ``slices`` by a hash of the key; a window
numbers rows inside (shard, slice), and the counts of the earlier slices (at most shards x slices rows) are added.
So no task sees a whole shard.

Law ``key``: the record key and the shard count alone decide. Rows with equal text but different keys are
placed independently, and rows that repeat a key share its shard.

Defined cases. A null key is one more key value: its rows share a shard. A null text has 0 bytes. Repeated rows keep
one slot each. An empty table gives an empty result. Other columns are kept by ``assign_shards``; columns it adds
replace same-named ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.llm.common import table

SLICES = 256
SALT = 0x5EED


def rendezvous_shard(key: Column, weights: Sequence[float], salt: int = SALT) -> Column:
    """Index of the winning shard; shards of weight 0 never win."""
    live = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("at least one shard needs a positive weight")

    def draw(i: int, w: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.lit(i), key), 11).cast("double")
        return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / F.lit(w)).alias("cost"), F.lit(i).alias("shard"))

    return F.array_min(F.array(*[draw(i, w) for i, w in live]))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], ties: Sequence[str] = (), slices: int = SLICES,
                  salt: int = SALT) -> DataFrame:
    """``df`` with ``shard`` and the gapless ``slot`` in it, ordered by slice, key and ``ties``."""
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    placed = df.select(
        *[F.col(f"`{c}`") for c in keep],
        rendezvous_shard(F.col(key), weights, salt).alias("shard"),
        F.pmod(F.xxhash64(F.lit(salt + 1), F.col(key)), F.lit(slices)).cast("int").alias("_slice"),
    )
    counts = placed.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most len(weights) * slices rows, whatever the input.
    offsets = counts.select("shard", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_slice").orderBy(key, *ties)
    numbered = placed.withColumn("_rank", F.row_number().over(inside))
    out = numbered.join(F.broadcast(offsets), ["shard", "_slice"])
    return out.select(*[F.col(f"`{c}`") for c in keep], "shard", (F.col("_before") + F.col("_rank") - 1).alias("slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; rows stay where their scan put them, so no shard gathers in one task."""
    assigned.write.partitionBy("shard").parquet(path)


N_SHARDS = 24


def op10_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` over 24 equal shards by ``doc_id``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = assign_shards(docs, "doc_id", [1.0] * N_SHARDS, ties=("size", "text_crc32"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        rendezvous_shard(F.col("doc_id"), [1.0] * (N_SHARDS + 1)).alias("grown_shard"),
    )
