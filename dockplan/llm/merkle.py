"""Merkle manifest of a table, by sibling-shift self-joins (operator 12).

A record's hash covers its fields in a fixed order. The records of a source, by ascending key, are the leaves of that source's
tree; every ``arity`` consecutive nodes become the hash of their digests until one is left, the subroot. The subroots, by source,
are the leaves of one more tree, whose top is the root. A record's proof are the other digests of its runs, level by level.

Every level is one equijoin of the nodes with themselves. A node asks for the indices of its siblings, which it computes: the
XOR with 1 in a binary tree, its run's slots shifted by 0 .. arity - 1 otherwise (shift 0 being the node itself). The answers,
at most ``arity`` for a node, are put in order, and slot-zero rows emit the parents. A key of that join is one node, so no join
key is hot, whatever a source's share. Levels shrink by ``arity``, so all of them cost little more than the first.

Positions come from one range exchange on (source, key, digest): rows are counted by range partition, so a hot source is spread
over as many tasks as its rows need, and only one count a partition is broadcast. Paths are handed down from the root: a node's
path is its own siblings before its parent's path, so only the last join, by leaf, has as many rows as the table.

Every level is written to the shared folder before the next one reads it.

Defined cases. A null field is ``-``, any other its UTF-8 length, ``:`` and its text. Null sources form one tree, the first; null
keys come first in theirs. Rows that repeat a key are ordered by digest, and rows that repeat everything are interchangeable: each
is a leaf. A tree of one leaf has that leaf as subroot, and a table of one row that leaf as root; its proof is the hash of nothing.
An empty table gives an empty result. Columns that are not named as fields take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.llm.common import id_remainder, lower_ascii, stored, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
#: Rows whose id has a CRC-32 that this divides are tampered with, to see that their proof then fails.
TAMPER = 5


def record_hash(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each with its length, nulls as a dash."""

    def written(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[written(c) for c in fields]), 256)


def as_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def parent_hash(digests: Column) -> Column:
    """Digest, as 32 bytes, of digests that stand one after the other; hashing is over their hex text."""
    return F.unhex(F.sha2(as_text(digests), 256))


def concatenated(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda all_, one: F.concat(all_, one))


def with_position(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` written with ``pos`` 0, 1, 2, ... by ``order``, nulls first. Rows equal in all of it take any order among themselves."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last sort key parts rows that repeat everything, of which one range could otherwise hold a third of the table.
    dealt = rows.withColumn("_same", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_same")
    dealt = dealt.sortWithinPartitions(*order, "_same").drop("_same")
    placed = stored(dealt.withColumn("_part", F.spark_partition_id()).withColumn(
        "_in", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range partition, whatever the input.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    out = placed.join(F.broadcast(offsets), "_part")
    return out.withColumn("pos", F.col("_in") + F.col("_before")).drop("_part", "_in", "_before")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, idx, n, digest) of trees with several, each with its siblings' digests ``before`` and ``after`` it."""
    idx = F.col("idx")
    if arity == 2:
        sought = F.array(idx, idx.bitwiseXOR(F.lit(1).cast("long")))
    else:
        slot = idx % arity
        sought = F.transform(F.sequence(F.lit(0), F.lit(arity - 1)), lambda shift: idx - slot + (slot + shift) % arity)
    asked = nodes.select("tree", "idx", "n", F.explode(sought).alias("at")).where("at < n")
    held = nodes.select("tree", F.col("idx").alias("at"), "digest")
    met = asked.join(held, ["tree", "at"])
    run = met.groupBy("tree", "idx", "n").agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("run"))

    def digests(where) -> Column:
        return concatenated(F.transform(F.filter("run", lambda x: where(x["at"], idx)), lambda x: x["digest"]))

    return run.select("tree", "idx", "n", digests(lambda a, i: a == i).alias("digest"),
                      digests(lambda a, i: a < i).alias("before"), digests(lambda a, i: a > i).alias("after"))


def grow(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For leaves (tree, idx, n, digest): by level, the nodes with siblings, and the tops (tree, digest) of trees that end there."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, tops, nodes = [], [], leaves
    while True:
        tops.append(nodes.where("n = 1").select("tree", "digest"))
        if most <= 1:
            return levels, tops
        level = stored(with_siblings(nodes.where("n > 1"), arity))
        levels.append(level)
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            parent_hash(F.concat("digest", "after")).alias("digest"))
        most = -(-most // arity)


def paths(levels: list[DataFrame], tops: list[DataFrame], above: DataFrame, arity: int, lowest: int = 0) -> DataFrame:
    """(tree, idx, steps, ...) of every node of the level ``lowest``: the siblings from its own level to the root.

    ``above`` has (tree, steps, ...) of the tops.
    """
    rest = [c for c in above.columns if c not in ("tree", "steps")]

    def ended(level: int) -> DataFrame:
        return tops[level].select("tree").join(above, "tree").select("tree", F.lit(0).cast("long").alias("idx"), "steps", *rest)

    path = ended(len(levels))
    for level in range(len(levels) - 1, lowest - 1, -1):
        path = beside_and_above(levels[level], path, arity).unionByName(ended(level))
    return path


def beside_and_above(nodes: DataFrame, path: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, idx, before, after, ...) with their siblings before the steps of their parents' ``path``."""
    rest = [c for c in path.columns if c not in ("tree", "idx", "steps")]
    payload = [c for c in nodes.columns if c not in ("tree", "idx", "n", "digest", "before", "after")]
    up = path.select("tree", F.col("idx").alias("parent"), F.col("steps").alias("higher"), *rest)
    nodes = nodes.withColumn("parent", F.expr(f"idx div {arity}"))
    own = F.array(F.struct("before", "after"))
    return nodes.join(up, ["tree", "parent"]).select("tree", "idx", F.concat(own, "higher").alias("steps"), *payload, *rest)


def manifest(records: DataFrame, source: str, key: str, arity: int = ARITY) -> DataFrame:
    """The records (with a hex ``leaf``) with subroot, root and ``steps``, their siblings' digests from the leaf upwards.

    ``records`` has ``source``, ``key``, ``leaf`` and any other columns but tree, idx, n, pos, digest, steps.
    """
    if arity < 2:
        raise ValueError("a run needs room for two nodes")
    placed = with_position(records, [source, key, "leaf"])
    trees = placed.groupBy(source).agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = with_position(trees, [source]).withColumnRenamed("pos", "tree")
    known = trees.select(F.col(source).alias("_source"), "_first", "n", "tree")
    leaves = stored(placed.join(known, F.col(source).eqNullSafe(F.col("_source")))
                    .withColumn("idx", F.col("pos") - F.col("_first")).drop("_source", "_first", "pos"))
    levels, tops = grow(leaves.select("tree", "idx", "n", F.unhex("leaf").alias("digest")), arity)
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.unionByName(t)
    subroots = stored(subroots)
    total = subroots.count()
    upper, upper_tops = grow(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                             F.lit(total).cast("long").alias("n"), "digest"), arity)
    root = upper_tops[-1]  # one tree, so its top is the last level's
    step = "array<struct<before:binary,after:binary>>"
    none = root.select("tree", F.array().cast(step).alias("steps"), F.col("digest").alias("_root"))
    above = paths(upper, upper_tops, none, arity).select(F.col("idx").alias("tree"), "steps", "_root")
    above = subroots.select("tree", F.col("digest").alias("_subroot")).join(above, "tree")
    # The leaves meet their siblings before their paths, so no join moves whole paths of the table's rows.
    if levels:
        out = leaves.join(levels[0].select("tree", "idx", "before", "after"), ["tree", "idx"])
        out = beside_and_above(out, paths(levels, tops, above, arity, lowest=1), arity)
        out = out.unionByName(leaves.where("n = 1").drop("n").join(above, "tree"))
    else:
        out = leaves.drop("n").join(above, "tree")
    return out.select(*[F.col(f"`{c}`") for c in records.columns], as_text(F.col("_subroot")).alias("subroot"),
                      as_text(F.col("_root")).alias("root"), "steps")


def proof_hash(steps: Column) -> Column:
    """Hex SHA-256 of all sibling digests, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: as_text(F.concat(s["before"], s["after"]))), ""), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hex) and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda digest, s: F.sha2(F.concat(as_text(s["before"]), digest, as_text(s["after"])), 256))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` under one root, 16 nodes a run; proofs recomputed from leaves of which one in five has its text lower-cased."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in FIELDS]
    tampered = record_hash([lower_ascii(F.col("text")) if c == "text" else F.col(c) for c in FIELDS])
    records = docs.select("doc_id", "source", record_hash(fields).alias("leaf"),
                          F.when(id_remainder("doc_id", TAMPER) == 0, tampered).alias("changed"))
    out = manifest(records, "source", "doc_id")
    folded = fold(F.coalesce("changed", "leaf"), F.col("steps"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
