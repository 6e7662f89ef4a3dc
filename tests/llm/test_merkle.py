"""The Merkle manifest against trees built in plain Python, at several arities."""

import hashlib

import pytest
from pyspark.sql import functions as F

from dockplan.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def record(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests, arity):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def way(tree, i, arity):
    for level in tree[:-1]:
        start = i // arity * arity
        yield level[start:i], level[i + 1 : start + arity]
        i //= arity


def expected(rows, arity):
    """Per row, sorted: (id, leaf, subroot, root, proof)."""
    by_source = {}
    for r in rows:
        leaf = record([r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]])
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r["doc_id"]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(by_source[n], key=lambda x: x[:3])], arity) for n in names]
    crown = levels([t[-1][0] for t in trees], arity)
    out = []
    for j, n in enumerate(names):
        for i, x in enumerate(sorted(by_source[n], key=lambda x: x[:3])):
            beside = [d for side in (*way(trees[j], i, arity), *way(crown, j, arity)) for half in side for d in half]
            out.append((x[3], x[2], trees[j][-1][0], crown[-1][0], h("".join(beside))))
    return sorted(out, key=str)


def many(spark, arity):
    """Sources of 0, 1, arity, arity + 1 and many rows, one of them null, one beyond ASCII."""
    sizes = {None: 1, "": 2, "a": arity, "B": arity + 1, "é": arity**2 + 1, "hot": 300}
    rows = [(k * 1000 + i if (k + i) % 7 else None, f"Text {k} {i % 3}", "en" if i % 2 else None, s, i if i % 5 else None)
            for k, (s, size) in enumerate(sizes.items()) for i in range(size)]
    return spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_against_plain_trees(spark, arity):
    docs = many(spark, arity)
    records = docs.select("doc_id", "source", merkle.record_hash([F.col(c) for c in merkle.FIELDS]).alias("leaf"))
    out = merkle.manifest(records, "source", "doc_id", arity)
    got = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("steps")).alias("p"),
                     merkle.fold(F.col("leaf"), F.col("steps")).alias("up")).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(docs.collect(), arity)
    assert all(r["up"] == r["root"] for r in got)


def test_query_on_odd_rows_and_names(spark, folder, extra):
    clash = extra.withColumn("leaf", F.lit("mine")).withColumn("tree", F.lit("mine")).withColumn("pos", F.lit("mine"))
    out = merkle.op12_merkle_manifest(spark, folder(documents=clash)).collect()
    assert sorted((tuple(r)[:5] for r in out), key=str) == expected(extra.collect(), 16)
    changed = {r["doc_id"] for r in out if not r["verified"]}
    # A tampered row fails where lower-casing changes its text, and nowhere else.
    import zlib

    texts = {}
    for r in extra.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    lower = {i for i, ts in texts.items() for t in ts if t and any("A" <= c <= "Z" for c in t)}
    assert changed == {i for i in lower if zlib.crc32(str("" if i is None else i).encode()) % 5 == 0}


@pytest.mark.parametrize("rows", [[], [(7, "Only One")]])
def test_no_row_and_one_row(spark, folder, rows):
    out = merkle.op12_merkle_manifest(spark, folder(documents=rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == h("")
