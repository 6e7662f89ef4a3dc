"""N-gram Jaccard join by grouped prefixes (operator 9): exact near-duplicate classes over 5-word shingles.

Sets and frequencies. A pass over the texts hashes each document's distinct shingles and deals them, packed, to buckets by
hash. A bucket counts documents per shingle and answers, per document, with its shingles that occur in two documents or more.
Only these can be shared, so sizes plus these lists decide every similarity.

Prefixes. Under one global order (rarest first, then by hash) two sets with 100 |A n B| >= 80 |A u B| share a shingle
among the first n - ceil(4n/5) + 1 of each. Shingles of a single document come first in the order and match nothing, so a
document with enough of them is done. Of the others, documents with equal sets are one class, and classes with equal size and
equal prefix are one group; only groups are posted, one row per prefix shingle.

Candidates. Joining all pairs of a posting list would be quadratic in a family of near copies. A hub round picks ``HUBS`` groups
per posting list, joins each group with the hubs whose bit sketches are nearest, expands groups to classes, verifies, and
merges what links. After these rounds, the last join takes every pair of groups that still lie in different components, under
lossless filters (size, position of the common shingle, sketch bits on which all classes of a group agree), and then every pair
of their classes, under the classes' own sketches: pairs inside a component need no check, the others are all checked. No link
is lost.

Verification intersects the shingle lists. Shingles are 64-bit hashes, dealt as bucket number and 32 bits, so two different
ones of a pair of documents are confused with a chance of about |A| |B| / (buckets * 2^32).

Scale: the two packed shuffles carry about 5 and 6 bytes a shingle (the second only of repeated ones); the number of buckets follows
the number of rows, without a ceiling. A bucket never holds a hot shingle: those that ``HOT_ROWS`` of ``HOT_SAMPLE_ROWS`` sampled rows hold are
found first and dealt by document, with the document count estimated from the sample (it only orders them), so what a bucket holds
of one shingle is about a 500th of the rows at most. Every shingle of every row takes part either way, and the result is the same.
Hot keys in joins are split by adaptive skew joins. Components
are found by alternating star steps over tables in the shared folder. Nothing but counters comes to the driver.

Defined cases. A null text has no words: size 0, alone. A null id is kept and never is a component's smallest unless all
its ids are null. Rows that repeat id and text give a row each; rows with one id and different texts are separate documents.
Texts of fewer than 5 words are one shingle. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import forget, frugal, ship, stored, table, trim, whole_text, worker_cache

WORDS = 5
HUBS = 16  # per posting list and round
SKETCH_BITS = 9  # 2 ** 9 bits
SKETCH_WORDS = (1 << SKETCH_BITS) // 64
SIDE = ("gid", "n", "pos", "lone", *[f"b{w}" for w in range(SKETCH_WORDS)])
POSTINGS = "key long, " + ", ".join(f"{c} long" for c in SIDE)
TRIES = (2, 4, 8)  # hubs that a group is verified against, by round
ROWS_PER_BUCKET = 5_000
HOT_SAMPLE_ROWS = 5_000
HOT_ROWS = 10  # of the sample
UNIT_BYTES = 3_000_000
SPLIT_BYTES = 500_000  # texts that are split into words at a time
MULTIPLIER = 0x9E3779B97F4A7C15
RECORD = [("rid", "<i8"), ("doc_id", "<i8"), ("null", "<i8"), ("n", "<i8"), ("digest", "S33"), ("mark", "<i8")]


class WordTable(dict):
    """64-bit hashes by byte word."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


WORD_LIMIT = 200_000


def word_codes(texts: list[list[bytes]], count: int) -> np.ndarray:
    """Hashes by one table per worker; about ``WORD_LIMIT`` words are remembered."""
    table = worker_cache("ngram_join", WordTable)
    if len(table) > WORD_LIMIT:
        table.clear()
    return np.fromiter(map(table.__getitem__, chain.from_iterable(texts)), dtype=np.uint64, count=count)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; bytes lower and split on exactly the ASCII letters and white space."""
    raw = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    w = word_codes(raw, int(sizes.sum()))
    raw = [b" ".join(r) if len(r) < WORDS else b"" for r in raw]  # the others are not needed any more
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        h = np.zeros(max(0, len(w) - WORDS + 1), dtype=np.uint64)
        for k in range(WORDS):
            h = (h ^ w[k : k + len(h)]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(29)
    out = []
    for n, z in zip(sizes.tolist(), ends.tolist()):
        if n >= WORDS:
            s = np.sort(h[z - n : z - WORDS + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(raw[len(out)], seed=n)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def units(texts: list[str], most: int = UNIT_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


PACKED = "bucket long, rid binary, cnt binary, key binary, rec binary"


def bucket_and_key(h: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (in the smallest type, which sorts fastest) and 32-bit key of shingle hashes."""
    return ((h >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.min_scalar_type(n_buckets)), h.astype(np.uint32)


def codes_of(bucket, key: np.ndarray) -> np.ndarray:
    """Bucket number and key as one number: what a shingle is told apart by."""
    return (np.asarray(bucket, dtype=np.int64) << 32) | key.astype(np.int64)


def count_codes(n_buckets: int):
    """Documents -> codes of their shingles with numbers of documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, z in units(texts, SPLIT_BYTES):
                code, n = np.unique(codes_of(*bucket_and_key(np.concatenate(shingle_sets(texts[a:z])), n_buckets)), return_counts=True)
                yield pd.DataFrame({"code": code, "n": n.astype(np.int64)})

    return run


def hot_shingles(rows: DataFrame, n_rows: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes that ``HOT_ROWS`` or more of about ``HOT_SAMPLE_ROWS`` sampled rows hold, and their estimated document counts.

    At most a ``HOT_ROWS``-th of the sample's shingles, whatever the input.
    """
    share = min(1.0, HOT_SAMPLE_ROWS / max(1, n_rows))
    counts = rows.select("text").sample(share, seed=11).mapInPandas(count_codes(n_buckets), "code long, n long")
    hot = sorted(map(tuple, counts.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_ROWS).collect()))
    codes, n = (np.array([x[i] for x in hot], dtype=np.int64) for i in (0, 1))
    return codes, np.clip(n / share, 2, 0xFFFF).astype("<u2")


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal neighbours, and their lengths."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)
    return at, np.diff(np.append(at, len(x)))


def by_number(*sorted_numbers: np.ndarray) -> Iterator[tuple]:
    """Each number in any of the sorted arrays, with its slice of each."""
    every = np.unique(np.concatenate([x.astype(np.int64) for x in sorted_numbers]))
    ends = [np.searchsorted(x, every, side) for x in sorted_numbers for side in ("left", "right")]
    for row in zip(every.tolist(), *[e.tolist() for e in ends]):
        yield row[0], *[slice(a, z) for a, z in zip(row[1::2], row[2::2])]


def deal(n_buckets: int, hot):
    """Documents -> per bucket: runs (rid, count) over 32-bit keys, and the records of the documents whose rid falls there.

    Hot shingles go, with bucket and key as one code, to the part of their document: bucket ``n_buckets`` + part.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frugal()
        codes = hot.value[0]
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, z in units(texts):
                sets = [s for x, y in units(texts[a:z], SPLIT_BYTES) for s in shingle_sets(texts[a + x : a + y])]
                null = pdf["doc_id"].iloc[a:z].isna().to_numpy()
                ids = pdf["doc_id"].iloc[a:z].fillna("0").astype(np.int64).to_numpy()
                rec = np.zeros(z - a, dtype=RECORD)
                rec["doc_id"], rec["null"], rec["n"] = ids, null, [len(s) for s in sets]
                rec["mark"] = pdf["mark"].iloc[a:z]
                rec["digest"] = [xxhash.xxh3_128_hexdigest(s.tobytes()).encode() for s in sets]
                rid = np.array([xxhash.xxh64_intdigest(f"{x}:{y}:{d.decode()}:{len(t)}") >> 1
                                for x, y, d, t in zip(ids.tolist(), null.tolist(), rec["digest"].tolist(), texts[a:z])], dtype="<i8")
                rec["rid"] = rid
                h = np.concatenate(sets)
                doc = np.repeat(np.arange(z - a), rec["n"])
                del sets
                bucket, key = bucket_and_key(h, n_buckets)
                rows = []
                if len(codes):
                    code = codes_of(bucket, key)
                    is_hot = codes[np.minimum(np.searchsorted(codes, code), len(codes) - 1)] == code
                    part = rid[doc[is_hot]] % n_buckets
                    order = np.argsort(part, kind="stable")
                    part, code, of = part[order], code[is_hot][order], doc[is_hot][order]
                    for p, s in by_number(part):
                        at, cnt = runs(of[s])
                        rows.append((n_buckets + p, rid[of[s][at]].tobytes(), cnt.astype("<u4").tobytes(), code[s].tobytes(), b""))
                    bucket, key, doc = bucket[~is_hot], key[~is_hot], doc[~is_hot]
                    del code, is_hot, part, of
                order = np.argsort(bucket, kind="stable")
                bucket, key, doc = bucket[order], key[order], doc[order]
                rec = rec[np.argsort(rid % n_buckets, kind="stable")]
                for b, s, home in by_number(bucket, rec["rid"] % n_buckets):
                    at, cnt = runs(doc[s])
                    rows.append((b, rid[doc[s][at]].tobytes(), cnt.astype("<u4").tobytes(), key[s].tobytes(), rec[home].tobytes()))
                del h, doc, order, key, bucket
                yield pd.DataFrame(rows, columns=["bucket", "rid", "cnt", "key", "rec"])
        trim()

    return run


ANSWERS = "part long, bucket long, rid binary, cnt binary, key binary, df binary, rec binary"
ALL_BUCKETS = -1  # in ANSWERS: keys are whole codes


def answer(n_parts: int, hot):
    """One bucket -> per part of the documents: their shingles that occur at least twice, with document counts.

    What is hot is in its part already and only gets its counts.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        frugal()
        forget()
        join = lambda c, t: np.frombuffer(b"".join(pdf[c]), dtype=t)
        bucket = int(pdf["bucket"].iloc[0])
        if bucket >= n_parts:
            codes, counts = hot.value
            df = counts[np.searchsorted(codes, join("key", "<i8"))]
            rows = [(bucket - n_parts, ALL_BUCKETS, *[b"".join(pdf[c]) for c in ("rid", "cnt", "key")], df.tobytes(), b"")]
            return pd.DataFrame(rows, columns=["part", "bucket", "rid", "cnt", "key", "df", "rec"])
        key, rec = join("key", "<u4"), join("rec", RECORD)
        rids, cnt = join("rid", "<i8"), join("cnt", "<u4")
        at_run = np.repeat(np.arange(len(cnt), dtype=np.uint32), cnt)
        order = np.argsort(key, kind="stable").astype(np.uint32)
        key = key[order]
        _, size = runs(key)
        df = np.repeat(np.minimum(size, 0xFFFF).astype("<u2"), size)
        twice = df > 1
        key, rid, df = key[twice], rids[at_run[order[twice]]], df[twice]
        del order, twice, size, at_run, rids, cnt
        order = np.lexsort((rid, rid % n_parts))
        key, rid, df = key[order], rid[order], df[order]
        rec = rec[np.argsort(rec["rid"] % n_parts, kind="stable")]
        rows = []
        for p, s, home in by_number(rid % n_parts, rec["rid"] % n_parts):
            at, cnt = runs(rid[s])
            rows.append((p, bucket, rid[s][at].tobytes(), cnt.astype("<u4").tobytes(), key[s].tobytes(), df[s].tobytes(), rec[home].tobytes()))
        del order, key, rid, df
        trim()
        return pd.DataFrame(rows, columns=["part", "bucket", "rid", "cnt", "key", "df", "rec"])

    return run


DOCUMENTS = "rid long, doc_id long, is_null boolean, n long, digest string, mark long, lone int, n_prefix int, shingles binary"


def gather(pdf: pd.DataFrame) -> pd.DataFrame:
    """One part -> a row per document; ``shingles`` (rarest first) only where a prefix can match."""
    frugal()
    forget()
    join = lambda c, t: np.frombuffer(b"".join(pdf[c]), dtype=t)
    rec = join("rec", RECORD)
    key = np.concatenate([np.frombuffer(k, "<i8") if b == ALL_BUCKETS else codes_of(b, np.frombuffer(k, "<u4"))
                          for b, k in zip(pdf["bucket"].tolist(), pdf["key"])])
    rid, df = np.repeat(join("rid", "<i8"), join("cnt", "<u4")), join("df", "<u2")
    order = np.lexsort((key, df, rid))
    key, rid = key[order], rid[order]
    del order, df
    out = []
    for r, doc, null, n, digest, mark in rec.tolist():
        a, z = np.searchsorted(rid, [r, r + 1])
        mine = key[a:z]
        if len(mine) > n:  # the row occurs more than once
            mine = mine[np.sort(np.unique(mine, return_index=True)[1])]
        lone = n - len(mine)
        prefix = n - (4 * n + 4) // 5 + 1 - lone if n else 0
        known = prefix > 0 and len(mine) > 0
        out.append((r, doc, bool(null), n, digest.decode(), mark, lone, min(prefix, len(mine)) if known else 0, mine.tobytes() if known else None))
    del key, rid
    trim()
    return pd.DataFrame(out, columns=["rid", "doc_id", "is_null", "n", "digest", "mark", "lone", "n_prefix", "shingles"])


def documents_with_shingles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The stored table of ``gather``'s rows."""
    rows = docs.select(F.col(f"`{key}`").cast("long").cast("string").alias("doc_id"), whole_text(f"`{text}`").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    n_rows = docs.count()
    n = max(12, -(-n_rows // ROWS_PER_BUCKET))
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(rows, n_rows, n))
    packed = rows.mapInPandas(deal(n, hot), PACKED)
    answers = packed.groupBy("bucket").applyInPandas(answer(n, hot), ANSWERS)
    return stored(answers.groupBy("part").applyInPandas(gather, DOCUMENTS))


def sketch(keys: np.ndarray) -> np.ndarray:
    """Parity of the shingles per bit: two sets differ in at least as many shingles as their sketches in bits."""
    at = (keys.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - SKETCH_BITS)
    odd = (np.bincount(at.astype(np.int64), minlength=1 << SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def postings_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        count = pdf["n_prefix"].to_numpy(dtype=np.int64)
        shingles = [np.frombuffer(s, dtype="<i8") for s in pdf["shingles"]]
        empty = np.zeros(0, dtype=np.int64)
        each = lambda x: np.repeat(np.asarray(x, dtype=np.int64), count)
        with np.errstate(over="ignore"):
            sketches = np.stack([sketch(s) for s in shingles]) if len(shingles) else np.zeros((0, SKETCH_WORDS), dtype=np.int64)
        yield pd.DataFrame({
            "key": np.concatenate([empty, *[s[:k] for s, k in zip(shingles, count)]]), "gid": each(pdf["gid"]), "n": each(pdf["n"]),
            "pos": np.concatenate([empty, *[np.arange(k) + lone for k, lone in zip(count, pdf["lone"])]]), "lone": each(pdf["lone"]),
            **{f"b{w}": each(sketches[:, w]) for w in range(SKETCH_WORDS)}})


SKETCHES = "cid long, gid long, n long, lone long, " + ", ".join(f"b{w} long" for w in range(SKETCH_WORDS))


def sketches_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Classes -> their sketches."""
    for pdf in batches:
        out = pdf[["cid", "gid", "n", "lone"]].copy()
        with np.errstate(over="ignore"):
            rows = [sketch(np.frombuffer(s, dtype="<i8")) for s in pdf["shingles"]]
        bits = np.stack(rows) if rows else np.zeros((0, SKETCH_WORDS), dtype=np.int64)
        yield out.assign(**{f"b{w}": bits[:, w] for w in range(SKETCH_WORDS)})


def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = []
        for x, y, m, n in zip(pdf["sa"], pdf["sb"], pdf["na"], pdf["nb"]):
            common = len(np.intersect1d(np.frombuffer(x, dtype="<i8"), np.frombuffer(y, dtype="<i8"), assume_unique=True))
            keep.append(100 * common >= 80 * (m + n - common))
        yield pdf.loc[np.array(keep, dtype=bool), ["a", "b"]]


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that link."""
    one = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("shingles").alias(f"s{x}"))
    return pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInPandas(linked, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes without an edge have no row.

    Alternating star steps (large, then small) until every node points at its root.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = stored(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        if now.select(F.col("v").alias("u")).distinct().join(now, "u", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (cid, gid, label) after ``edges`` between classes join their components."""
    at = lambda x: labels.select(F.col("cid").alias(x), F.col("label").alias(f"l{x}"))
    between = edges.join(at("a"), "a").join(at("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    roots = components(between)
    out = labels.join(roots, F.col("label") == F.col("node"), "left")
    return stored(out.select("cid", "gid", F.coalesce("root", "label").alias("label")))


def side(postings: DataFrame, s: str) -> DataFrame:
    return postings.select("key", *[F.col(c).alias(c + s) for c in SIDE])


def differing(groups: bool = False):
    """A lower bound of the shingles in which two sets differ: those of one document alone, and the sketches' different bits.

    Between groups, only bits on which all classes of either group agree count, so the bound holds for every pair of classes
    (size, ``lone`` and prefix are the same throughout a group).
    """
    bits = [F.col(f"b{w}1").bitwiseXOR(F.col(f"b{w}2")) for w in range(SKETCH_WORDS)]
    if groups:
        bits = [x.bitwiseAND(F.bitwise_not(F.col(f"m{w}1").bitwiseOR(F.col(f"m{w}2")))) for w, x in enumerate(bits)]
    bits = [F.bit_count(x) for x in bits]
    return sum(bits[1:], bits[0]) + F.col("lone1") + F.col("lone2")


def near_enough(groups: bool = False):
    """|A| + |B| must be at least nine times the difference."""
    return F.lit(9) * differing(groups) <= F.col("n1") + F.col("n2")


def fitting():
    """Lossless filters on two postings of one shingle: sizes; what is left of both sets from their first common shingle on must
    hold the overlap asked for."""
    n = F.col("n1") + F.col("n2")
    left = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    return (F.lit(5) * F.least("n1", "n2") >= F.lit(4) * F.greatest("n1", "n2")) & (F.lit(9) * left >= F.lit(4) * n)


def hub_pairs(postings: DataFrame, labels: DataFrame, round_: int) -> DataFrame:
    """Each class of a group with the representatives of the hub groups whose sketches are nearest."""
    leads = [F.min_by(F.struct(*SIDE), F.struct(F.xxhash64(F.lit(HUBS * round_ + i), F.col("gid")), "gid")) for i in range(HUBS)]
    hubs = postings.groupBy("key").agg(F.array(*leads).alias("hs"), F.count(F.lit(1)).alias("k")).where("k > 1")
    hubs = side(hubs.select("key", F.explode(F.array_distinct("hs")).alias("h")).select("key", "h.*"), "2")
    state = labels.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    of = lambda s: state.select(*[F.col(c).alias(c + s) for c in state.columns])
    # The sketches are the representatives': what they keep away from a round is left to the last join.
    met = side(postings, "1").join(hubs, "key").where((F.col("gid1") != F.col("gid2")) & fitting() & near_enough())
    near = met.groupBy("gid1", "gid2").agg(F.min(differing() / (F.col("n1") + F.col("n2"))).alias("apart"))
    near = near.join(of("1"), "gid1").join(of("2"), "gid2").where("low1 <> high1 or low2 <> high2 or low1 <> low2")
    # The last join looks at every pair; a round only needs the likeliest.
    best = near.groupBy("gid1").agg(F.slice(F.sort_array(F.collect_list(F.struct("apart", "gid2"))), 1, TRIES[round_]).alias("best"))
    best = best.select(F.col("gid1").alias("gid"), F.explode("best.gid2").alias("hub"))
    own = labels.where("cid <> gid").select(F.col("cid").alias("a"), F.col("gid").alias("b"))
    pairs = labels.join(best, "gid").select(F.col("cid").alias("a"), F.col("hub").alias("b")).unionAll(own)
    at = lambda x: labels.select(F.col("cid").alias(x), F.col("label").alias(f"l{x}"))
    return pairs.join(at("a"), "a").join(at("b"), "b").where("la <> lb").select("a", "b").distinct()


def remaining_pairs(postings: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """All pairs of classes in different components whose groups share a posting, under the filters."""
    members = labels.join(sketches, ["cid", "gid"])
    loose = [F.bit_or(f"b{w}").bitwiseXOR(F.bit_and(f"b{w}")).alias(f"m{w}") for w in range(SKETCH_WORDS)]
    state = members.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), *loose)
    p = postings.join(state, "gid")
    mixed = p.groupBy("key").agg(F.min("low").alias("_l"), F.max("high").alias("_h")).where("_l <> _h").select("key")
    p = p.join(mixed, "key", "left_semi")
    apart = (F.col("low1") != F.col("high1")) | (F.col("low2") != F.col("high2")) | (F.col("low1") != F.col("low2"))
    own = (*SIDE, "low", "high", *[f"m{w}" for w in range(SKETCH_WORDS)])
    both = lambda s: p.select("key", *[F.col(c).alias(c + s) for c in own])
    met = both("1").join(both("2"), "key").where((F.col("gid1") < F.col("gid2")) & apart & fitting() & near_enough(groups=True))
    groups = met.select("gid1", "gid2").distinct().unionAll(
        state.where("low <> high").select(F.col("gid").alias("gid1"), F.col("gid").alias("gid2")))
    member = lambda s: members.select(*[F.col(c).alias(c + s) for c in members.columns])
    pairs = groups.join(member("1"), "gid1").join(member("2"), "gid2").where((F.col("label1") != F.col("label2")) & near_enough())
    return pairs.select(F.least("cid1", "cid2").alias("a"), F.greatest("cid1", "cid2").alias("b")).distinct()


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, mark (xxhash64 of the text, a null being the empty one), n_shingles, component_id
    (smallest id that links reach), component (the same number for all rows that links reach, and for no others).

    Wordless rows link nothing; those that repeat id and text share a component number.
    """
    ship(docs.sparkSession)
    every = documents_with_shingles(docs, key, text)
    known = every.where(F.col("shingles").isNotNull())
    prefix = F.md5(F.substring("shingles", F.lit(1), F.col("n_prefix") * 8))
    classes = known.groupBy("n", "digest").agg(
        F.min("rid").alias("cid"), F.first("lone").alias("lone"), F.first("n_prefix").alias("n_prefix"), F.first("shingles").alias("shingles"))
    classes = classes.withColumn("_p", prefix)
    groups = classes.groupBy("n", "_p").agg(F.min("cid").alias("gid"))
    classes = stored(classes.join(groups, ["n", "_p"]).drop("_p"))
    postings = classes.where("cid = gid").select("gid", "n", "lone", "n_prefix", "shingles").mapInPandas(
        postings_of, POSTINGS)
    shared_keys = postings.groupBy("key").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("key")
    postings = stored(postings.join(shared_keys, "key", "left_semi"))
    labels = classes.select("cid", "gid", F.col("cid").alias("label"))
    for round_ in range(len(TRIES)):
        pairs = stored(hub_pairs(postings, labels, round_))
        if pairs.isEmpty():
            break
        labels = merged(labels, stored(verified(pairs, classes)))
    sketches = stored(classes.select("cid", "gid", "n", "lone", "shingles").mapInPandas(sketches_of, SKETCHES))
    pairs = stored(remaining_pairs(postings, labels, sketches))
    if not pairs.isEmpty():
        labels = merged(labels, stored(verified(pairs, classes)))
    placed = classes.select("n", "digest", "cid").join(labels.select("cid", "label"), "cid").select("n", "digest", "label")
    doc_id = F.when(~F.col("is_null"), F.col("doc_id"))
    members = known.withColumn("doc_id", doc_id).join(placed, ["n", "digest"])
    smallest = members.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked_rows = members.join(smallest, "label").select("rid", "doc_id", "mark", "n", "component_id", F.col("label").alias("component"))
    alone = every.where(F.col("shingles").isNull()).withColumn("doc_id", doc_id).select(
        "rid", "doc_id", "mark", "n", F.col("doc_id").alias("component_id"), F.col("rid").alias("component"))
    return linked_rows.unionAll(alone).withColumnRenamed("n", "n_shingles")


def op9_grouped_prefix_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``."""
    out = near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id")
