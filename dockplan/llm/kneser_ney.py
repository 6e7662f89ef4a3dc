"""Interpolated modified Kneser-Ney scoring (operator 3): bigrams counted in Spark, models memory-mapped by workers.

With D1, D2, D3+ the modified discounts of an order (from its counts of counts), T the number of different bigrams, and N1+(. w)
the number of different words before w:

    p(w | v) = (c(v w) - D) / c(v) + g(v) p(w)       g(v) = (D1 n1(v) + D2 n2(v) + D3 n3+(v)) / c(v)
    p(w)     = (N1+(. w) - D') / T + l / (V + 1)     l: what the D' leave, V: different tokens, 1 for all unknown ones

An unknown context backs off with weight 1. Texts are padded: a start before the first word (context only), an end after the last.

Building. Units of text are counted in place and packed by context bucket; a bucket sums its counts, keeps the statistics of
its contexts and writes one file of sorted arrays: context hashes, their counts and left-over masses, and the bigram keys
(context index, 40 bits of the word's hash) with their counts. Buckets pass on, per word, how many contexts they saw; word buckets
sum these into a second kind of file. Buckets are ranges of the hash, so files in order form one sorted array.

Scoring. A worker maps the files into memory (on a store without paths it copies them next to itself first) and looks up each unit's
tokens in hash order, so pages are read in order and shared by the workers of a machine. Nothing but counters and file names
comes to the driver; all sizes follow the corpus. Words are told apart by 64 bits of hash in contexts and counts, by
40 bits in bigrams and continuations.

Defined cases. A null text is the empty text: one token, the end. Null ids take part like the empty id text. Repeated rows count
and score each. Without training text every token has p = 1 / (V + 1) = 1. Texts are read whole. Empty tables give an empty result.
Other columns are kept by ``score``; columns it adds replace same-named ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import id_remainder, scratch_dir, ship, stored, table, whole_text, worker_cache
from dockplan.llm.mapped import map_arrays, open_fs, write_arrays

START, END = 1, 2  # codes below any word's
WORD_BITS = 40
UNIT_BYTES = 8_000_000
ROWS_PER_BUCKET = 5_000
MAX_BUCKETS = 20_000


# ---- tokens --------------------------------------------------------------------------------------------------


class Codes(dict):
    """64-bit codes by byte word."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = max(16, xxhash.xxh64_intdigest(word))
        return code


CODE_LIMIT = 700_000


def word_codes(words: list[bytes]) -> np.ndarray:
    """Codes by one table per worker; about ``CODE_LIMIT`` words are remembered."""
    codes = worker_cache("kneser_ney", Codes)
    if len(codes) > CODE_LIMIT:
        codes.clear()
    return np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=len(words))


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts end to end, the token before each, and the bounds of the texts."""
    raw = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
    ends = np.cumsum(sizes)
    w = np.full(int(ends[-1]) if len(ends) else 0, END, dtype=np.uint64)
    is_word = np.ones(len(w), dtype=bool)
    is_word[ends - 1] = False
    w[is_word] = word_codes([x for r in raw for x in r])
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[ends - sizes] = START
    return w, v, np.concatenate([[0], ends])


def units(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= UNIT_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def short(w: np.ndarray) -> np.ndarray:
    return w & np.uint64((1 << WORD_BITS) - 1)


def bucket_of(h: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Range of the hash: a monotone function of it, so buckets in order are sorted."""
    return ((h >> np.uint64(bits - 32)) * np.uint64(n)) >> np.uint64(32)


def runs(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of a sorted array."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)


def pack40(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack40(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


# ---- counting ------------------------------------------------------------------------------------------------

PAIRS = "bucket long, v binary, n binary, w binary, c binary"


def count_units(n_buckets: int):
    """Training texts -> per unit and context bucket: contexts, their numbers of different words, words, counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, z in units(texts):
                w, v, _ = tokens(texts[a:z])
                w = short(w)
                order = np.lexsort((w, v))
                v, w = v[order], w[order]
                at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
                c = np.diff(np.append(at, len(v))).astype("<u4")
                v, w = v[at], w[at]
                cuts = np.searchsorted(bucket_of(v, 64, n_buckets), np.arange(n_buckets + 1))
                rows = []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    s = slice(cuts[b], cuts[b + 1])
                    first = runs(v[s])
                    size = np.diff(np.append(first, cuts[b + 1] - cuts[b])).astype("<u4")
                    rows.append((b, v[s][first].tobytes(), size.tobytes(), pack40(w[s]), c[s].tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "v", "n", "w", "c"])

    return run


CONTEXT_KINDS = ["<u8", "<u8", "<u4", "<u4", "<u4", "<u8", "<u4"]  # v, c(v), n1, n2, n3+, bigram keys, counts
SUMMARY = "kind string, bucket long, file string, first_bucket long, words binary, contexts binary, sums binary"


def sum_bucket(root: str, n_buckets: int):
    """One context bucket -> its file, its counts of counts, and per word bucket the words with their numbers of contexts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.repeat(np.frombuffer(b"".join(pdf["v"]), dtype="<u8"), np.frombuffer(b"".join(pdf["n"]), dtype="<u4"))
        w = np.concatenate([unpack40(x) for x in pdf["w"]])
        c = np.frombuffer(b"".join(pdf["c"]), dtype="<u4").astype(np.int64)
        order = np.lexsort((w, v))
        v, w, c = v[order], w[order], c[order]
        at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
        c, v, w = np.add.reduceat(c, at), v[at], w[at]
        first = runs(v)
        index = np.repeat(np.arange(len(first), dtype=np.uint64), np.diff(np.append(first, len(v))))
        of = lambda x: np.add.reduceat(x.astype(np.int64), first)
        ns = [of(c == 1), of(c == 2), of(c >= 3)]
        bucket = int(pdf["bucket"].iloc[0])
        name = write_arrays(root, "contexts", [v[first].astype("<u8"), of(c).astype("<u8"), *[n.astype("<u4") for n in ns],
                                               (index << np.uint64(WORD_BITS)) | w, np.minimum(c, 0xFFFFFFFF).astype("<u4")])
        known = int(np.sum(v[first] >= 16))
        sums = np.array([*[np.sum(c == k) for k in (1, 2, 3, 4)], known, c.sum()], dtype="<i8")
        words, contexts = np.unique(w, return_counts=True)
        rows = [("file", bucket, name, bucket, b"", b"", sums.tobytes())]
        home = bucket_of(words, WORD_BITS, n_buckets).astype(np.int64)
        cuts = np.searchsorted(home, np.arange(n_buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            s = slice(cuts[b], cuts[b + 1])
            rows.append(("words", b, name, bucket, pack40(words[s]), contexts[s].astype("<u4").tobytes(), b""))
        return pd.DataFrame(rows, columns=["kind", "bucket", "file", "first_bucket", "words", "contexts", "sums"])

    return run


def sum_words(root: str):
    """One word bucket -> its file of continuation counts, and their counts of counts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w = np.concatenate([unpack40(x) for x in pdf["words"]])
        n = np.frombuffer(b"".join(pdf["contexts"]), dtype="<u4").astype(np.int64)
        order = np.argsort(w, kind="stable")
        w, n = w[order], n[order]
        at = runs(w)
        n, w = np.add.reduceat(n, at), w[at]
        sums = np.array([*[np.sum(n == k) for k in (1, 2, 3, 4)], len(n), n.sum(), np.sum(n >= 3)], dtype="<i8")
        name = write_arrays(root, "words", [w.astype("<u8"), n.astype("<u8")])
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "file": [name], "sums": [sums.tobytes()]})

    return run


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams with counts 1 to 4; fixed ones where the corpus is too small for them."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.01), k + 0.99) for k, x in enumerate(d))


@dataclass(frozen=True)
class Model:
    """Where the files are, and the numbers they share. File names are one per bucket."""

    root: str
    n_buckets: int
    contexts: dict[int, str]
    words: dict[int, str]
    d: tuple[float, float, float]
    d_low: tuple[float, float, float]
    train_tokens: int
    n_pairs: int
    n_types: int
    left: float
    n_docs: int
    n_words: int


def build(docs: DataFrame, text: str = "text", root: str | None = None) -> Model:
    """Count the texts of ``docs`` and write the model under ``root`` (a URI; default: the shared scratch folder)."""
    spark = docs.sparkSession
    ship(spark)
    root = root or f"{scratch_dir(spark)}/kneser-ney-{uuid.uuid4().hex}"
    fs, folder = open_fs(root)
    fs.create_dir(folder, recursive=True)
    rows = docs.select(whole_text(f"`{text}`").alias("text"))
    n_docs = rows.count()
    n = min(MAX_BUCKETS, max(12, -(-n_docs // ROWS_PER_BUCKET)))
    summed = stored(rows.mapInPandas(count_units(n), PAIRS).groupBy("bucket").applyInPandas(sum_bucket(root, n), SUMMARY))
    words = stored(summed.where("kind = 'words'").select("bucket", "words", "contexts")
                   .groupBy("bucket").applyInPandas(sum_words(root), "bucket long, file string, sums binary"))
    # One row per file: names and a few counts.
    first, second = summed.where("kind = 'file'").select("bucket", "file", "sums").collect(), words.collect()
    add = lambda rs, k: np.sum([np.zeros(k, dtype=np.int64), *[np.frombuffer(r["sums"], "<i8") for r in rs]], axis=0)
    high, low = add(first, 6), add(second, 7)
    d, d_low = discounts(high), discounts(low)
    pairs, types = int(low[5]), int(low[4])
    left = float(d_low[0] * low[0] + d_low[1] * low[1] + d_low[2] * low[6]) / pairs if pairs else 1.0
    return Model(root, n, {r["bucket"]: r["file"] for r in first}, {r["bucket"]: r["file"] for r in second}, d, d_low,
                 int(high[5]), pairs, types, left, n_docs, int(high[4]))


# ---- scoring -------------------------------------------------------------------------------------------------


def stepped(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(n == 0, 0.0, np.where(n == 1, d[0], np.where(n == 2, d[1], d[2])))


def found(sorted_keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each query, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(q), dtype=np.int64), np.zeros(len(q), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, q), len(sorted_keys) - 1)
    return at, sorted_keys[at] == q


class Scorer:
    """The mapped model in a worker."""

    def __init__(self, model: Model):
        self.m = model
        self.files: dict[tuple[str, int], list[np.ndarray]] = {}

    def arrays(self, kind: str, bucket: int) -> list[np.ndarray] | None:
        if (kind, bucket) not in self.files:
            kinds = CONTEXT_KINDS if kind == "contexts" else ["<u8", "<u8"]
            name = getattr(self.m, kind).get(bucket)
            self.files[kind, bucket] = map_arrays(self.m.root, name, kinds) if name else None
        return self.files[kind, bucket]

    def by_bucket(self, kind: str, keys: np.ndarray, bits: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Slices of sorted keys with the arrays of their bucket."""
        bucket = bucket_of(keys, bits, self.m.n_buckets).astype(np.int64)
        first = runs(bucket)
        for a, z in zip(first.tolist(), np.append(first[1:], len(keys)).tolist()):
            got = self.arrays(kind, int(bucket[a]))
            if got is not None:
                yield slice(a, z), got

    def low(self, w: np.ndarray) -> np.ndarray:
        """p(w) of sorted 40-bit words."""
        m = self.m
        n = np.zeros(len(w), dtype=np.int64)
        for s, (keys, contexts) in self.by_bucket("words", w, WORD_BITS):
            at, ok = found(keys, w[s])
            n[s] = np.where(ok, contexts[at].astype(np.int64), 0)
        return (n - stepped(n, m.d_low)) / max(1, m.n_pairs) + m.left / (m.n_types + 1)

    def tokens(self, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p of each token after the one before it, and each token's own count in training."""
        m = self.m
        unique, place = np.unique(short(w), return_inverse=True)
        low = self.low(unique)[place]
        order = np.lexsort((short(w), v))
        sv, sw, p = v[order], short(w)[order], low[order]
        for s, (keys, count, n1, n2, n3, pairs, c) in self.by_bucket("contexts", sv, 64):
            at, known = found(keys, sv[s])
            pair, seen = found(pairs, (at.astype(np.uint64) << np.uint64(WORD_BITS)) | sw[s])
            k = np.where(seen & known, c[pair].astype(np.int64), 0)
            total = np.maximum(count[at].astype(np.float64), 1)
            mass = n1[at] * m.d[0] + n2[at] * m.d[1] + n3[at] * m.d[2]
            p[s] = np.where(known, (k - stepped(k, m.d) + mass * p[s]) / total, p[s])
        out = np.empty(len(w))
        out[order] = np.log10(p)
        return out, self.counts(w)

    def counts(self, w: np.ndarray) -> np.ndarray:
        """Training counts: a word is a context as often as it occurs; ends occur once per text."""
        unique, place = np.unique(w, return_inverse=True)
        n = np.zeros(len(unique), dtype=np.int64)
        for s, got in self.by_bucket("contexts", unique, 64):
            at, ok = found(got[0], unique[s])
            n[s] = np.where(ok, got[1][at].astype(np.int64), 0)
        n[unique == END] = self.m.n_docs
        return n[place]


ADDED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, with the token counts, the add-one unigram score and the model's score of each text."""
    ship(df.sparkSession)
    added = [c.split()[0] for c in ADDED.split(", ")]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        m = scorer.m
        for pdf in batches:
            texts = pdf["_t"].tolist()
            for a, z in units(texts):
                w, v, bounds = tokens(texts[a:z])
                logs, counts = scorer.tokens(w, v)
                # V of the base: the different words, told apart by 64 bits, and the end.
                base = np.log10((counts + 1) / (m.train_tokens + m.n_words + bool(m.n_docs) + 1))
                total = lambda x: np.add.reduceat(x, bounds[:-1]) if len(x) else x
                yield pdf.iloc[a:z].drop(columns="_t").assign(
                    n_tokens=np.diff(bounds), n_known=total((counts > 0).astype(np.int64)), train_tokens=m.train_tokens,
                    base_score=total(base), score=total(logs))

    names = [c for c in df.columns if c != text and c not in added]
    source = df.select(*[F.col(f"`{c}`") for c in names], whole_text(f"`{text}`").alias("_t"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInPandas(run, kept + ADDED)


def op3_kneser_ney_scores(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by a model of those whose id remainder is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (id_remainder("doc_id", 7) == 2).alias("held_out"), "text")
    model = build(docs.where(~F.col("held_out")))
    return score(docs, model).select("doc_id", "held_out", *[c.split()[0] for c in ADDED.split(", ")])
