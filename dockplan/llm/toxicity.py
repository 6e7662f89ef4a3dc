"""Toxicity by class-conditional Kneser-Ney models (operator 5).

Two interpolated modified Kneser-Ney models, one of toxic and one of ordinary training texts, spell words: a character is
predicted from all characters of its word before it (up to ``ORDER``), so insults, their inflections and their stems count,
in any language. A run of letters longer than ``ORDER`` (a compound, a text run together, a script without spaces) is spelled
from each of its characters on, so every part of it is counted and scored, whatever stands before it. Both classes back off to one shared distribution, the continuation counts of both together (the number of
different words that go on with the character), so rare words that neither class has evidence for decide nothing.
With c in {toxic, ordinary} and h the word so far:

    p_c(x | h) = (c_c(h x) - D) / c_c(h) + l_c(h) s(x | h)        s(x | h) = words(h x) / words(h)

A word's log-likelihood ratio is the sum along its spelling; after the last known character, only the ratio of the
back-off weights remains. A word counts once per text. A text's evidence is, for each of ``WIDTHS``, the largest length-normalised ratio over
its windows of so many words (the whole text if it is shorter): a long text is as toxic as its most toxic passage. A
logistic curve, fitted on training rows that counted nothing, turns evidence into a score.

Bound: counting takes at most ``max_count_rows`` labelled rows and the curve at most ``max_curve_rows``, those with the smallest
id hashes (both documented parameters); spellings in fewer than ``smallest`` of them are left out of the model, a file of sorted
hash arrays that workers map into memory. Scoring covers every text and is one pass without a shuffle.

Defined cases. A null text is the empty text; a text without words has evidence 0. Null labels and null ids train nothing; a
document with several labels is toxic if any is. Without both classes in the training rows,
or without a spelling frequent enough, all scores are 0. Repeated
rows score alike. Empty tables give empty results. Other columns are kept; columns it adds replace same-named ones.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import frugal, id_remainder, scratch_dir, ship, stored, table, trim, whole_text, worker_cache
from dockplan.llm.mapped import map_arrays, open_fs, write_arrays

WORD = r"[^\W_]+"
WIDTHS = (1, 4, 16)
THRESHOLD = 0.7
ORDER = 16  # longest spelling, in characters
END = "_"  # closes a word; no word holds it
MAX_COUNT_ROWS = 20_000
MAX_CURVE_ROWS = 8_000
TEXTS = 256  # that are split into words at a time


def spelling_hash(prefix: str) -> int:
    """What ``xxhash64`` gives in SQL, unsigned."""
    return xxhash.xxh64_intdigest(prefix.encode("utf-8", "surrogatepass"), seed=42)


def spellings(word: str) -> list[str]:
    """The word's beginnings, the last one closed by ``END`` unless the order cuts it."""
    closed = (word + END)[:ORDER]
    return [closed[:k] for k in range(1, len(closed) + 1)]


@dataclass(frozen=True)
class Model:
    """Where the file of sorted hash arrays is, and the ratio of leaving the known spellings at once.

    Per known spelling: its hash, the ratio up to it, and the ratio of leaving the known spellings there.
    """

    folder: str
    file: str
    root: float

    def arrays(self) -> list[np.ndarray]:
        return map_arrays(self.folder, self.file, ["<u8", "<f4", "<f4"])

    def ratio(self, word: str) -> float:
        keys, upto, leave = self.arrays()
        hashes = np.array([spelling_hash(x) for x in spellings(word)], dtype=np.uint64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = keys[at] == hashes
        depth = len(hit) if hit.all() else int(np.argmin(hit))
        if not depth:
            return self.root
        last = at[depth - 1]
        return float(upto[last] + (0.0 if depth == len(hit) else leave[last]))


class WordRatios:
    """Ratios of words; at most ``limit`` of them remembered by a worker."""

    def __init__(self, model: Model, limit: int = 250_000):
        self.model, self.limit, self.known = model, limit, {}
        self.arrays = model.arrays()

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known = {}
        new = list({w for w in words if w not in self.known})
        if new:
            self.known.update(zip(new, self._new(new)))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.float64, count=len(words))

    def _new(self, words: list[str]) -> list[float]:
        """All words one character further at a time, dropping those whose spelling is unknown."""
        keys, upto, leave = self.arrays
        out = np.full(len(words), self.model.root)
        closed = [(w + END)[:ORDER] for w in words]
        todo = np.arange(len(words))
        for k in range(1, ORDER + 1):
            todo = todo[[len(closed[i]) >= k for i in todo.tolist()]]
            if not len(todo):
                break
            h = np.fromiter((spelling_hash(closed[i][:k]) for i in todo.tolist()), dtype=np.uint64, count=len(todo))
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            todo, at = todo[hit], at[hit]
            done = np.fromiter((len(closed[i]) == k for i in todo.tolist()), dtype=bool, count=len(todo))
            out[todo] = upto[at] + np.where(done, 0.0, leave[at])
        return out.tolist()


def words_of(text: str) -> list[str]:
    """The words, and in place of one longer than ``ORDER`` its pieces of so many characters from each character on."""
    words = re.findall(WORD, text.lower())
    if not any(len(w) > ORDER for w in words):
        return words
    return [p for w in words for p in ([w] if len(w) <= ORDER else [w[k : k + ORDER] for k in range(len(w))])]


def evidence(ratios: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the largest mean ratio over its windows of each width."""
    total = np.concatenate([[0.0], np.cumsum(ratios)])
    out = np.zeros((len(bounds) - 1, len(WIDTHS)))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            for j, width in enumerate(WIDTHS):
                k = min(width, b - a)
                out[i, j] = (total[a + k : b + 1] - total[a : b + 1 - k]).max() / k
    return out


def training_rows(docs: DataFrame, labels: DataFrame, max_count_rows: int, max_curve_rows: int) -> DataFrame:
    """(text, toxic, part) of the bounded samples; part 1 counts, part 0 fits the curve."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_remainder("doc_id", 3) != 1))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("part", (F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), F.lit(4)) != 0).cast("int"))
    rank = F.xxhash64(F.lit(7), F.col("doc_id"))
    picked = known.where("part = 1").orderBy(rank, "doc_id").limit(max_count_rows).unionAll(
        known.where("part = 0").orderBy(rank, "doc_id").limit(max_curve_rows))
    # At most max_count_rows + max_curve_rows rows of three numbers.
    return docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id").select("text", "toxic", "part")


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words with the numbers of toxic and ordinary texts that hold them."""
    for pdf in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for toxic, text in zip(pdf["toxic"], pdf["text"]):
            counts[int(toxic > 0)].update({w[:ORDER] for w in words_of(text)})
        for toxic, c in counts.items():
            if not c:
                continue
            n = np.fromiter(c.values(), dtype=np.int64, count=len(c))
            yield pd.DataFrame({"word": list(c), "toxic": n * toxic, "ordinary": n * (1 - toxic)})


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """D for counts 1, 2 and 3 or more, from the numbers of n-grams seen 1 to 4 times."""
    n = [counts.get(k, 0) for k in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return 0.5, 0.75, 1.0
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else k + 0.5 for k in range(3)]
    return tuple(min(max(x, 0.05), k + 0.98) for k, x in enumerate(d))


def discount_of(c, d: tuple[float, float, float]):
    return F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def fit(rows: DataFrame, smallest: int = 3) -> Model | None:
    """The model of counting rows; None without both classes or known spellings. Sums run in Spark."""
    classes = ("toxic", "ordinary")
    words = rows.mapInPandas(count_words, "word string, toxic long, ordinary long")
    words = words.groupBy("word").agg(*[F.sum(c).alias(c) for c in classes])
    closed = F.substring(F.concat("word", F.lit(END)), 1, ORDER)
    steps = words.select(*classes, closed.alias("_c")).select(
        *classes, "_c", F.explode(F.sequence(F.lit(1), F.length("_c"))).alias("_k"))
    nodes = steps.groupBy(F.expr("substring(_c, 1, _k)").alias("node")).agg(*[F.sum(c).alias(c) for c in classes], F.count(F.lit(1)).alias("words"))
    nodes = stored(nodes.withColumn("parent", F.expr("substring(node, 1, length(node) - 1)")))
    sums = nodes.where("parent = ''").agg(*[F.sum(c) for c in classes]).first()
    if not sums[0] or not sums[1]:
        return None
    d = {c: discounts({r[0]: r[1] for r in nodes.where(F.col(c).between(1, 4)).groupBy(c).count().collect()}) for c in classes}
    inner = nodes.groupBy("parent").agg(
        F.sum("words").alias("_words"), *[F.sum(c).alias(f"n_{c}") for c in classes],
        *[F.sum(discount_of(F.col(c), d[c])).alias(f"l_{c}") for c in classes])
    left = {c: F.when(F.col(f"n_{c}") > 0, F.col(f"l_{c}") / F.col(f"n_{c}")).otherwise(1.0) for c in classes}
    inner = inner.select("parent", "_words", *[F.col(f"n_{c}") for c in classes], *[left[c].alias(f"l_{c}") for c in classes])
    shared = F.col("words") / F.col("_words")
    p = {c: F.when(F.col(f"n_{c}") > 0, (F.col(c) - discount_of(F.col(c), d[c])) / F.col(f"n_{c}")).otherwise(0.0)
         + F.col(f"l_{c}") * shared for c in classes}
    leave = F.log(F.col("l_toxic") / F.col("l_ordinary"))
    known = nodes.where(F.col("toxic") + F.col("ordinary") >= smallest).join(inner, "parent")
    known = known.select("node", F.xxhash64("node").alias("key"), (F.log(p["toxic"]) - F.log(p["ordinary"])).alias("step"))
    onward = inner.select(F.xxhash64("parent").alias("key"), leave.alias("leave"))
    known = stored(known.join(onward, "key", "left"))
    # Every beginning of a known spelling is known, so the sums along the spellings are one join.
    parts = known.select("key", F.explode(F.expr("transform(sequence(1, length(node)), k -> xxhash64(substring(node, 1, k)))")).alias("part"))
    sums = parts.join(known.select(F.col("key").alias("part"), "step"), "part").groupBy("key").agg(F.sum("step").alias("upto"))
    table = sums.join(known.select("key", "leave"), "key").select(
        "key", F.col("upto").cast("float").alias("upto"), F.coalesce("leave", F.lit(0.0)).cast("float").alias("leave"))
    folder = f"{scratch_dir(rows.sparkSession)}/toxicity-{uuid.uuid4().hex}"
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    # Bounded by the counting rows, so one task may write it; it never passes through the driver.
    written = stored(table.repartition(1).mapInPandas(write_model(folder), "file string")).first()
    return written and Model(folder, written["file"], float(inner.where("parent = ''").select(leave).first()[0]))


def write_model(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(p["key"].to_numpy(np.int64), p["upto"].to_numpy(np.float32), p["leave"].to_numpy(np.float32)) for p in batches]
        if not parts or not sum(len(x[0]) for x in parts):
            return
        keys, upto, leave = (np.concatenate(x) for x in zip(*parts))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        yield pd.DataFrame({"file": [write_arrays(folder, "spellings", [keys[order], upto[order], leave[order]])]})

    return run


def with_evidence(df: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` with ``evidence``, without the text unless it is kept (a null one as it was)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frugal()
        ratios = worker_cache(("toxicity", model.file), lambda: WordRatios(model))
        for pdf in batches:
            for k in range(0, len(pdf), TEXTS):
                part = pdf.iloc[k : k + TEXTS]
                found = [words_of(t) if t else [] for t in part["_t"].tolist()]
                bounds = np.cumsum([0, *map(len, found)])
                rest = part.rename(columns={"_t": text}) if keep_text else part.drop(columns="_t")
                yield rest.assign(evidence=list(evidence(ratios([w for f in found for w in f]), bounds)))
        trim()

    names = [f.name for f in df.schema.fields if f.name not in ("evidence", text)]
    source = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("string").alias("_t"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInPandas(run, f"{kept}{f'`{text}` string, ' if keep_text else ''}evidence array<double>")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights (offset last) of P(y = 1 | x), by damped Newton steps; the offset is not shrunk."""
    design = np.column_stack([x, np.ones(len(x))])
    shrink = np.diag([ridge] * x.shape[1] + [1e-6])
    b = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + shrink
        step = np.linalg.solve(h, design.T @ (y - p) - shrink @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return b


class ToxicityScorer:
    """A fitted model with its curve."""

    def __init__(self, spark, docs: DataFrame, labels: DataFrame, max_count_rows: int = MAX_COUNT_ROWS,
                 max_curve_rows: int = MAX_CURVE_ROWS):
        ship(spark)
        rows = training_rows(docs, labels, max_count_rows, max_curve_rows)
        self.model = fit(rows.where("part = 1").select("text", "toxic"))
        self.curve = [0.0] * (len(WIDTHS) + 1)
        if self.model is not None:
            got = with_evidence(rows.where("part = 0").select("toxic", "text"), self.model).toPandas()
            if len(got):
                self.curve = logistic(np.stack(got["evidence"].to_list()), got["toxic"].to_numpy(dtype=float)).tolist()

    def score(self, keys: DataFrame, keep_text: bool = False) -> DataFrame:
        """Rows of ``keys``, without their text unless it is kept, with ``evidence``, ``score`` and ``predicted``."""
        if self.model is None:
            out = keys.drop("evidence", *[] if keep_text else ["text"]).withColumn("evidence", F.array().cast("array<double>")).withColumn("score", F.lit(0.0))
        else:
            logit = F.lit(self.curve[-1])
            for k, a in enumerate(self.curve[:-1]):
                logit = logit + F.get("evidence", F.lit(k)) * F.lit(a)
            out = with_evidence(keys, self.model, keep_text=keep_text).withColumn("score", 1 / (1 + F.exp(-logit)))
        return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_kneser_ney_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, trained on ``labels``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = ToxicityScorer(spark, docs, labels)
    out = scorer.score(docs.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "text"))
    return out.select("doc_id", "held_out", "score", "predicted", "evidence")
