"""Spelling variants: range searches in k-d trees over letter-count vectors (operator 11).

Words that differ by one inserted, deleted or replaced code point have letter counts at L1 distance two at most: a replaced letter
takes one count down by one and another up by one, an inserted one takes one count up. So the near words of a word lie in a small
box around its counts, once among the words of its own length and once among those one letter longer (one letter shorter is the
same search from the other side). Per length pair, a k-d tree over the counts prunes whole boxes; the words that are left are
verified letter by letter.

The tree has two storeys. Planes of the upper one come from a sample of about ``SAMPLE_WORDS`` words of at most ``SAMPLE_LETTERS``
letters, those whose hash is below a threshold; they only decide how words are dealt, never which pairs are found. Every word is dealt to the one box of its length that
holds it, and as a probe to every box of both lengths within reach. In a box, the words' own tree has the lower storey. A box with
more than ``BOX_WORDS`` words or ``BOX_PROBES`` probes is dealt in blocks that all meet, so no task holds an unbounded box, and
lengths that the sample lacks are one box each, dealt in the same way.

In the lowest boxes letter counts are compared as one product: written in unary, two vectors' dot product is the size of their
common multiset of letters, which is the length less one for a replaced letter and the shorter length for an inserted one.

Words are counted with partial aggregates, so a word that a third of the text consists of is one row a task. A near word is
chosen by an aggregate too. Roots follow forms by pointer doubling over the words that have a form, a written table a round; a form
has at least ``RATIO`` times its word's count, so there are no cycles and few rounds.

Defined cases. A null or empty text has no words; a null id counts as the empty text in the checksum of a run. Repeated rows count
again. Ties between forms go to the smallest word in code-point order. Other columns take no part, whatever their names. An empty
table gives an empty result. Words may have any length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import by_hash, lower_ascii, ship, stored, table

#: Fixed values of the contract: the runs that are words, and which of them lose a letter.
LETTERS = r"[A-Za-zÀ-ÿ]"
DAMAGE = 199
SHORTEST, FEWEST, RATIO = 6, 5, 5

SAMPLE_WORDS, SAMPLE_LETTERS = 100_000, 64
BOX_WORDS, BOX_PROBES, LEAF_WORDS = 4_000, 50_000, 128
SAMPLE_A_BOX = 32

#: Dimensions of a letter vector: a to z, then U+00C0 to U+00FF.
DIMENSIONS = 26 + 64


def count_words(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the runs of letters, in lower case, after the rule that takes a letter out of some."""
    # A maximal run of fewer letters has no match, and can only get shorter.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))).alias("run"))
    runs = runs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("at"), lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat("at", "run").cast("binary"))
    cut = (h % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), cut), F.substr("run", cut + 2))
    words = runs.select(F.when(h % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


def code_points(words) -> np.ndarray:
    """Code points of words of one length, a row each."""
    a = np.asarray(words, dtype=str)
    return a.view(np.uint32).reshape(len(a), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    dims = np.where(codes >= 0xC0, codes - 0xC0 + 26, codes - ord("a")).astype(np.int64)
    at = (np.arange(len(codes))[:, None] * DIMENSIONS + dims).ravel()
    return np.bincount(at, minlength=len(codes) * DIMENSIONS).reshape(len(codes), DIMENSIONS).astype(np.int32)


class Tree:
    """A k-d tree over letter counts; boxes are numbered 0, 1, 2, ..."""

    def __init__(self, counts: np.ndarray, size: int):
        # A node is (dimension, cut, left, right), a box its number alone. Counts up to the cut go left.
        self.boxes = 0
        self.top = self._grow(counts, np.arange(len(counts)), size)

    def _grow(self, counts, rows, size):
        if len(rows) > size:
            here = counts[rows]
            dim = int(here.var(axis=0).argmax())
            values = np.sort(here[:, dim])
            if values[0] < values[-1]:
                middle = values[len(values) // 2]
                # The cut nearest to the middle that leaves something on both sides.
                below = np.searchsorted(values, middle)
                above = np.searchsorted(values, middle, "right")
                cut = int(middle) if above < len(values) and (below == 0 or abs(2 * above - len(values)) <= abs(2 * below - len(values))) \
                    else int(values[below - 1])
                left = here[:, dim] <= cut
                return dim, cut, self._grow(counts, rows[left], size), self._grow(counts, rows[~left], size)
        self.boxes += 1
        return self.boxes - 1

    def search(self, counts: np.ndarray, up: int, down: int):
        """(box, rows) for every box that holds vectors with at most ``up`` counts more and ``down`` counts fewer than a row."""
        every = np.arange(len(counts))
        high = np.full(DIMENSIONS, np.iinfo(np.int32).max, dtype=np.int64)
        low = np.zeros(DIMENSIONS, dtype=np.int64)
        yield from self._search(self.top, counts, every, np.full(len(counts), up), np.full(len(counts), down), low, high)

    def _search(self, node, counts, rows, up, down, low, high):
        if not len(rows):
            return
        if isinstance(node, int):
            yield node, rows
            return
        dim, cut, left, right = node
        q = counts[rows, dim]
        # What a row has above the cut, beyond what it already had above this box, a vector to the left has fewer; and so to the right.
        fewer = down - np.maximum(q - cut, 0) + np.maximum(q - high[dim], 0)
        more = up - np.maximum(cut + 1 - q, 0) + np.maximum(low[dim] - q, 0)
        keep, old = fewer >= 0, high[dim]
        high[dim] = cut
        yield from self._search(left, counts, rows[keep], up[keep], fewer[keep], low, high)
        high[dim] = old
        keep, old = more >= 0, low[dim]
        low[dim] = cut + 1
        yield from self._search(right, counts, rows[keep], more[keep], down[keep], low, high)
        low[dim] = old


def common_letters(counts: np.ndarray, columns: int = 4096):
    """A function of other counts and rows of ``counts``: how many letters each pair shares.

    Counts are written in unary, a column for every time that a letter may count; words so long that this takes too many columns
    are compared row by row.
    """
    most = counts.max(axis=0)

    def ones(c):
        return np.stack([c[:, d] >= t for d in np.flatnonzero(most) for t in range(1, most[d] + 1)], axis=1).astype(np.float32)

    if most.sum() > columns:
        return lambda sought, rows: np.stack([np.minimum(q, counts[rows]).sum(axis=1) for q in sought])
    held = ones(counts)
    return lambda sought, rows: ones(sought) @ held[rows].T


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words (code points, pairwise rows) of equal length, or the second one letter longer, are one edit apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same = np.cumprod(a == b[:, :-1], axis=1).sum(axis=1)
    return same + np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1) >= a.shape[1]


def near_pairs(words: np.ndarray, probes: np.ndarray):
    """Row numbers (probe, word) of the pairs one edit apart; words of one length, probes of that length or one less."""
    held, asked = code_points(words), code_points(probes)
    counts, sought = letter_counts(held), letter_counts(asked)
    longer = held.shape[1] - asked.shape[1]
    shared = asked.shape[1] if longer else asked.shape[1] - 1
    tree = Tree(counts, LEAF_WORDS)
    box = np.empty(len(counts), dtype=np.int64)
    for b, rows in tree.search(counts, 0, 0):
        box[rows] = b
    order = np.argsort(box, kind="stable")
    starts = np.searchsorted(box[order], np.arange(tree.boxes + 1))
    common = common_letters(counts)
    found_probe, found_word = [], []
    for b, rows in tree.search(sought, 1, 0 if longer else 1):
        inside = order[starts[b] : starts[b + 1]]
        for part in np.array_split(rows, -(-len(rows) // 4096)):
            p, w = np.nonzero(common(sought[part], inside) == shared)
            if len(p):
                p, w = part[p], inside[w]
                right = one_edit(asked[p], held[w])
                found_probe.append(p[right])
                found_word.append(w[right])
    if not found_probe:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(found_probe), np.concatenate(found_word)


def joined(batches, letters: int = 500_000):
    """Batches of words, put together until they have that many letters."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["word"].str.len().sum())
        if size >= letters:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def near_words(words: DataFrame, sample_words: int = SAMPLE_WORDS, box_words: int = BOX_WORDS, box_probes: int = BOX_PROBES) -> DataFrame:
    """(word, near, near_n) for every ordered pair of different words of (word, n) that are one edit apart."""
    spark = words.sparkSession
    ship(spark)
    share = min(1.0, sample_words / max(1, words.count()))
    short = words.where(F.char_length("word") <= SAMPLE_LETTERS).select("word")
    sample = [r[0] for r in by_hash(short, "word", share).collect()]
    size = max(SAMPLE_A_BOX, int(box_words * share))
    trees: dict[int, Tree] = {}
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    first: dict[int, int] = {}
    used = 0
    for length in sorted(by_length):
        trees[length] = Tree(letter_counts(code_points(by_length[length])), size)
        first[length], used = used, used + trees[length].boxes

    def boxes_of(counts, length, up, down):
        if length not in trees:
            yield -length, np.arange(len(counts))
            return
        for b, rows in trees[length].search(counts, up, down):
            yield first[length] + b, rows

    def deal(batches):
        for batch in joined(batches):
            lengths = batch["word"].str.len().to_numpy()
            rows, box, probe = [], [], []
            for length in np.unique(lengths).tolist():
                here = np.flatnonzero(lengths == length)
                counts = letter_counts(code_points(batch["word"].to_numpy()[here]))
                for asks, at, up, down in ((False, length, 0, 0), (True, length, 1, 1), (True, length + 1, 1, 0)):
                    for b, found in boxes_of(counts, at, up, down):
                        rows.append(here[found])
                        box.append(np.full(len(found), b))
                        probe.append(np.full(len(found), asks))
            out = batch.iloc[np.concatenate(rows)]
            yield pd.DataFrame({"box": np.concatenate(box), "probe": np.concatenate(probe), "word": out["word"].to_numpy(), "n": out["n"].to_numpy()})

    dealt = stored(words.mapInPandas(deal, "box long, probe boolean, word string, n long"))
    full = dealt.groupBy("box").agg(F.count_if(~F.col("probe")).alias("_w"), F.count_if("probe").alias("_p")).where("_w > 0 and _p > 0")
    full = full.select("box", F.ceil(F.col("_w") / box_words).cast("int").alias("_wb"), F.ceil(F.col("_p") / box_probes).cast("int").alias("_pb"))
    met = dealt.join(full, "box")
    h = F.xxhash64("word")
    own = F.array(F.pmod(h, F.when(F.col("probe"), F.col("_pb")).otherwise(F.col("_wb"))).cast("int"))
    all_of = F.sequence(F.lit(0), F.when(F.col("probe"), F.col("_wb")).otherwise(F.col("_pb")) - 1)
    met = met.select("box", "probe", "word", "n", F.explode(own).alias("_own"), "_wb", "_pb", all_of.alias("_all"))
    met = met.select("box", "probe", "word", "n", "_own", F.explode("_all").alias("_other"))
    met = met.withColumn("wb", F.when(F.col("probe"), F.col("_other")).otherwise(F.col("_own")))
    met = met.withColumn("pb", F.when(F.col("probe"), F.col("_own")).otherwise(F.col("_other"))).drop("_own", "_other")

    def find(group: pd.DataFrame) -> pd.DataFrame:
        held, probes = group[~group["probe"]], group[group["probe"]]
        out = []
        if len(held):
            length = len(held["word"].iloc[0])
            lengths = probes["word"].str.len().to_numpy()
            for asked in (probes[lengths == length], probes[lengths == length - 1]):
                if not len(asked):
                    continue
                p, w = near_pairs(held["word"].to_numpy(), asked["word"].to_numpy())
                a, b = asked.iloc[p], held.iloc[w]
                out.append(pd.DataFrame({"word": a["word"].to_numpy(), "near": b["word"].to_numpy(), "near_n": b["n"].to_numpy()}))
                if len(asked["word"].iloc[0]) < length:
                    out.append(pd.DataFrame({"word": b["word"].to_numpy(), "near": a["word"].to_numpy(), "near_n": a["n"].to_numpy()}))
        return pd.concat(out) if out else pd.DataFrame({"word": [], "near": [], "near_n": []})

    return met.groupBy("box", "wb", "pb").applyInPandas(find, "word string, near string, near_n long")


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form (word, form): the word that following forms ends at."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # Two rows of a round: where a word points now, and whether that was still on the way.
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on_way")))
        at = moved.select("word", "root")
        if moved.where("on_way").isEmpty():
            return at


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n) -> word, form, root, n, n_near, form_n."""
    words = stored(words.select("word", "n"))
    pairs = near_words(words)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    out = stored(words.join(best, "word", "left"))
    is_form = F.col("near_n") >= F.lit(ratio) * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                     F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    roots = with_roots(out.where("form is not null"))
    out = out.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of ``documents``."""
    return spelling_variants(count_words(table(spark, sf_dir, "documents").select("doc_id", "text")))
