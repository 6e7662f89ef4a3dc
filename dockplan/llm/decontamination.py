"""Benchmark decontamination (operator 1): n-gram seeds, then Smith-Waterman alignment of words.

1. A seed is three words of a test item that follow each other, or of which one gap of one word parts two: the patterns 111, 1101
   and 1011, hashed by the words alone, on both sides. An alignment at the threshold matches two words of three, and wherever two of
   three words match, one of these patterns does; a word put in or left out turns one pattern into another (texts are
   also looked at in 10101). Rare seeds count: of
   an item's seeds those in at most ``COMMON`` items, and its ``FEWEST`` rarest in any case, so what a seed fans out to is bounded.
2. One scan of the corpus joins texts to items on the seeds. Hits on one item that stand within an item's length of each other form
   a passage, widened by that length on both sides, if they are at least ``1 / SHARE`` of the item's seeds: an edited copy has many
   more, words that meet by chance fewer. So passages follow the copies, not documents times items.
3. No alignment can match more words of the item than those that occur in the passage at all. Passages where even a match of
   all of these would stay under ``threshold`` go; this loses nothing.
4. The passage and the item are aligned (match ``MATCH``, mismatch ``MISMATCH``, gap ``GAP``), whatever words were replaced, dropped
   or put in. Score: alignment score over that of an identical copy. At ``threshold`` the passage is a leak; then alignment
   goes on in what is left of the passage to either side, in overlapping windows of a few item lengths.

Recall against an alignment of all pairs is a test; README has the figures by kind and rate of edit.

Words are compared in lower case and without punctuation at their ends. Items with fewer than n words are sought as exact sequences.

Scale: the corpus is scanned in place, without a shuffle; only leaks leave it. Items are taken in blocks of at most
``items_per_block`` and about ``BLOCK_CHARS`` characters, so what is broadcast (the seeds and words of a block) stays bounded however
large the benchmark is; a block costs one scan. Nothing comes to the driver but the items of a block.

Defined cases. A null text is the empty text: no leak. Null or wordless items match nothing. Null ids are kept as nulls. Rows that
repeat a document or an item give their rows again. Texts are read whole. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import ship, stored, table, whole_text, worker_cache

N = 3
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
ITEMS_PER_BLOCK, BLOCK_CHARS = 20_000, 16_000_000
#: Items that hold a seed that counts as rare; seeds that an item keeps in any case; the share of its seeds that makes a passage.
COMMON, FEWEST, SHARE = 64, 12, 8
#: Places of a seed's words, by the number of words.
PATTERNS = {1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2), (0, 1, 3), (0, 2, 3))}
#: A text is looked at in these too: three words of an item with others put in between.
TEXT_PATTERNS = {1: PATTERNS[1], 2: PATTERNS[2], 3: (*PATTERNS[3], (0, 2, 4))}
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"
MULTIPLIER = 0x9E3779B97F4A7C15


class Words(dict):
    """64-bit hashes of normalised words by raw word, 0 for words of punctuation alone."""

    def __missing__(self, raw: bytes) -> int:
        bare = raw.decode("utf-8", "surrogatepass").lower().strip(EDGE)
        code = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass")) | 1 if bare else 0
        self[raw] = code
        return code


WORD_LIMIT = 500_000


def raw_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def hashed(raw: list[bytes]) -> np.ndarray:
    """Hashes by one table per worker; about ``WORD_LIMIT`` words are remembered."""
    words = worker_cache("decontamination", Words)
    if len(words) > WORD_LIMIT:
        words.clear()
    return np.fromiter(map(words.__getitem__, raw), dtype=np.uint64, count=len(raw))


def grams(w: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """Hashes of the words at ``places`` from every position of a sequence of word hashes."""
    n = len(w) - places[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for k in places:
            h = (h ^ w[k : k + n]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(29)
    return h


@dataclass
class Block:
    """Items of one block and their seeds: sorted hashes, and for each the items that it stands for, one after the other."""

    ids: list
    words: list[np.ndarray]
    patterns: list[tuple[int, ...]]
    seeds: np.ndarray
    first: np.ndarray
    items: np.ndarray
    needed: np.ndarray
    filter: np.ndarray

    BITS = 20

    @classmethod
    def of(cls, ids: list, words: list[np.ndarray]) -> Block:
        own = [np.unique(np.concatenate([grams(w, p) for p in PATTERNS[min(N, len(w))]])) if len(w) else w for w in words]
        item = np.repeat(np.arange(len(words)), [len(x) for x in own])
        every, back, held = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
        # The seeds of an item by the number of items that hold them.
        order = np.lexsort((back, held[back], item))
        nth = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = order[(held[back[order]] <= COMMON) | (nth < FEWEST)]
        kept = kept[np.argsort(back[kept], kind="stable")]
        seeds, first = np.unique(back[kept], return_index=True)
        small = np.zeros(1 << cls.BITS, dtype=bool)
        small[(every[seeds] >> np.uint64(64 - cls.BITS)).astype(np.int64)] = True
        needed = np.maximum(1, np.bincount(item[kept], minlength=len(words)) // SHARE)
        patterns = sorted({p for w in words if len(w) for p in TEXT_PATTERNS[min(N, len(w))]})
        return cls(ids, words, patterns, every[seeds], np.append(first, len(kept)), item[kept], needed, small)

    def hits(self, w: np.ndarray, places: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the seeds of one pattern in a sequence, and which seeds they are."""
        h = grams(w, places)
        pos = np.flatnonzero(self.filter[(h >> np.uint64(64 - self.BITS)).astype(np.int64)]) if len(h) else np.zeros(0, dtype=np.int64)
        if not len(self.seeds) or not len(pos):
            return pos[:0], pos[:0]
        k = np.minimum(np.searchsorted(self.seeds, h[pos]), len(self.seeds) - 1)
        ok = self.seeds[k] == h[pos]
        return pos[ok], k[ok]

    def found(self, w: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item, positions in the text) for the texts of a batch that hold as many seeds of an item as a passage needs."""
        docs, items, places = [], [], []
        for pattern in self.patterns:
            pos, k = self.hits(w, pattern)
            doc, ok = inside(pos, pattern[-1] + 1, bounds)
            pos, k, doc = pos[ok], k[ok], doc[ok]
            each = self.first[k + 1] - self.first[k]
            of = np.repeat(self.first[k] - np.cumsum(each) + each, each) + np.arange(each.sum())
            docs.append(np.repeat(doc, each))
            places.append(np.repeat(pos - bounds[doc], each))
            items.append(self.items[of])
        doc, item, place = map(np.concatenate, (docs or [bounds[:0]], items or [bounds[:0]], places or [bounds[:0]]))
        order = np.lexsort((place, item, doc))
        doc, item, place = doc[order], item[order], place[order]
        starts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))) if len(doc) else doc
        ends = np.append(starts[1:], len(doc))
        for a, z in zip(starts.tolist(), ends.tolist()):
            if z - a >= self.needed[item[a]]:
                yield int(doc[a]), int(item[a]), place[a:z]


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a batch end to end without punctuation words, which raw words of the batch they are, and the bounds
    of the texts in both."""
    raw = [raw_words(t) for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    w = hashed([x for r in raw for x in r])
    real = np.flatnonzero(w)
    bounds = np.searchsorted(real, ends)
    return w[real], real, bounds, ends


def inside(pos: np.ndarray, n: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text of each n-gram position of a batch, and whether the n-gram ends in that text."""
    doc = np.searchsorted(bounds, pos, side="right") - 1
    return doc, pos + n <= bounds[doc + 1]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the end of its place in the passage (exclusive)."""
    steps = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for x in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == x, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + steps) - steps
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def matchable(item: np.ndarray, passage: np.ndarray) -> float:
    """An upper bound of the score: every word of the item that the passage holds matches."""
    return MATCH * int(np.isin(item, passage).sum()) / (MATCH * len(item))


REACH = 3  # no alignment with a positive score spans more item lengths: each word put in costs a gap, each match earns two


def leaks_in(item: np.ndarray, passage: np.ndarray, least: float) -> list[tuple[float, int, int]]:
    """(score, start, end) of the alignments at or over ``least``, without overlap, in passage order.

    Always the best one that overlaps no earlier one. They are sought in windows of twice the reach, every reach, so each lies
    whole in some window, and the work follows the passage's length. Windows that a found one touches are looked at again, less that one.
    """
    reach = REACH * len(item)
    heap: list[tuple[float, int, int, int, int]] = []
    starts: list[int] = []
    out: list[tuple[float, int, int]] = []

    def look(a: int, z: int) -> None:
        if a >= z or matchable(item, passage[a:z]) < least:
            return
        best, end = align(item, passage[a:z])
        score = best / (MATCH * len(item))
        if score >= least:
            start = end - align(item[::-1], passage[a : a + end][::-1])[1]
            heapq.heappush(heap, (-score, a + end, a, z, a + start))

    for a in range(0, max(1, len(passage) - reach), reach):
        look(a, min(a + 2 * reach, len(passage)))
    while heap:
        score, end, a, z, start = heapq.heappop(heap)
        k = max(0, bisect.bisect_left(starts, a) - 1)
        last = bisect.bisect_left(starts, z)
        taken = [(s, e) for _, s, e in out[k:last] if e > a]
        if not taken:
            at = bisect.bisect_left(starts, start)
            starts.insert(at, start)
            out.insert(at, (-score, start, end))
            taken = [(start, end)]
        for s, e in taken:
            look(a, s)
            a = e
        look(a, z)
    return out


def passages(pos: np.ndarray, size: int, length: int, needed: int) -> list[tuple[int, int]]:
    """Ranges around ``needed`` hits of one item or more, widened by its size; ranges that touch are one."""
    ends = np.minimum(length, pos + 2 * size)
    groups = np.split(np.arange(len(pos)), np.flatnonzero(np.maximum(0, pos[1:] - size) > ends[:-1]) + 1)
    return [(max(0, int(pos[g[0]]) - size), int(ends[g[-1]])) for g in groups if len(g) >= needed]


LEAKS = "item_id long, score double, start long, `end` long, passage string"
WORD_PLACES = re.compile(r"[^ \t-\r]+")


def find_leaks(block, threshold: float, id_column: str) -> callable:
    """Texts -> leaks: passages around seeds, aligned wherever the bound allows one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = block.value
        for pdf in batches:
            out = []
            for k in range(0, len(pdf), 1024):
                part = pdf.iloc[k : k + 1024]
                texts, ids = part["text"].tolist(), part[id_column].tolist()
                w, raw, bounds, raw_bounds = sequences(texts)
                last, places = -1, []
                for d, i, hits in b.found(w, bounds):
                    item, text = b.words[i], w[bounds[d] : bounds[d + 1]]
                    least = threshold if len(item) >= N else 1.0
                    for a, z in passages(hits, len(item), len(text), b.needed[i]):
                        for score, s, e in leaks_in(item, text[a:z], least):
                            if d != last:
                                last, spans = d, [m.span() for m in WORD_PLACES.finditer(texts[d])]
                                places = [spans[x] for x in (raw[bounds[d] : bounds[d + 1]] - raw_bounds[d]).tolist()]
                            start, end = places[a + s][0], places[a + e - 1][1]
                            out.append((ids[d], b.ids[i], score, start, end, texts[d][start:end]))
            yield pd.DataFrame(out, columns=[id_column, "item_id", "score", "start", "end", "passage"])

    return run


def item_blocks(items: DataFrame, per_block: int) -> Iterator[pd.DataFrame]:
    """The items in id order, a bounded number at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    pending: list[tuple] = []
    held = 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        pending.append((r["item_id"], r["text"]))
        held += len(r["text"])
        if len(pending) == per_block or held >= BLOCK_CHARS:
            yield pd.DataFrame(pending, columns=["item_id", "text"])
            pending, held = [], 0
    if pending:
        yield pd.DataFrame(pending, columns=["item_id", "text"])


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                  items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """Leaks: ``key`` (a long), item_id, score, start and end in code points, passage."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(f"`{key}`").cast("long").alias(key), whole_text(f"`{text}`").alias("text"))
    schema = f"`{key}` long, {LEAKS}"
    parts = []
    for chunk in item_blocks(items, items_per_block):
        words = [x[x != 0] for x in (hashed(raw_words(t)) for t in chunk["text"])]
        ids = chunk["item_id"].tolist()
        block = spark.sparkContext.broadcast(Block.of(ids, words))
        parts.append(stored(source.mapInPandas(find_leaks(block, threshold, key), schema)))
        block.unpersist()
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def op1_seed_and_align_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every leak of ``benchmark`` in the whole texts of ``documents``."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start", "end")
