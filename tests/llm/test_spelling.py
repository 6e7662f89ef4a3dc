"""Spelling variants against a comparison of all pairs; the counts against plain Python."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockplan.llm import spelling


def edits(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def counted(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def expected(n):
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def family(seed, size=300):
    """Words around a few stems, with anagrams, repeated and accented letters, chains of forms and one very long word."""
    r = random.Random(seed)
    letters = "aabcdeéñ÷"
    stems = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(6)]
    words = set(stems) | {"".join(p) for p in itertools.islice(itertools.permutations("abcdef"), 40)}
    while len(words) < size:
        w = r.choice(sorted(words))
        i, c = r.randrange(len(w)), r.choice(letters)
        words.add(r.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :] if len(w) > 6 else w]))
    long = "".join(r.choice(letters) for _ in range(9000))
    words |= {long, long[:-1], long[1:] + "a", long[:5000] + "z" + long[5001:], "z" * 70, "z" * 69}
    return {w: 5 ** r.randint(1, 4) + r.randint(0, 2) for w in sorted(words)}


@pytest.mark.parametrize("sizes", [{}, {"sample_words": 60, "box_words": 16, "box_probes": 40}, {"sample_words": 1}])
def test_pairs_and_blocks(spark, monkeypatch, sizes):
    monkeypatch.setattr(spelling, "SAMPLE_A_BOX", 4)
    n = family(1)
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = sorted(tuple(r) for r in spelling.near_words(words, **sizes).collect())
    assert got == sorted((a, b, n[b]) for a in n for b in n if edits(a, b))


def test_forms_and_roots(spark):
    n = family(2)
    out = spelling.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    want = expected(n)
    assert sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect()) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # chains


def test_tree_loses_no_box():
    r = np.random.default_rng(0)
    counts = r.integers(0, 4, size=(500, spelling.DIMENSIONS)) * (r.random((500, spelling.DIMENSIONS)) < 0.1)
    tree = spelling.Tree(counts, 8)
    box = np.empty(500, dtype=int)
    for b, rows in tree.search(counts, 0, 0):
        box[rows] = b
    assert len(set(box)) == tree.boxes
    reached = {(b, i) for b, rows in tree.search(counts, 2, 1) for i in rows}
    for i in range(500):
        more, fewer = np.maximum(counts - counts[i], 0).sum(axis=1), np.maximum(counts[i] - counts, 0).sum(axis=1)
        assert {(box[j], i) for j in np.flatnonzero((more <= 2) & (fewer <= 1))} <= reached


def test_query_on_odd_rows_and_names(spark, folder, extra, odd):
    many = [(i, "Straßenbahn strassenbahn ÀÉÎÕÜß " * 3 + "q" * 300) for i in range(400)] + [(None, "STRASSENBAHN strassenbahm " * 4)] * 3
    rows = odd + many
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs.select("*", *[F.lit("mine").alias(c) for c in ("word", "n", "run", "box", "probe", "form", "root", "near")])
    out = spelling.op11_spelling_variants(spark, folder(documents=clash))
    want = expected(counted(rows))
    assert sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect()) == want and len(want) > 4


def test_empty_table(spark, folder):
    assert spelling.op11_spelling_variants(spark, folder(documents=[])).count() == 0
