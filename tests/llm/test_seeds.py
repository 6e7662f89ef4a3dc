"""op1's seeds: recall against an alignment of all pairs by kind of edit, and passages that follow copies, not items."""

import random

import numpy as np
import pytest

from dockplan.llm import decontamination as dc


@pytest.fixture(scope="module")
def prose(texts):
    return [w for w in (t.split() for _, t in sorted(texts.items())) if len(w) > 150]


def cut(rng, prose, n):
    w = rng.choice(prose)
    a = rng.randrange(len(w) - n)
    return w[a : a + n]


def edited(rng, words, kind, step):
    new = lambda: f"zq{rng.randrange(10**9)}"
    if kind == "replace":
        return [x if k % step != step - 1 else new() for k, x in enumerate(words)]
    if kind == "random":
        return [x if rng.random() * step > 1 else new() for x in words]
    if kind == "drop":
        return [x for k, x in enumerate(words) if k % step != step - 1]
    return [y for k, x in enumerate(words) for y in ([x] if k % step != step - 1 else [x, new()])]


def hashed(words):
    w = dc.hashed(dc.raw_words(" ".join(words)))
    return w[w != 0]


EDITS = [("replace", 3), ("replace", 4), ("random", 3), ("random", 4), ("drop", 3), ("insert", 1), ("insert", 2)]


@pytest.mark.parametrize("length", [12, 40])
def test_recall_against_all_pairs(spark, docs_of, prose, length):
    """Every document against every item: what an alignment of the whole text scores at the threshold is found."""
    rng = random.Random(length)
    items, docs = [], []
    for kind in EDITS:
        for _ in range(4):
            item = cut(rng, prose, length)
            docs.append(cut(rng, prose, 50) + edited(rng, item, *kind) + cut(rng, prose, 50))
            items.append(item)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    leaks = dc.decontaminate(docs_of([(d, " ".join(x)) for d, x in enumerate(docs)]), bench).collect()
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks}
    score = {(d, i): dc.align(y, x)[0] / (dc.MATCH * len(y)) for d, x in enumerate(map(hashed, docs)) for i, y in enumerate(map(hashed, items))}
    over = {p for p, s in score.items() if s >= dc.THRESHOLD}
    assert set(found) <= over and len(over) >= 20
    assert len(over & set(found)) >= 0.95 * len(over), over - set(found)
    assert all(found[p] <= score[p] + 1e-9 for p in found)


def passages_of(prose, n_items):
    rng = random.Random(9)
    words = [hashed(cut(rng, prose, 40)) for _ in range(n_items)]
    block = dc.Block.of(list(range(n_items)), words)
    texts = [" ".join(w) for w in prose]
    w, _, bounds, _ = dc.sequences(texts)
    every, right = 0, 0
    for d, i, hits in block.found(w, bounds):
        text = w[bounds[d] : bounds[d + 1]]
        for a, z in dc.passages(hits, len(words[i]), len(text), block.needed[i]):
            every += 1
            right += dc.matchable(words[i], text[a:z]) >= dc.THRESHOLD
    return every, right


def test_passages_follow_copies(prose):
    for n in (20, 400):
        every, right = passages_of(prose, n)
        assert right >= n and every <= 3 * right


def test_common_seeds_are_left_out_and_rarest_kept():
    """A phrase of all items is not looked up for each of them; an item of that phrase alone keeps its rarest seeds."""
    r = np.random.default_rng(0)
    phrase = r.integers(1, 2**60, 10, dtype=np.uint64)
    words = [np.concatenate([phrase, r.integers(1, 2**60, 20, dtype=np.uint64)]) for _ in range(3 * dc.COMMON)] + [phrase]
    block = dc.Block.of(list(range(len(words))), words)
    held = np.diff(block.first)
    # Twelve of the phrase's seeds at most are kept, by the item that has no others.
    assert (held > dc.COMMON).sum() == 0 and np.isin(len(words) - 1, block.items)
    assert (block.items == len(words) - 1).sum() == dc.FEWEST


def test_blocks_end_by_characters(spark, docs_of, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_CHARS", 100)
    bench = spark.createDataFrame([(i, f"alpha beta gamma delta epsilon {i} " * 2) for i in range(7)], "item_id long, text string")
    assert [len(b) for b in dc.item_blocks(bench, 20_000)] == [2, 2, 2, 1]
    got = dc.decontaminate(docs_of([(1, "alpha beta gamma delta epsilon 3 alpha beta gamma delta epsilon 3")]), bench).collect()
    assert (1, 3) in {(r["doc_id"], r["item_id"]) for r in got}


def test_clashing_columns(spark, folder, extra, sample):
    """Columns with the names that the operator adds stay out of its way, over a benchmark that has hits."""
    bench = spark.createDataFrame([(5, "a b c d e"), (6, None)], "item_id long, text string")
    got = dc.op1_seed_and_align_decontamination(spark, folder(documents=extra, benchmark=bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(5, 5), (6, 5)}
