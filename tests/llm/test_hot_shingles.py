"""op9 with shingles that a share of all documents holds."""

import collections
import random
import types

import numpy as np
import pandas as pd
import pytest

from dockplan.llm import ngram_join


def rows_with_hot_passage(n=240, seed=3):
    """A third of the rows share a passage; families of near copies; repeated rows, nulls and short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = " ".join(f"hot{i}" for i in range(30))
    rows = []
    for i in range(n):
        own = " ".join(word() for _ in range(rng.choice((4, 9, 40))))
        rows.append((i, f"{passage} {own}" if i % 3 == 0 else own))
    for i in range(0, 40, 2):
        base = rows[i][1].split()
        base[-1] = word()
        rows.append((n + i, " ".join(base)))
    return [*rows, rows[0], rows[0], rows[1], (None, rows[3][1]), (None, None), (n + 100, "")]


def brute_force(rows):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)].append(doc)
    return collections.Counter((rows[i][0], len(sets[i]), min(smallest[find(i)], default=None)) for i in range(len(rows)))


@pytest.mark.parametrize("sampled, least", [(5_000, 10**9), (5_000, 2), (60, 10)])
def test_hot_shingles_change_nothing(docs_of, monkeypatch, sampled, least):
    rows = rows_with_hot_passage()
    monkeypatch.setattr(ngram_join, "HOT_SAMPLE_ROWS", sampled)
    monkeypatch.setattr(ngram_join, "HOT_ROWS", least)
    got = ngram_join.near_duplicate_classes(docs_of(rows)).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_force(rows)


def hot_value(codes):
    return types.SimpleNamespace(value=(np.array(codes, dtype=np.int64), np.full(len(codes), 9, dtype="<u2")))


@pytest.mark.parametrize("n_buckets", [12, 300, 70_000])
def test_deal_loses_no_shingle(n_buckets):
    rows = [(i, t) for i, t in rows_with_hot_passage(60) if i is not None]
    pdf = pd.DataFrame({"doc_id": [str(i) for i, _ in rows], "text": [t or "" for _, t in rows], "mark": 0})
    sets = ngram_join.shingle_sets(pdf["text"].tolist())
    codes = [ngram_join.codes_of(*ngram_join.bucket_and_key(s, n_buckets)) for s in sets]
    want = collections.Counter(c for each in codes for c in each.tolist())
    hot = sorted(c for c, n in want.items() if n >= 10)
    assert hot
    out = pd.concat(ngram_join.deal(n_buckets, hot_value(hot))(iter([pdf])))
    got, records = collections.Counter(), 0
    for b, rid, cnt, key, rec in out.itertuples(index=False):
        rids, records = np.frombuffer(rid, "<i8"), records + len(np.frombuffer(rec, ngram_join.RECORD))
        if b < n_buckets:
            found = ngram_join.codes_of(b, np.frombuffer(key, "<u4"))
            assert not set(found.tolist()) & set(hot)
        else:
            found = np.frombuffer(key, "<i8")
            assert set(found.tolist()) <= set(hot) and (rids % n_buckets == b - n_buckets).all()
        assert np.frombuffer(cnt, "<u4").sum() == len(found)
        got.update(found.tolist())
    assert got == want and records == len(rows)
    # The hot passage is in no bucket's lists, and its answers carry the given counts.
    part = out[out["bucket"] >= n_buckets].iloc[:1]
    back = ngram_join.answer(n_buckets, hot_value(hot))(part)
    assert back["bucket"].tolist() == [ngram_join.ALL_BUCKETS] and set(np.frombuffer(back["df"][0], "<u2").tolist()) == {9}
