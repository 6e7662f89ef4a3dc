"""The inverted multi-index against all distances: exact when it reads everything, at least 0.9 of the neighbours otherwise."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockplan.llm import multi_index as mi

ROWS = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x for x in v)


def brute_force(rows, asked, k=10):
    """Per query id, sorted lists of (score, id): one list for every different vector that the id has."""
    width = max((len(v) for _, v in rows if v is not None), default=0)
    pad = {(i, tuple(np.float32(v).astype(float).tolist()) + (0.0,) * (width - len(v))) for i, v in rows if i is not None and usable(v)}
    pad = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in pad})
    matrix = np.array([v for _, v in pad])
    out = {}
    for at, (i, v) in enumerate(pad):
        if asked(i):
            d = np.sqrt(((matrix - matrix[at]) ** 2).sum(axis=1))
            met = sorted((float(s), pad[j][0]) for j, s in enumerate(d) if j != at)[:k]
            out.setdefault(i, []).append(met)
    return out


def lists(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def odd_rows():
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).round(1).tolist()) for i in range(120)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0]) for i in range(200, 290)]  # a hot vector
    rows += [(i, [1.0, 2.0]) for i in range(290, 300)] + [(300, [1.0, 2.0, -0.0])]  # the same, shorter
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [None] * 6), (404, [math.nan] * 6), (405, [math.inf, 1.0]), (None, [1.0] * 6)]
    rows += rows[:5] + rows[200:205]  # repeated rows
    rows += [(30, [5.0] * 6)]  # a second vector of a query's id
    return rows


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_when_all_is_read(spark, monkeypatch, block):
    monkeypatch.setattr(mi, "BLOCK_ROWS", block)
    monkeypatch.setattr(mi, "BLOCK_QUERIES", block)
    rows = odd_rows()
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS)
    frame = frame.select("*", *[F.lit("mine").alias(c) for c in ("id", "vector", "ids", "cell", "score", "rank")]).repartition(4)
    got = lists(mi.nearest(frame, F.col("id") % 10 == 0, budget=10**9))
    want = brute_force(rows, lambda i: i % 10 == 0)
    assert set(got) == set(want)
    for i, each in want.items():
        # Queries of one id stand together; each has k rows.
        every = sorted(x for one in each for x in one)
        assert sorted(j for _, j in got[i]) == sorted(j for _, j in every)
        assert np.allclose(sorted(s for s, _ in got[i]), [s for s, _ in every], rtol=0, atol=1e-12)
        if len(each) == 1:
            assert [j for _, j in got[i]] == [j for _, j in every]


def test_recall_on_all_queries(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = lists(mi.nearest(rows, F.col("id") % 20 == 0))
    want = brute_force([(r["vec_id"], r["embedding"]) for r in rows.collect()], lambda i: i % 20 == 0)
    assert set(got) == set(want)
    right = sum(len({j for _, j in got[i]} & {j for _, j in want[i][0]}) for i in want)
    assert right >= 0.9 * 10 * len(want)
    assert all(len(x) == 10 for x in got.values())


def test_heap_visits_in_order():
    r = np.random.default_rng(1)
    index = mi.MultiIndex(r.normal(size=(300, 5)), 8)
    q = r.normal(size=5)
    first, second = (mi.squared(h, c)[0] for h, c in zip(index.split(q[None, :]), index.halves))
    sums = (first[:, None] + second[None, :]).ravel()
    cells = list(index.visits(q))
    assert sorted(cells) == list(range(index.cells))
    assert np.allclose(sums[cells], np.sort(sums))


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])], [(0, [1.0]), (7, [2.0]), (100, [2.0])]])
def test_few_rows(spark, folder, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS)
    got = lists(mi.op13_multi_index_neighbours(spark, folder(embeddings=frame)))
    want = {i: x[0] for i, x in brute_force(rows, lambda i: i % 100 == 0).items() if x[0]} if any(usable(v) for _, v in rows) else {}
    assert got == want
