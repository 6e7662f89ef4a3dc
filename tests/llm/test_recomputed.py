"""op10's winners and slots, and op5's model and scores, computed again in plain Python."""
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from dockplan.llm import sharding, toxicity

# ---- rendezvous sharding ---------------------------------------------------------------------------------------


def chained(*values):
    """Spark's xxhash64 of (format, value) pairs: each one's hash seeds the next, a null leaves the seed as it is."""
    h = 42
    for form, v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack(form, v), seed=h)
    return h


def winner(key, weights):
    def cost(i, w):
        u = ((chained(("<i", sharding.SALT), ("<i", i), ("<q", key)) >> 11) + 0.5) / 2.0**53
        return -math.log(u) / w

    return min((cost(i, w), i) for i, w in enumerate(weights) if w > 0)[1]


def slice_of(key):
    h = chained(("<i", sharding.SALT + 1), ("<q", key))
    return (h - (1 << 64 if h >> 63 else 0)) % sharding.SLICES


def expected(rows):
    """Per row (id, size, crc): its shard, the place in it, and the shard when there is one more."""
    by = defaultdict(list)
    for i, t in rows:
        raw = (t or "").encode()
        by[winner(i, [1.0] * 24)].append((slice_of(i), i is not None, i or 0, len(raw) + 8, zlib.crc32(raw), i))
    out = Counter()
    for shard, inside in by.items():
        for slot, (_, _, _, size, crc, i) in enumerate(sorted(inside, key=lambda x: x[:5])):
            out[i, size, crc, "key", shard, slot, winner(i, [1.0] * 25)] += 1
    return out


def test_winners_and_slots(spark, folder, odd):
    rng = random.Random(3)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), f"text {i}") for i in range(900)] + odd
    got = sharding.op10_rendezvous_sharding(spark, folder(documents=rows)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()
    assert Counter(map(tuple, got)) == expected(rows)


def test_sharding_of_the_table(spark, sample, texts):
    got = sharding.op10_rendezvous_sharding(spark, sample).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()
    assert Counter(map(tuple, got)) == expected(list(texts.items()))


@pytest.mark.parametrize("weights", [[1.0, 0.0, 2.5, 0.5], [0.0, 1.0], [3.0] * 7])
def test_weighted_winners(docs_of, weights):
    ids = [*range(400), None]
    got = sharding.assign_shards(docs_of([(i, "") for i in ids]), "doc_id", weights).select("doc_id", "shard").collect()
    assert {r["doc_id"]: r["shard"] for r in got} == {i: winner(i, weights) for i in ids}


# ---- toxicity --------------------------------------------------------------------------------------------------


class Plain:
    """The two class models as dictionaries over all spellings."""

    def __init__(self, rows, smallest=3):
        held = [Counter(), Counter()]  # ordinary, toxic
        for text, toxic in rows:
            held[toxic].update({self.closed(w) for w in self.words(text)})
        self.c, kinds = [Counter(), Counter()], Counter()
        for w in held[0].keys() | held[1].keys():
            for k in range(1, len(w) + 1):
                kinds[w[:k]] += 1
                for side in (0, 1):
                    self.c[side][w[:k]] += held[side][w]
        self.known = {h for h in kinds if self.c[0][h] + self.c[1][h] >= smallest}
        self.n, self.mass, self.kinds, below = [Counter(), Counter()], [Counter(), Counter()], kinds, Counter()
        d = [self.discounts(c) for c in self.c]
        for h in kinds:
            below[h[:-1]] += kinds[h]
            for side in (0, 1):
                c = self.c[side][h]
                self.n[side][h[:-1]] += c
                self.mass[side][h[:-1]] += d[side][min(c, 3)]
        self.d, self.below = d, below

    @staticmethod
    def words(text):
        out = []
        for w in re.findall(r"[^\W_]+", text.lower()):
            out += [w] if len(w) <= 16 else [w[k:k + 16] for k in range(len(w))]
        return out

    @staticmethod
    def closed(w):
        return (w + "_")[:16]

    @staticmethod
    def discounts(c):
        seen = Counter(c.values())
        n1, n2, n3, n4 = (seen[k] for k in (1, 2, 3, 4))
        if not n1 or not n2:
            return 0.0, 0.5, 0.75, 1.0
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.5)
        return 0.0, *[min(max(x, 0.05), k + 0.98) for k, x in enumerate(d)]

    def left(self, side, h):
        return self.mass[side][h] / self.n[side][h] if self.n[side][h] else 1.0

    def p(self, side, h):
        c, up = self.c[side][h], h[:-1]
        own = (c - self.d[side][min(c, 3)]) / self.n[side][up] if self.n[side][up] else 0.0
        return own + self.left(side, up) * self.kinds[h] / self.below[up]

    def ratio(self, word):
        w, total = self.closed(word), 0.0
        for k in range(1, len(w) + 1):
            if w[:k] not in self.known:
                up = w[:k - 1]
                return total + (math.log(self.left(1, up) / self.left(0, up)) if up in self.below else 0.0)
            total += math.log(self.p(1, w[:k]) / self.p(0, w[:k]))
        return total

    def evidence(self, text):
        r = [self.ratio(w) for w in self.words(text)]
        return [max((sum(r[a:a + k]) / k for a in range(len(r) - k + 1)), default=0.0) if r else 0.0
                for k in (min(width, len(r)) for width in (1, 4, 16))]


def corpus(n=400):
    rng = random.Random(17)
    some = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(500)]
    docs = []
    for i in range(n):
        w = [rng.choice(some) for _ in range(rng.randint(1, 60))]
        if i % 4 == 0:
            w.insert(rng.randrange(len(w) + 1), rng.choice(["zzgrump", "ZZGRUMPS!", "yyblast", "averylongcompoundzzgrumphere"]))
        docs.append((i, " ".join(w)))
    return docs


def test_model_and_scores(spark, docs_of, odd):
    docs = corpus()
    table = docs_of(docs)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in docs], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(table, labels, 20_000, 8_000).collect()
    want = [(t, int(i % 4 == 0)) for i, t in docs if zlib.crc32(str(i).encode()) % 3 != 1]
    assert Counter((r["text"], r["toxic"]) for r in rows) == Counter(want)
    plain = Plain([(r["text"], r["toxic"]) for r in rows if r["part"] == 1])

    scorer = toxicity.ToxicityScorer(spark, table, labels)
    words = sorted({w for _, t in docs for w in plain.words(t)}) + ["zz", "zzq", "unknown", "q", "a", "x" * 30]
    got = toxicity.WordRatios(scorer.model)(words)
    assert np.allclose(got, [plain.ratio(w) for w in words], atol=1e-4)
    # Counts of a node fewer than `smallest` times in training leave the model there, not at the root.
    assert any(w not in plain.known and w[:2] in plain.known for w in words)

    every = docs + [(1000 + k, t) for k, (_, t) in enumerate(odd)]
    scored = scorer.score(docs_of(every)).collect()
    assert len(scored) == len(every)
    for r in scored:
        e = plain.evidence(dict(every)[r["doc_id"]] or "")
        assert np.allclose(r["evidence"], e, atol=1e-3)
        s = 1 / (1 + math.exp(-(float(np.dot(scorer.curve[:-1], e)) + scorer.curve[-1])))
        assert abs(r["score"] - s) < 1e-2 and r["predicted"] == int(r["score"] >= 0.7)

    # The curve is where the gradient of the penalised likelihood vanishes.
    part = [r for r in rows if r["part"] == 0]
    x = np.array([[*plain.evidence(r["text"]), 1.0] for r in part])
    y = np.array([r["toxic"] for r in part], dtype=float)
    b = np.array(scorer.curve)
    p = 1 / (1 + np.exp(-(x @ b)))
    assert np.abs(x.T @ (y - p) - np.array([0.01, 0.01, 0.01, 1e-6]) * b).max() < 1e-2
