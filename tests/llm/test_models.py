"""op1, op3, op5 and op9 against brute force, planted cases and held-out labels."""
import collections
import math
import random
import re
import zlib

import numpy as np

from dockplan.llm import decontamination, kneser_ney, ngram_join, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def made(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


# ---- decontamination -------------------------------------------------------------------------------------------


def test_leaks_are_found_and_clean_documents_left(spark, docs_of):
    rng = random.Random(5)
    items = [(i, made(rng, 40)) for i in range(12)] + [(90, "two words"), (91, ""), (92, None)]
    docs = [(i, made(rng, 300)) for i in range(30)]
    want = {}
    for i in range(12):
        w = items[i][1].split()
        if i % 3 == 1:  # every tenth word replaced
            w = [x if k % 10 else "edited" for k, x in enumerate(w)]
        if i % 3 == 2:  # words dropped and put in
            w = [y for k, x in enumerate(w) for y in ([] if k % 13 == 5 else [x, "more"] if k % 11 == 3 else [x])]
        text = made(rng, 80) + " " + " ".join(w).upper() + ", " + made(rng, 60)
        docs.append((100 + i, text))
        want[100 + i] = i
    docs += [(200, "so these TWO words, here"), (201, None), (202, ""), (203, items[0][1] + " . " + items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (4, 20_000):
        got = decontamination.decontaminate(docs_of(docs), bench, items_per_block=block).collect()
        pairs = collections.Counter((r["doc_id"], r["item_id"]) for r in got)
        assert set(pairs) == set(want.items()) | {(200, 90), (203, 0)} and pairs[203, 0] == 2
        for r in got:
            assert dict(docs)[r["doc_id"]][r["start"]:r["end"]] == r["passage"] and r["score"] >= 0.5


def test_hot_item_still_has_seeds(docs_of, spark):
    rng = random.Random(6)
    item = made(rng, 30)
    docs = docs_of([(i, made(rng, 50) + " " + item) for i in range(60)] + [(100 + i, made(rng, 80)) for i in range(60)])
    got = decontamination.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(60))


def test_heavily_edited_copies_are_found_beside_exact_ones(docs_of, spark):
    rng = random.Random(8)
    items = [(i, made(rng, 20 if i % 2 else 40)) for i in range(12)]
    docs, want = [(i, made(rng, 100)) for i in range(20)], set()
    for i, text in items:
        step = 4 + i // 2 % 3  # every 4th, 5th or 6th word replaced
        copy = " ".join(x if k % step != step - 1 else f"edit{k}" for k, x in enumerate(text.split()))
        docs.append((100 + i, made(rng, 30) + " " + copy + " " + made(rng, 30)))
        want.add((100 + i, i))
        if i >= 6:
            docs.append((200 + i, made(rng, 30) + " " + text + " " + made(rng, 30)))
            want.add((200 + i, i))
    got = decontamination.decontaminate(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def test_alignment_against_plain_dynamic_programming():
    rng = random.Random(7)

    def plain(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1][j + 1] = max(0, h[i][j] + (2 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
        return max(map(max, h))

    for _ in range(60):
        a, b = ([rng.randint(1, 6) for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontamination.align(np.array(a), np.array(b))[0] == plain(a, b)


def test_decontamination_edges(spark, docs_of, extra, sample):
    bench = spark.read.parquet(f"{sample}/benchmark.parquet")
    assert decontamination.decontaminate(docs_of([]), bench).count() == 0
    assert decontamination.decontaminate(extra, bench.limit(0)).count() == 0
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.op1_seed_and_align_decontamination(spark, sample).collect()}
    docs, items = spark.read.parquet(f"{sample}/documents.parquet").collect(), bench.collect()
    assert got >= {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in (d["text"] or "")}


# ---- Kneser-Ney ------------------------------------------------------------------------------------------------


def reference_scores(rows):
    toks = [(i, words(t) + [None], zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t in rows]
    pairs, one = collections.Counter(), collections.Counter()
    for _, x, held in toks:
        if not held:
            one.update(x)
            pairs.update(zip(["<s>", *x], x))
    cont = collections.Counter(w for _, w in pairs)
    d = kneser_ney.discounts(np.array([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)]))
    e = kneser_ney.discounts(np.array([sum(c == k for c in cont.values()) for k in (1, 2, 3, 4)]))
    step = lambda n, d: 0 if not n else d[min(n, 3) - 1]
    count, mass = collections.Counter(), collections.Counter()
    for (v, _), c in pairs.items():
        count[v] += c
        mass[v] += step(c, d)
    left = sum(step(n, e) for n in cont.values()) / len(pairs)
    low = lambda w: (cont[w] - step(cont[w], e)) / len(pairs) + left / (len(cont) + 1)
    p = lambda w, v: low(w) if not count[v] else (pairs[v, w] - step(pairs[v, w], d) + mass[v] * low(w)) / count[v]
    total = sum(one.values())
    return [(i, held, len(x), sum(one[w] > 0 for w in x), total, sum(math.log10((one[w] + 1) / (total + len(one) + 1)) for w in x),
             sum(math.log10(p(w, v)) for v, w in zip(["<s>", *x], x))) for i, x, held in toks], p, [*cont, "never seen"]


def test_scores(spark, folder, texts, odd):
    rows = list(texts.items()) + odd
    want, p, vocabulary = reference_scores(rows)
    got = kneser_ney.op3_kneser_ney_scores(spark, folder(documents=rows)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(got) == len(rows)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, -w[5]) and abs(g[6] - w[6]) < 1e-6 * max(1, -w[6])
    assert abs(sum(p(w, "the") for w in vocabulary) - 1) < 1e-6
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_scores_edges(spark, folder, docs_of, extra):
    assert kneser_ney.op3_kneser_ney_scores(spark, folder(documents=[])).count() == 0
    nothing = kneser_ney.build(docs_of([]))
    assert [r["score"] for r in kneser_ney.score(docs_of([(1, "a b")]), nothing).collect()] == [0.0]
    assert dict(kneser_ney.score(extra, kneser_ney.build(extra)).dtypes)["score"] == "double"


# ---- toxicity --------------------------------------------------------------------------------------------------


def labelled(spark, folder, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        w, toxic = made(rng, rng.randint(20, 120)).split(), i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(["zzgrump", "zzgrumps", "yyblast"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, folder):
    docs, labels = labelled(spark, folder)
    got = toxicity.op5_kneser_ney_toxicity(spark, folder(documents=docs, labels=labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    right = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]
    assert sum(right) / len(right) > 0.95 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_held_out_labels_train_nothing(spark, folder):
    docs, labels = labelled(spark, folder, 200)
    turned = spark.createDataFrame([(r["doc_id"], 1, 1 - r["toxic"] if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else r["toxic"])
                                    for r in labels.collect()], labels.schema)
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.op5_kneser_ney_toxicity(spark, folder(documents=docs, labels=x)).collect()}
            for x in (labels, turned))
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_word_ratios_agree(spark, docs_of):
    rows = docs_of([(i, t) for i, t in enumerate(["aa bb cc aab", "aa bb dd aab", "zz yy zzx aab", "zz yy zzx bb"] * 3)])
    model = toxicity.fit(rows.selectExpr("text", "cast(doc_id % 4 >= 2 as int) as toxic"))
    ws = ["aa", "zz", "zzx", "zzq", "unknown", "b", "aab", "x" * 30]
    assert np.allclose(toxicity.WordRatios(model)(ws), [model.ratio(w) for w in ws])
    assert model.ratio("zzx") > 0 > model.ratio("cc")


def test_toxicity_edges(spark, folder, odd, docs_of, extra):
    schema = "doc_id long, quality int, toxic int"
    none = folder(documents=odd, labels=spark.createDataFrame([(None, 1, 1), (4, 1, None)], schema))
    assert {(r["score"], r["predicted"]) for r in toxicity.op5_kneser_ney_toxicity(spark, none).collect()} == {(0.0, 0)}
    docs, labels = labelled(spark, folder, 200)
    scorer = toxicity.ToxicityScorer(spark, docs_of(docs + odd), labels)
    out = scorer.score(extra)
    assert out.count() == extra.count() and dict(out.dtypes)["score"] == "double" and scorer.score(docs_of([])).count() == 0


# ---- near duplicates -------------------------------------------------------------------------------------------


def shingles(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def reference_classes(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    small = {}
    for a, (i, _) in enumerate(rows):
        small.setdefault(find(a), []).append(i)
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    return collections.Counter((i, len(sets[a]), low(small[find(a)])) for a, (i, _) in enumerate(rows))


def family(rng, start, size, length, edits):
    base = made(rng, length).split()
    out = []
    for k in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = made(rng, 1)
        out.append((start + k, " ".join(w)))
    return out


def test_classes_of_families(docs_of, odd):
    rng = random.Random(11)
    passage = made(rng, 60)
    rows = family(rng, 0, 150, 120, 6) + family(rng, 1000, 60, 40, 2) + family(rng, 2000, 40, 400, 12)
    rows += [(3000 + i, made(rng, 100) + " " + passage) for i in range(50)] + [(4000 + i, rows[7][1].upper()) for i in range(40)] + odd
    rng.shuffle(rows)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicate_classes(docs_of(rows)).collect())
    assert got == reference_classes(rows)


def test_members_of_a_group_link_whichever_leads(docs_of):
    """Texts with one prefix and different rests are one group; each rest has a near copy in a group of another size."""
    rng = random.Random(12)
    rows = []
    for k in range(10):
        p, x, y = (made(rng, n) for n in (26, 80, 80))
        rows += [(1000 * k + 100 * j + i, made(rng, 60) + " " + z + " " + made(rng, 60)) for j, z in enumerate((x, y)) for i in range(20)]
        rows += [(1000 * k + 500, p + " " + x), (1000 * k + 501, p + " " + y), (1000 * k + 502, p + " one " + y)]
        rows += [(1000 * k + 503, p + " one " + x)] if k % 2 else []
    want = reference_classes(rows)
    assert want[501, 102, 501] == 1 and want[502, 103, 501] == 1 and want[1503, 103, 1500] == 1
    # Both kinds of text lead some of the groups.
    classes = ngram_join.documents_with_shingles(docs_of(rows), "doc_id", "text").collect()
    rid = {r["doc_id"]: r["rid"] for r in classes}
    assert len({rid[1000 * k + 500] < rid[1000 * k + 501] for k in range(10)}) == 2
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicate_classes(docs_of(rows)).collect())
    assert got == want


def test_threshold_is_exact(docs_of):
    """Sets of 9 shingles that share 8 have 8/10, exactly the threshold; 7 of 8 and 7 of 9 fall below."""
    w = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(w[:13])), (2, " ".join([*w[:12], "x"])), (3, " ".join(w[10:22])), (4, " ".join([*w[10:21], "y"]))]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_classes_query(spark, sample, texts, docs_of, extra):
    got = collections.Counter(map(tuple, ngram_join.op9_grouped_prefix_join(spark, sample).collect()))
    assert got == reference_classes(list(texts.items()))
    assert ngram_join.near_duplicate_classes(docs_of([])).count() == 0
    assert ngram_join.near_duplicate_classes(extra).count() == extra.count()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    assert all(got.get(x, x) == y for x, y in label.items())
