"""op2, op6 and op10 against brute force, and their edge cases."""
import collections
import hashlib
import re
import zlib

from dockplan.llm import pii, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def digits(v):
    return [int(c) for c in v if c.isdigit()]


def valid(kind, v):
    d = digits(v)
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        return 13 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in KINDS for m in re.finditer(p, text, re.A) if valid(k, m.group())]


TRICKY = [
    "a@b.c%d@e.f x.y@z", "1.2.3.4.5.6.7.8 999.1.2.3.4 001.002.003.0255 0.0.0.0", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111 1111 1111 11111111 2", "+1 (555) 123-4567 +49 30 1234567890123456 ++12345678901", "é+44 20 7946 0958é a@@b.c", "9" * 3000,
    "a" * 3000 + "@", "x@y.z" * 200, "12  34 4242424242424242-", "user@mail.example.com,user2@mail.example.com",
]


def test_base_spans(spark, docs_of, texts, odd):
    rows = list(texts.items()) + [(10_000 + i, t) for i, t in enumerate(TRICKY)] + [(20_000 + i, t) for i, (_, t) in enumerate(odd)]
    got = {r["doc_id"]: r for r in pii.with_spans(docs_of(rows), "doc_id", "text").collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = base_spans(t or "")
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]["base"]] == want, i
        assert all(s["value"] == (t or "")[s["start"]:s["end"]] for s in got[i]["base"])


def test_query_digest(spark, sample, texts):
    for r in pii.op2_information_pii(spark, sample).collect():
        spans = ",".join(f"{k}:{a}:{z}" for k, a, z in base_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest() and r["spans"].startswith(spans)


def test_disclosing_terms(docs_of):
    """A name that only ever stands beside one address gives it away; common words do not; copies are one context."""
    fill = ["the weather in town was fine", "a report on trade and grain", "notes on the harbour and its ships"]
    rows = [(i, f"{fill[i % 3]} number {i}") for i in range(40)]
    rows += [(100 + i, f"{fill[i]} Zebedee wrote from zeb@mail.example.com on day {i} again") for i in range(3)]
    rows += [(200 + i, "copied line Quillon of q@mail.example.com stays") for i in range(5)]
    got = {r["doc_id"]: r for r in pii.with_spans(docs_of(rows), "doc_id", "text").collect()}
    assert all("Zebedee" in [s["value"] for s in got[100 + i]["added"]] for i in range(3))
    assert all(s["value"].lower() not in ("the", "and", "on", "a") for r in got.values() for s in r["added"])
    assert not any(got[200 + i]["added"] for i in range(5)) and not got[0]["added"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs_of(rows)).collect()}
    assert "Zebedee" not in clean[100] and "[EMAIL]" in clean[100] and clean[0] == rows[0][1]


def test_sanitise_edges(docs_of, extra):
    assert pii.sanitise(docs_of([])).count() == 0
    out = pii.sanitise(extra)
    assert out.count() == extra.count() and "score" in out.columns and dict(out.dtypes)["base"].startswith("array")


def counts(text):
    w = WORD.findall(text)
    grams = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_quality(docs_of, texts, odd):
    rows = list(texts.items()) + [(10_000 + i, t) for i, (_, t) in enumerate(odd)]
    for r in quality.judge(docs_of(rows)).collect():
        text = dict(rows)[r["doc_id"]] or ""
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == counts(text)
        assert not (r["base_failed"] and r["kept"])


def test_quality_labels(spark, sample):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sample}/labels.parquet").collect()}
    rows = [r for r in quality.op6_quality_rules(spark, sample).collect() if r["doc_id"] in labels]
    assert all(not r["kept"] for r in rows if labels[r["doc_id"]] == 0)
    assert all(r["kept"] or r["base_failed"] for r in rows if labels[r["doc_id"]] == 1)


def test_quality_edges_and_plan(docs_of, extra, spark, sample):
    assert quality.judge(docs_of([])).count() == 0
    assert dict(quality.judge(extra).dtypes)["n_words"] == "bigint"
    plan = quality.op6_quality_rules(spark, sample)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_sharding(spark, docs_of, odd):
    rows = [(i, f"text {i}") for i in range(3000)] + odd
    df = docs_of(rows)
    out = sharding.assign_shards(df, "doc_id", [1.0] * 24, ties=("text",)).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert len(out) == len(rows) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r["shard"] for r in out if r["doc_id"] == 5}) == 1


def test_sharding_moves_and_weights(spark, docs_of):
    df = docs_of([(i, "") for i in range(6000)])
    before = {r[0]: r[1] for r in sharding.assign_shards(df, "doc_id", [1.0] * 5).select("doc_id", "shard").collect()}
    after = {r[0]: r[1] for r in sharding.assign_shards(df, "doc_id", [1.0] * 6).select("doc_id", "shard").collect()}
    moved = [i for i in before if before[i] != after[i]]
    assert all(after[i] == 5 for i in moved) and 800 < len(moved) < 1200
    heavy = collections.Counter(r[1] for r in sharding.assign_shards(df, "doc_id", [1.0, 3.0, 0.0]).select("doc_id", "shard").collect())
    assert heavy[2] == 0 and 2.6 < heavy[1] / heavy[0] < 3.4


def test_sharding_query(spark, folder, extra, odd, docs_of):
    got = sharding.op10_rendezvous_sharding(spark, folder(documents=odd)).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in odd)
    assert all(r["grown_shard"] in (r["shard"], 24) and r["law"] == "key" for r in got)
    assert sharding.assign_shards(docs_of([]), "doc_id", [1.0]).count() == 0
    assert dict(sharding.assign_shards(extra, "doc_id", [1.0]).dtypes)["slot"] == "bigint"
