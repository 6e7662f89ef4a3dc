"""op2's co-occurrence part: PMI and disclosure against brute force, and terms that only a recurring part of the values gives away."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dockplan.llm import pii

RULES = pii.Disclosure()


def corpus(seed=0):
    """Forty addresses of one domain, all different, each beside the name of its owner; noise; the name nowhere else."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = []
    for i in range(40):
        docs.append(f"{some(30)} Brightwater mail u{i}x{r.randrange(999)}@corp.example.org {some(30)}")
        docs.append(f"{some(30)} mail {some(1)}{i}@free.example.net {some(30)}")
        docs.append(f"{some(30)} host 10.7.{i}.{r.randrange(200)} Zephyrion {some(30)}")
        docs.append(f"{some(40)} mail {some(20)}")
    return [(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(docs)]


def shared(kind, value):
    v, digits = value.lower(), re.sub("[^0-9]", "", value)
    if kind == "email":
        yield from (f"local:{v.split('@')[0]}", f"domain:{v.split('@')[-1]}")
    elif kind == "ip":
        yield from ("network:" + ".".join(v.split(".")[:n]) for n in (2, 3))
    else:
        yield f"{kind}-prefix:{digits[:6]}"
    yield f"{kind}:{v}"


def terms(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def brute_force(rows):
    """entity, term -> disclosure, from rows (row number, text, base spans)."""
    beside, mentions, holds, contexts = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for d, (text, spans) in rows.items():
        for t in set(terms(text)):
            holds[t].add(d)
        for kind, start, end, value in spans:
            first, last = max(0, start - 60), min(len(text), end + 60)
            left, right = text[first:start], text[end:last]
            left = re.sub(r"^[^\W_]+", "", left) if first else left
            right = re.sub(r"[^\W_]+$", "", right) if last < len(text) else right
            near = frozenset(terms(left + " " + right))
            for e in shared(kind, value):
                mentions[e].add(d)
                for t in near:
                    beside[e, t].add(d)
                    contexts[e, t].add(near)
    n, out = len(rows), {}
    for (e, t), docs in beside.items():
        if len(contexts[e, t]) >= RULES.min_contexts and len(mentions[e]) < n:
            pmi = math.log2(n * len(docs) / (len(mentions[e]) * len(holds[t])))
            score = pmi / math.log2(n / len(mentions[e]))
            if score >= RULES.generalise_at:
                out[e, t] = score
    return out


def test_disclosure_against_brute_force(spark, docs_of):
    docs = docs_of(corpus()).select("doc_id", "text").withColumn("_mark", F.xxhash64("text"))
    spanned = pii.with_base_spans(docs, "text")
    rows = {i: (r["text"], [tuple(s) for s in r["base"]]) for i, r in enumerate(spanned.collect())}
    _, flagged = pii.disclosing_terms(spanned, "doc_id", "text", RULES)
    got = {(r["entity"], r["term"]): r["disclosure"] for r in flagged.collect()}
    assert got == pytest.approx(brute_force(rows), abs=1e-9)
    assert got["domain:corp.example.org", "brightwater"] == pytest.approx(1) and got["network:10.7", "zephyrion"] == pytest.approx(1)
    assert not any(t == "mail" for _, t in got)


def test_terms_of_a_shared_part_are_spans(spark, docs_of):
    """The owner's name goes wherever it stands beside such a value; ids that several texts share do not mix their terms."""
    rows = corpus()
    out = pii.with_spans(docs_of(rows).select("doc_id", "text"), "doc_id", "text").collect()
    assert len(out) == len(rows)
    for r in out:
        added = {s["value"] for s in r["added"]}
        assert ("Brightwater" in added) == ("Brightwater" in r["text"])
        assert ("Zephyrion" in added) == ("Zephyrion" in r["text"])
        assert all(r["text"][s["start"]:s["end"]] == s["value"] for s in [*r["base"], *r["added"]])
    text = pii.sanitise(docs_of(rows).select("doc_id", "text")).where("text LIKE '%[EMAIL]%'").first()["text"]
    assert "Brightwater" not in text and "@" not in text


def test_no_python_in_the_plan(spark, docs_of):
    plan = pii.with_spans(docs_of(corpus()), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
