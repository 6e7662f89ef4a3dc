"""op5 on runs of letters longer than the order."""
import random

from dockplan.llm import toxicity
from tests.llm.test_models import labelled, made


def test_insults_inside_long_runs_are_scored(spark, folder, docs_of):
    docs, labels = labelled(spark, folder)
    rng = random.Random(41)
    scorer = toxicity.ToxicityScorer(spark, docs_of(docs), labels)
    rows = []
    for i in range(20):
        before, after = made(rng, 6).replace(" ", ""), made(rng, 6).replace(" ", "")
        while len(before) <= toxicity.ORDER:
            before += made(rng, 1)
        insult = "" if i % 2 else "zzgrump"
        rows.append((i, f"{made(rng, 10)} {before}{insult}{after if i % 4 < 2 else ''} {made(rng, 10)}"))
    score = {r["doc_id"]: r["score"] for r in scorer.score(docs_of(rows)).collect()}
    assert min(score[i] for i in range(0, 20, 2)) > max(score[i] for i in range(1, 20, 2))
    assert all(score[i] >= toxicity.THRESHOLD for i in range(0, 20, 2))


def test_pieces():
    word = "abcdefghijklmnopqr"
    assert toxicity.words_of("Kurz " + word) == ["kurz", *[word[k:k + 16] for k in range(18)]]
    assert toxicity.words_of("x" * 16) == ["x" * 16]
