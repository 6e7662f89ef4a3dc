"""The pipeline's near-duplicate stage decides by row: null ids, and ids that different texts share."""
import random

import corpus_pipeline

from tests.llm.test_models import made


def test_one_row_of_each_component_stays(spark, docs_of):
    rng = random.Random(51)
    a, b, c, d, e, f = (made(rng, 60) for _ in range(6))
    rows = [(None, a), (None, a + " tail"), (None, b)]  # null ids alone, beside a null id that stands alone
    rows += [(1, c), (2, c + " tail"), (2, d)]  # a copy whose id has another text
    rows += [(3, e), (None, e + " tail"), (4, f), (4, f), (4, f)]
    rows += [(5, ""), (5, ""), (None, None), (None, ""), (6, " ")]  # without words
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), None).select("doc_id", "text").collect()]
    worded = [r for r in got if (r[1] or "").strip()]
    assert sorted(map(str, worded)) in [sorted(map(str, [x, (None, b), (1, c), (2, d), (3, e), (4, f)])) for x in rows[:2]]
    assert sorted(map(str, (r for r in got if r not in worded))) == sorted(map(str, [(5, ""), (None, None), (None, ""), (6, " ")]))
