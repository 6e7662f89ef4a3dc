"""op1 on passages that hold one item many times."""
import random

import numpy as np

from dockplan.llm import decontamination
from tests.llm.test_models import made


def test_many_copies_in_one_passage(docs_of, spark):
    rng = random.Random(31)
    item = made(rng, 20)
    text = " ".join([made(rng, 5) + " " + item] * 2500)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontamination.decontaminate(docs_of([(7, text)]), bench).collect()
    assert len(got) == 2500 and all(text[r["start"]:r["end"]] == item and r["score"] == 1.0 for r in got)


def test_windows_find_what_the_whole_passage_holds():
    def whole(item, passage, least):
        best, end = decontamination.align(item, passage) if len(passage) else (0, 0)
        score = best / (decontamination.MATCH * len(item))
        if score < least:
            return []
        start = end - decontamination.align(item[::-1], passage[:end][::-1])[1]
        right = [(s, a + end, b + end) for s, a, b in whole(item, passage[end:], least)]
        return [*whole(item, passage[:start], least), (score, start, end), *right]

    rng = random.Random(32)
    for _ in range(40):
        item, parts = list(range(1, rng.randint(8, 30))), []
        for _ in range(rng.randint(1, 25)):
            copy = [y for x in item for y in rng.choice([[x]] * 8 + [[], [rng.randint(100, 9999)], [x, rng.randint(100, 9999)]])]
            parts += copy + [rng.randint(100, 9999) for _ in range(rng.randint(0, 40))]
        item, passage = np.array(item, dtype=np.uint64), np.array(parts, dtype=np.uint64)
        assert decontamination.leaks_in(item, passage, 0.5) == whole(item, passage, 0.5)
