"""The pipeline's stages take effect and leave clean documents alone."""
import random

from pyspark.sql import functions as F

import corpus_pipeline
from dockplan.llm.common import stored

from tests.llm.test_models import labelled, made


def test_pipeline(spark, folder, odd):
    rng = random.Random(21)
    docs, labels = labelled(spark, folder, 400)
    odd = [(None if i is None else 5000 + i, t) for i, t in odd]
    passage = made(rng, 40)
    planted = [(1000, docs[1][1] + " tail"), (1001, made(rng, 50) + " " + passage + " " + made(rng, 30)),
               (1002, made(rng, 40) + " mail anna@mail.example.com now " + made(rng, 20)), (1003, docs[401 % 400][1])]
    d = folder(documents=docs + planted + odd, labels=labels,
               benchmark=spark.createDataFrame([(1, passage)], "item_id long, text string"))
    table = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        table = stored(stage(spark, table, d))
        seen[name] = {r["doc_id"]: r for r in table.collect()}
        if name != "encoding":
            assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 1000 in seen["toxicity"] and 1000 not in seen["near_duplicates"] and 1003 not in seen["near_duplicates"]
    toxic = [i for i, _ in docs if i % 4 == 0]
    assert sum(i in seen["toxicity"] for i in toxic) < 0.1 * len(toxic)
    clean = [i for i, _ in docs if i % 4]
    assert sum(i in seen["personal_data"] for i in clean) > 0.97 * len(clean)
    assert 1001 in seen["near_duplicates"] and 1001 not in seen["decontamination"]
    text = seen["personal_data"][1002]["text"]
    assert "[EMAIL]" in text and "anna@" not in text and seen["personal_data"][1002]["n_chars"] == len(text)
    assert set(seen["encoding"]) == set(seen["personal_data"]) and None in seen["encoding"] and 5003 in seen["encoding"]
    assert seen["encoding"][5003]["n_tokens"] == 0


def test_run_and_registry(spark, sample):
    import __spark_entry__ as entry

    names = [k for k in entry.queries() if k.startswith("op")]
    assert {int(k[2:].split("_")[0]) for k in names if k[2].isdigit()} == set(range(1, 14)) and "pipeline" in entry.queries()
    out = corpus_pipeline.run(spark, sample)
    assert 100 < out.count() < 200 and out.columns[0] == "doc_id"


def test_columns_of_any_name_pass_untouched(spark, folder):
    """Columns named like those that the stages and operators add keep their values through all four filtering stages."""
    rng = random.Random(4)
    docs, labels = labelled(spark, folder, 300)
    docs += [(900, docs[3][1] + " tail"), (901, made(rng, 30) + " mail anna@mail.example.com now " + made(rng, 20))]
    d = folder(documents=docs, labels=labels, benchmark=spark.createDataFrame([(1, made(rng, 40))], "item_id long, text string"))
    names = ["stays", "worded", "score", "predicted", "evidence", "base", "added", "_id", "_mark", "first", "component", "salt", "mark",
             "column_3", "_t", "_k", "_p", "_terms", "toxic", "part", "item_id", "n", "rid", "label"]
    table = spark.read.parquet(f"{d}/documents.parquet")
    table = stored(table.select("*", *[F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names]))
    columns = table.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in table.select("doc_id").collect()}
        table = stored(stage(spark, table, d))
        assert table.columns == columns, name
        rows = table.collect()
        assert rows and {r["doc_id"] for r in rows} <= before
        assert all(r[n] == f"{n} of {r['doc_id']}" for r in rows for n in names), name
    assert "[EMAIL]" in next(r["text"] for r in rows if r["doc_id"] == 901)
    assert corpus_pipeline.STAGES[-1][1](spark, table, d).count() == len(rows)
