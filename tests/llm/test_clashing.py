"""op4 and op7 on tables whose extra columns are named like their own."""
import public_tokenizers
from pyspark.sql import functions as F

from dockplan.llm import bpe_chunks, chat

TOKENIZER = public_tokenizers.path(bpe_chunks.TOKENIZER)


def test_encoding_with_clashing_columns(extra):
    table = extra.withColumn("_text", F.lit("mine")).withColumn("decoded", F.lit("mine")).withColumn("doc_id", F.col("doc_id").cast("string"))
    keep = ("doc_id", "lang", "ids", "decoded", "_text", "score")
    out = bpe_chunks.encode_documents(table, "text", TOKENIZER, keep)
    assert out.columns == ["doc_id", "lang", "_text", "score", "ids", "decoded"] and dict(out.dtypes)["ids"] == "binary"
    got, plain = out.collect(), bpe_chunks.encode_documents(table, "text", TOKENIZER, ("doc_id",)).collect()
    assert {(r["_text"], r["score"], r["lang"]) for r in got} == {("mine", "mine", "en")}
    key = lambda r: (str(r["doc_id"]), bytes(r["ids"]), r["decoded"])
    assert sorted(map(key, got)) == sorted(map(key, plain)) and len(got) == extra.count()


def test_chat_with_clashing_columns(spark, folder):
    rows = [(1, 0, "user", "hi # there"), (1, 1, "assistant", None), (None, 0, "assistant", "x" * 300), (2, 0, None, ""), (2, 0, None, "")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = given.select("*", *[F.lit("mine").alias(c) for c in ("conv", "message", "seq", "kind", "position", "segment", "_i", "log")])
    a, b = (sorted(map(str, chat.op7_event_sourced_chat(spark, folder(conversations=t)).collect())) for t in (given, clashing))
    assert a == b and len(a) == 4
