import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text) pairs -> a documents table."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def folder(spark, docs_of, tmp_path_factory):
    """A folder of tables, by name -> DataFrame or documents rows."""

    def make(**tables):
        d = tmp_path_factory.mktemp("tables")
        for name, t in tables.items():
            (docs_of(t) if isinstance(t, list) else t).write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return make


@pytest.fixture(scope="session")
def sample():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, sample):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()}


#: Nulls, empty, repeated rows, odd white space, scripts beyond Latin, long texts.
ODD = [
    (None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "a b c d e"), (5, "a b c d e"), (6, "A B C D E"),
    (7, "Über straße — naïve café ÉÀÇ"), (8, "日本語 テキスト Привет мир"), (9, "it's <|endoftext|> x  y   z \n"),
    (10, "word " * 6000), (11, "x" * 9000), (12, "1 2 3 4 5\n" * 50), (13, "a b   c\n\n\nd"),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)


@pytest.fixture(scope="session")
def extra(docs_of):
    """The odd rows with extra columns whose names clash with what operators add."""
    names = ("score", "shard", "slot", "n_words", "kept", "base", "added", "evidence", "predicted", "item_id", "start", "ids")
    return docs_of(ODD).select("*", *[F.lit("mine").alias(c) for c in names])
