"""A training corpus from ``documents`` in five stages, each one of the ``llm`` operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared folder and reads it
back as the next one's documents, so a lost executor never reaches behind the last table. All but the last return the
columns of ``documents``.

Rows with nulls, empty or repeated texts pass as the operators define. Toxic documents go; of each near-duplicate component one
row stays, that with the smallest id (null ids last, then by text hash and the other columns), whatever other texts share its id
(documents without words are all kept, of rows that repeat an id and all else one stays); documents with a benchmark leak go; personal data and the terms that disclose it are replaced in the text and
``n_chars`` follows; the rest is encoded.

Columns other than ``doc_id`` and ``text`` take other names inside a stage and their own again behind it, so whatever they are called,
none meets a column that an operator adds; but for ``n_chars``, their values pass all four filtering stages untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockplan.llm import bpe_chunks, decontamination, ngram_join, pii, toxicity
from dockplan.llm.common import stored, table, whole_text


#: Parts that the rows of one component are dealt in.
SALTS = 32


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but id and text under names that no operator uses, and those names by the columns' own."""
    names = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def together(out: DataFrame, names: dict[str, str]) -> DataFrame:
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    inside, names = apart(docs)
    scorer = toxicity.ToxicityScorer(spark, inside, table(spark, sf_dir, "labels"))
    return together(scorer.score(inside, keep_text=True).where("predicted = 0"), names)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component stays, the one with the smallest (id, hash of the text), null ids last."""
    docs, names = apart(docs)
    classes = stored(ngram_join.near_duplicate_classes(docs)).select("doc_id", "mark", "component", F.col("n_shingles").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    several = classes.where("n > 0").groupBy("component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
    # A component may hold a third of all rows: its rows are dealt by their texts' hashes.
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    several = several.where("rows > 1").select("component", "first", salt)
    worded = classes.where("n > 0").withColumn("salt", F.pmod("mark", F.lit(SALTS)).cast("int"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    met = worded.join(several, ["component", "salt"]).select("doc_id", "mark", stays.alias("stays"), F.lit(True).alias("worded"))
    wordless = classes.where("n = 0").select("doc_id", "mark", F.lit(True).alias("stays"), F.lit(False).alias("worded"))
    # Rows that stay and occur once are not listed.
    gone = met.unionAll(wordless).groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.max("stays").alias("stays"), F.max("worded").alias("worded"), F.count(F.lit(1)).alias("_rows"))
    gone = gone.where("not stays or _rows > 1").drop("_rows")
    at = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(whole_text("text")) == F.col("_mark"))
    marked = docs.join(gone, at, "left")
    once = marked.where(F.col("stays").isNull()).select(docs.columns)
    # Only rows that repeat an id and text are compared with each other: of worded ones the smallest stays, of others each different one.
    smallest = marked.where("stays and worded").groupBy("_id", "_mark").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    repeated = marked.where("stays and not worded").select(docs.columns).distinct()
    return together(once.unionByName(smallest).unionByName(repeated), names)


def drop_benchmark_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, copied or edited, go."""
    docs, names = apart(docs)
    leaks = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    ids = leaks.select(F.col("doc_id").alias("_id")).distinct()
    return together(docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left_anti"), names)


def sanitise_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced."""
    inside, names = apart(docs)
    out = pii.sanitise(inside)
    if "n_chars" in docs.columns:
        out = out.withColumn(names["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
    return together(out, names)


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document (raw, little-endian), with digests of the ids and of the decoded text."""
    import public_tokenizers

    def finish(batch, ids, decoded):
        return bpe_chunks.digests(batch, ids, decoded).assign(ids=[x.tobytes() for x in ids])

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = bpe_chunks.encode_documents(source, "text", public_tokenizers.path(bpe_chunks.TOKENIZER), ("doc_id",), finish,
                                      "n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", sanitise_personal_data),
    ("encoding", encode),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
