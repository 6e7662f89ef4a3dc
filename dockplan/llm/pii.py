"""Personal data and the terms that give it away (operator 2), in DataFrame functions alone.

Base spans: e-mail, IP, card and phone patterns, leftmost and non-overlapping per kind; matches that fail their check
(octet over 255, digit count, Luhn) are dropped without a retry. Offsets are code points: a text split at its matches
gives the pieces between them, and running sums of piece and match lengths give the starts.

Added spans, by co-occurrence in the corpus. A protected entity e is a distinct base value, or what several values share: an
e-mail's domain or its local part, the first two or three parts of an IP, the first six digits of a card or phone. So a term that gives
away whose addresses or numbers these are is found although no single value recurs. Contexts of e are the
``context_chars`` characters on either side of a mention, cut to whole terms. With N documents, n(e) that mention e, n(t) that
hold term t and n(e, t) in which t stands in a context of e,

    IC(e) = log2(N / n(e))        PMI(e; t) = log2(N * n(e, t) / (n(e) * n(t)))

and disclosure(e, t) = PMI / IC: 1 when t occurs nowhere but beside e, 0 when independent. A term needs ``min_contexts``
different contexts beside e, so copies of one passage are one piece of evidence. From ``generalise_at`` on, the term is
generalised (its shape class stands for it); from ``remove_at`` on, it is removed. Both hold for its occurrences inside
the contexts' documents.

Scale: the pattern scan is one projection. Document counts of terms are summed per task before their shuffle, on 64-bit
term hashes; a hot term or entity is a count, never a collected group. What is collected per document (its flagged terms) is
bounded by the document's own contexts.

Defined cases. A null text is the empty text: no spans. Repeated rows each get their result; rows that share an id, a null one
too, are told apart by their texts. Texts are read whole. An empty table gives an empty result. Other columns are kept by ``sanitise``; columns it adds replace same-named ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import stored, table, whole_text

# The four patterns. Possessive loops and the guards before a match change no match; they keep
# the scan linear on long runs and its recursion flat. (\G admits a match that starts where the last one ended.)
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A match of the card pattern is a maximal run of digits with single separators; only those of 13 to 19 digits can stand.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PATTERNS = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
#: Cheap tests that a text without the pattern's fixed characters can't match.
NEEDS = {"email": r"@", "phone": r"\+[0-9]"}

LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds of the co-occurrence part."""

    context_chars: int = 60
    min_contexts: int = 3
    generalise_at: float = 0.8
    remove_at: float = 0.95


def running_starts(pieces: Column, matches: Column) -> Column:
    """Start of each match, from the lengths of the pieces before it and of the earlier matches."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        return F.struct((start + F.length(x["m"])).alias("at"), F.concat(acc["starts"], F.array(start)).alias("starts"))

    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    return F.aggregate(pairs, zero, step, lambda acc: acc["starts"])


def located(kind: Column, found: Column, pieces: Column) -> Column:
    """Spans of the matches ``found`` of a text, given the ``pieces`` between them."""
    starts = running_starts(pieces, found)
    return F.zip_with(
        starts, found,
        lambda s, m: F.struct(kind.alias("kind"), s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")),
    )


def digits_only(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def octets_valid(v: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(v, r"\."), small)


def stands(kind: str, span: Column) -> Column:
    v = span["value"]
    if kind == "ip":
        return octets_valid(v)
    if kind == "card":
        return luhn(digits_only(v))
    if kind == "phone":
        return F.length(digits_only(v)).between(9, 15)
    return F.lit(True)


def _standing(kind: str):
    return lambda span: stands(kind, span)


def with_base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``base``: the base spans, by kind as listed, then start. The text column must have no nulls."""
    t = F.col(text)
    none = F.array().cast("array<string>")

    def found(kind: str, pattern: str) -> Column:
        m = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return F.when(t.rlike(NEEDS[kind]), m).otherwise(none) if kind in NEEDS else m

    step = df.select("*", *[found(k, p).alias(f"_{k}") for k, p in PATTERNS])
    spans = []
    for k, p in PATTERNS:
        m = F.col(f"_{k}")
        s = F.filter(located(F.lit(k), m, F.split(t, p)), _standing(k))
        spans.append(F.when(F.size(m) > 0, s).otherwise(F.array().cast(SPAN)))
    return step.select("*", F.concat(*spans).alias("base")).drop(*[f"_{k}" for k, _ in PATTERNS])


def terms_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def context_terms(text: Column, span: Column, chars: int) -> Column:
    """Whole terms beside a mention; a term cut by the border of the context is left out."""
    first = F.greatest(span["start"] - chars, F.lit(0))
    left = F.substring(text, first + 1, span["start"] - first)
    right = F.substring(text, span["end"] + 1, F.lit(chars))
    left = F.when(first > 0, F.regexp_replace(left, r"^[\p{L}\p{N}]+", "")).otherwise(left)
    right = F.when(span["end"] + chars < F.length(text), F.regexp_replace(right, r"[\p{L}\p{N}]+$", "")).otherwise(right)
    return F.array_distinct(terms_of(F.concat(left, F.lit(" "), right)))


def entities_of(span: Column) -> Column:
    """The protected entities that a base span mentions: its value, and what it shares with other values of its kind."""
    v, kind = F.lower(span["value"]), span["kind"]
    digits, parts = digits_only(v), F.split(v, r"[.@]")
    email = F.array(F.concat(F.lit("local:"), F.substring_index(v, "@", 1)), F.concat(F.lit("domain:"), F.substring_index(v, "@", -1)))
    ip = F.array(*[F.concat(F.lit("network:"), F.array_join(F.slice(parts, 1, n), ".")) for n in (2, 3)])
    number = F.array(F.concat(kind, F.lit("-prefix:"), F.substring(digits, 1, 6)))
    shared = F.when(kind == "email", email).when(kind == "ip", ip).otherwise(number)
    return F.concat(F.array(F.concat_ws(":", kind, v)), shared)


def disclosing_terms(spanned: DataFrame, key: str, text: str, rules: Disclosure) -> tuple[DataFrame, DataFrame]:
    """(contexts: key, _mark, entity, term, context hash) and (flagged: entity, term, disclosure) from texts with ``base`` and ``_mark``."""
    row = (key, "_mark")
    mentions = (
        spanned.where(F.size("base") > 0)
        .select(*row, F.col(text), F.explode("base").alias("s"))
        .select(*row, F.explode(entities_of(F.col("s"))).alias("entity"), context_terms(F.col(text), F.col("s"), rules.context_chars).alias("terms"))
    )
    contexts = stored(mentions.select(*row, "entity", F.xxhash64("terms").alias("context"),
                                      F.explode_outer("terms").alias("term")))
    pairs = contexts.where(F.col("term").isNotNull()).distinct()
    support = (
        pairs.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_contexts"))
        .where(F.col("n_contexts") >= rules.min_contexts)
    )
    together = pairs.select(*row, "entity", "term").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
    n_e = contexts.select(*row, "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    words = spanned.select(F.explode(F.array_distinct(F.transform(terms_of(F.col(text)), lambda w: F.xxhash64(w)))).alias("_h"))
    n_t = words.groupBy("_h").agg(F.count(F.lit(1)).alias("n_t"))
    total = spanned.agg(F.count(F.lit(1)).alias("n_all"))
    scored = (
        support.join(together, ["entity", "term"]).join(n_e, "entity")
        .withColumn("_h", F.xxhash64("term")).join(n_t, "_h").withColumn("n_all", total.scalar())
    )
    ic = F.log2(F.col("n_all") / F.col("n_e"))
    pmi = F.log2(F.col("n_all") * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    flagged = scored.where(F.col("n_e") < F.col("n_all")).select("entity", "term", (pmi / ic).alias("disclosure"))
    return contexts, flagged.where(F.col("disclosure") >= rules.generalise_at)


def shape_class(value: Column) -> Column:
    """What a generalised term is replaced by."""
    return (F.when(value.rlike(r"^\p{N}+$"), "[NUMBER]").when(value.rlike(r"\p{N}"), "[CODE]")
            .when(value.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))


def with_spans(df: DataFrame, key: str, text: str, rules: Disclosure = Disclosure()) -> DataFrame:
    """``df`` with ``base`` and ``added`` spans; ``added`` kinds are ``generalise`` and ``remove``."""
    kept = [c for c in df.columns if c not in ("base", "added")]
    source = df.select(*[F.col(f"`{c}`") for c in kept]).withColumn(text, whole_text(text)).withColumn("_mark", F.xxhash64(text))
    spanned = with_base_spans(source, text)
    contexts, flagged = disclosing_terms(with_base_spans(source.select(key, "_mark", text), text), key, text, rules)
    per_row = (
        contexts.join(flagged, ["entity", "term"])
        .groupBy(key, "_mark", "term").agg(F.max("disclosure").alias("disclosure"))
        .groupBy(F.col(key).alias("_k"), F.col("_mark").alias("_m")).agg(F.sort_array(F.collect_list(F.struct("term", "disclosure"))).alias("_terms"))
    )
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_mark") == F.col("_m"))
    out = spanned.join(per_row, same, "left").drop("_k", "_m", "_mark")
    t = F.col(text)
    words = F.transform("_terms", lambda x: x["term"])
    # Terms hold letters and digits only, so they need no quoting.
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    out = out.withColumn("_p", pattern)
    found = F.regexp_extract_all(t, F.col("_p"), F.lit(0))
    scores = F.map_from_entries(F.col("_terms"))
    removed = lambda v: F.coalesce(F.try_element_at(scores, F.lower(v)), F.lit(0.0)) >= rules.remove_at
    spans = F.transform(
        located(F.lit("term"), found, F.split(t, F.col("_p"))),
        lambda x: F.struct(F.when(removed(x["value"]), "remove").otherwise("generalise").alias("kind"),
                           x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")),
    )
    apart = F.filter(spans, lambda x: ~F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])))
    added = F.when(F.col("_terms").isNull(), F.array().cast(SPAN)).otherwise(apart)
    return out.withColumn("added", added).drop("_terms", "_p")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; of overlapping spans the first, longest one stands."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s.alias("s"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def replacement(s: Column) -> Column:
        base = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
        return (F.when(s["kind"] == "remove", F.lit("[REMOVED]")).when(s["kind"] == "generalise", shape_class(s["value"]))
                .otherwise(F.element_at(base, s["kind"])))

    def step(acc: Column, x: Column) -> Column:
        s = x["s"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        new = F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(gap, replacement(s))).alias("parts"))
        return F.when(s["start"] < acc["at"], acc).otherwise(new)

    def close(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, step, close))


def sanitise(df: DataFrame, key: str = "doc_id", text: str = "text", rules: Disclosure = Disclosure()) -> DataFrame:
    """``df`` with its texts sanitised, and the spans that were replaced."""
    out = with_spans(df, key, text, rules)
    return out.withColumn(text, sanitised(F.col(text), F.concat("base", "added")))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_information_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_spans(docs, "doc_id", "text")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", *[count(k) for k, _ in PATTERNS], F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.concat("base", "added")).alias("spans"),
    )
