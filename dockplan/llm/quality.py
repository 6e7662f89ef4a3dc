"""Threshold table compiled into one projection (operator 6).

A rule is a row of ``RULES``: a metric with a lowest and a highest accepted value. ``compile_rules`` turns the table into
one SQL projection over the text's counters; nothing leaves the row, so there is no shuffle, and no user function.

Counters (words are maximal runs of non-space characters): n_words, word_chars, n_symbols, n_dup_lines,
n_repeat_words, n_letters, n_upper, n_stop_words, n_lines, n_bullet_lines, n_ellipsis_lines. Repeated 5-word windows are
found on 64-bit hashes of five word hashes; only a text with a repeated hash sorts its windows.

Defined cases. A null text is the empty text: all counters 0, ``base_failed``. Ratios over 0 words or lines are 0. Texts are read
whole. Repeated rows are judged alike. An empty table gives an empty result. Columns that clash with a counter's name are
replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockplan.llm.common import SPACE_CHARS, lower_ascii, split_words, table, whole_text

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it on was with be as by this are "
    "der die das und den von zu mit ist nicht ein eine im auf des sich "
    "le la les des et en un une du que qui dans pour pas sur au "
    "el los las del y por con para su al lo como se es"
).split()

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Accept when ``low <= metric <= high``; ``metric`` is SQL over the counters."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Production thresholds; a ratio over nothing is 0.
RULES = (
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 20.0),
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", None, 0.1),
    Rule("upper_case", "n_upper / greatest(n_letters, 1)", None, 0.5),
    Rule("letters_per_char", "n_letters / greatest(word_chars, 1)", 0.6, None),
    Rule("stop_words", "if(n_words < 50, 1.0, n_stop_words / n_words)", 0.01, None),
    Rule("duplicate_lines", "if(n_lines < 4, 0.0, n_dup_lines / n_lines)", None, 0.3),
    Rule("bullet_lines", "if(n_lines < 4, 0.0, n_bullet_lines / n_lines)", None, 0.9),
    Rule("ellipsis_lines", "if(n_lines < 4, 0.0, n_ellipsis_lines / n_lines)", None, 0.3),
)

COUNTERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper",
            "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def covered_words(windows: Column, width: int) -> Column:
    """Word positions inside a window whose hash occurs at least twice in ``windows``."""

    def positions(ordered: Column) -> Column:
        same = lambda i, x: F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(ordered, lambda x, i: same(i - 1, x) | same(i + 1, x))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def total(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - p, F.lit(width))))
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

    paired = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # A one-element array binds each intermediate once for the lambda below it.
    bound = F.transform(F.array(F.sort_array(paired)), positions)
    counted = F.get(F.transform(bound, total), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted)


def counters(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counters of its texts."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in COUNTERS]
    names = [c for c in df.columns if c not in COUNTERS]
    t = F.col("_t")
    df = df.select(*keep, whole_text(f"`{text}`").alias("_t"))
    df = df.select(*[F.col(f"`{c}`") for c in names], "_t", split_words(t).alias("_w"),
                   F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("_l"))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    h = F.col("_h")
    starts = F.when(F.size("_h") >= WINDOW, F.sequence(F.lit(0), F.size("_h") - WINDOW)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_g", F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
    lines = F.col("_l")
    n = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.translate(t, SPACE_CHARS, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered_words(F.col("_g"), WINDOW),
        "n_letters": removed(t, r"\p{L}+"),
        "n_upper": removed(t, r"\p{Lu}+"),
        "n_stop_words": F.size(F.filter("_w", lambda w: lower_ascii(w).isin(STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
    }
    return df.select(*[F.col(f"`{c}`") for c in names], *[c.cast("long").alias(k) for k, c in n.items()])


def compile_rules(rules: tuple[Rule, ...]) -> list[Column]:
    """One boolean ``pass_<rule>`` column per row of the table."""

    def one(r: Rule) -> Column:
        m = F.expr(f"double({r.metric})")
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (m >= r.low)
        if r.high is not None:
            ok = ok & (m <= r.high)
        return ok.alias(f"pass_{r.name}")

    return [one(r) for r in rules]


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with counters, ``pass_*`` verdicts, ``base_failed`` and ``kept``."""
    out = counters(df, text)
    base = (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))
    out = out.select("*", *compile_rules(rules), base.alias("base_failed"))
    ok = ~F.col("base_failed")
    for r in rules:
        ok = ok & F.col(f"pass_{r.name}")
    return out.withColumn("kept", ok)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The production table over every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", *[f"pass_{r.name}" for r in RULES])
