"""Chat transcripts rebuilt from an event log and rendered (operator 7).

Events are (conv, seq, message, kind, role, text). Kinds: ``open`` starts a message (role, first text), ``delta`` appends to
it, ``edit`` replaces its text, ``regenerate`` empties it for the deltas that follow, ``delete`` takes it out. ``fold_events``
groups by (conversation, message), sorts by sequence and folds from the last event that sets the text; a message stands where
its first event stands. ``render`` turns each final message into one segment of the transcript:

    ### <role>: <text> </turn>\\n

Inside roles and texts a backslash, ``#``, ``<`` and (roles) ``:`` get a backslash before them, so no marker can occur in
them and ``parse`` gives both back exactly. The loss mask is a range of code points per segment: the text of assistant turns.

Scale: the fold's groups are single messages. Segments, not whole conversations, are rows, and are parsed where they are; a
conversation's digests take its turns as one sorted stream, since sha256 has no partial sums, in constant memory. Messages are numbered by
ranges of their order (``numbered``), so nothing else of a long conversation meets in one task.

Defined cases. Null texts and roles are empty; null kinds are deltas. A null conversation id is a conversation of its own. Events that tie
in sequence go by kind, role, text. Rows that repeat (conversation, turn) are separate turns, ordered by role and text. Empty
tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.functions.ordering import ROWS_PER_BUCKET, key_bounds
from dockplan.llm.common import ship, stored, table

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
SEGMENT = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*) </turn>\n", re.S)
UNESCAPE = re.compile(r"\\(.)", re.S)
LOSS_ROLE = "assistant"
SETS_TEXT = ("open", "edit", "regenerate")


def escaped(c: Column, marks: str = "#<") -> Column:
    return F.regexp_replace(c, rf"([\\{marks}])", r"\\$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv, position (sequence of the first event), role, text."""
    e = events.select(
        "conv", "message", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = e.groupBy("conv", "message").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"))
    log = F.col("log")
    last = F.aggregate(F.transform(log, lambda x, i: F.when(x["kind"].isin(*SETS_TEXT), i).otherwise(0)),
                       F.lit(0), lambda a, b: F.greatest(a, b))
    grouped = grouped.withColumn("_from", last)
    parts = F.transform(F.filter(log, lambda x, i: (i >= F.col("_from")) & ~x["kind"].isin("regenerate", "delete")), lambda x: x["text"])
    opened = F.get(F.filter(log, lambda x: x["kind"] == "open"), F.lit(0))
    out = grouped.where(~F.exists(log, lambda x: x["kind"] == "delete")).select(
        "conv", F.get(log, F.lit(0))["seq"].alias("position"), "message",
        F.coalesce(opened["role"], F.get(log, F.lit(0))["role"]).alias("role"), F.array_join(parts, "").alias("text"))
    return out


def render(messages: DataFrame) -> DataFrame:
    """One segment per message, with the code points of the segment that carry loss (empty range: none)."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), "#<:"), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    m = messages.select("conv", "position", "message", "role", head.alias("_head"), body.alias("_body"))
    start = F.length("_head")
    end = F.when(F.col("role") == LOSS_ROLE, start + F.length("_body")).otherwise(start)
    return m.select("conv", "position", "message", F.concat("_head", "_body", F.lit(CLOSE)).alias("segment"),
                    start.alias("loss_start"), end.alias("loss_end"))


def unescape(s: str) -> str:
    return UNESCAPE.sub(r"\1", s)


def parse(transcript: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered transcript."""
    out, at = [], 0
    while at < len(transcript):
        m = SEGMENT.match(transcript, at)
        if not m:
            raise ValueError(f"no turn at code point {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


TURNS = "turns long, said binary, loss binary, loss_is_text boolean, loss_chars long, chars long"


def read_segment(segment: pd.Series, loss_start: pd.Series, loss_end: pd.Series) -> pd.DataFrame:
    """What a segment says, and what of it is under the loss mask (null where that is just the text of its one turn)."""
    rows = []
    for s, a, z in zip(segment, loss_start, loss_end):
        found, loss = parse(s), unescape(s[a:z])
        same = len(found) == 1 and loss == found[0][1]
        said = "".join(f"{role}\n{text}\n" for role, text in found)
        rows.append((len(found), said.encode("utf-8", "surrogatepass"), None if same else loss.encode("utf-8", "surrogatepass"), same, len(loss), len(s)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in TURNS.split(", ")])


class _Reader:
    """Running digests of one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, turns: int, said: bytes, loss: bytes | None, loss_is_text: bool, loss_chars: int, chars: int) -> None:
        self.all.update(said)
        self.loss.update(said[said.index(b"\n") + 1 : -1] if loss_is_text else loss)
        self.turns += turns
        self.loss_chars += loss_chars
        self.chars += chars

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ_SCHEMA = "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, parsed from its segments in order. Segments are parsed where they are; only the digests, which
    cannot be merged, take the turns of a conversation as one stream."""
    ship(segments.sparkSession)
    columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    parts = [c.split()[0] for c in TURNS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, []
        for pdf in batches:
            for conv, *turn in zip(pdf["conv"], *[pdf[c] for c in parts]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Reader(conv)
                now.add(*turn)
            yield pd.DataFrame(done, columns=columns)
            done = []
        if now is not None:
            yield pd.DataFrame([now.row()], columns=columns)

    read = segments.select("conv", "position", "message", F.pandas_udf(read_segment, TURNS)("segment", "loss_start", "loss_end").alias("read"))
    ordered = read.select("conv", "position", "message", "read.*").repartition("conv").sortWithinPartitions("conv", "position", "message")
    return ordered.select("conv", *parts).mapInPandas(run, READ_SCHEMA)


PROBE_ID = -7
PROBE_TEXT = r"\### Assistant: </turn> ok"
PIECE = 64


COPIES = 1_000  # of a repeated row that are written out at a time


def numbered(conversations: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows with ``message``, their number in the order (conv_id, turn, role, text), nulls first.

    Numbers are a bucket's offset plus the place in the bucket, and buckets are ranges of the order, so neither a long conversation
    nor one turn that many rows share meets in one task; rows that repeat are counted before they are dealt.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = rows.columns
    rows = stored(rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_n")))
    # Buckets go by the beginnings of texts, which stand in the plan.
    begin = ["conv_id", "turn", "role", F.substring("text", 1, PIECE)]
    n_rows = rows.count()
    placed = key_bounds(rows, begin, [], math.ceil(n_rows / rows_per_bucket), n_rows).bucket(rows, begin)
    sums = placed.groupBy("_bucket").agg(F.sum("_n").alias("_sum"))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    offsets = sums.select("_bucket", F.coalesce(F.sum("_sum").over(until(Window.orderBy("_bucket"))), F.lit(0)).alias("_offset"))
    inside = F.coalesce(F.sum("_n").over(until(Window.partitionBy("_bucket").orderBy(*order))), F.lit(0))
    placed = placed.withColumn("_before", inside).join(offsets, "_bucket")
    lots = placed.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("_lot") + COPIES, F.col("_n")) - 1
    return lots.withColumn("_copy", F.explode(F.sequence("_lot", last))).select(
        *order, (F.col("_offset") + F.col("_before") + F.col("_copy")).alias("message"))


EVENT = "array<struct<aside:int,kind:string,text:string>>"


def logged(conversations: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Stored conversations as the log of a client that streams them: an ``open`` and deltas of ``PIECE`` code points.

    By a hash of its number, a fourth of the messages each is streamed at once, begins with a draft and is regenerated, is a draft
    that an edit replaces, or has another draft beside it that is deleted.
    """
    rows = numbered(conversations, rows_per_bucket)

    def event(kind: str, text: Column, aside: int = 0) -> Column:
        return F.struct(F.lit(aside).alias("aside"), F.lit(kind).alias("kind"), text.alias("text"))

    empty, draft = F.lit(""), F.concat(F.lit("(draft) "), F.substring("text", 1, PIECE))
    deltas = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda x: event("delta", x))
    way = F.pmod(F.xxhash64("message"), F.lit(4))
    middle = F.when(way == 1, F.array(event("delta", draft), event("regenerate", empty)).cast(EVENT)).when(
        way == 2, F.array(event("delta", draft)).cast(EVENT)).otherwise(F.array().cast(EVENT))
    rest = F.when(way == 2, F.array(event("edit", F.col("text"))).cast(EVENT)).otherwise(deltas.cast(EVENT))
    aside = F.when(way == 3, F.array(event("open", empty, 1), event("delta", draft, 1), event("delete", empty, 1)).cast(EVENT)).otherwise(
        F.array().cast(EVENT))
    log = F.concat(F.array(event("open", empty)).cast(EVENT), middle, rest, aside)
    steps = rows.select(F.col("conv_id").cast("string").alias("conv"), "message", "role", F.posexplode(log).alias("_i", "_e"))
    return steps.select(
        "conv", (F.col("message") * 2 + F.col("_e.aside")).alias("message"), (F.col("message") * F.lit(1 << 20) + F.col("_i")).alias("seq"),
        F.col("_e.kind").alias("kind"), "role", F.col("_e.text").alias("text"))


def op7_event_sourced_chat(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and the probe conversation, rebuilt, rendered and read back."""
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    back = read_back(render(fold_events(logged(given.unionByName(probe)))))
    return back.withColumn("conv", F.col("conv").cast("long")).withColumnRenamed("conv", "conv_id")
