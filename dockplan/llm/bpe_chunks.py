"""BPE encoding with content-defined chunk reuse (operator 4).

A rolling hash over the last ``WINDOW`` bytes cuts a text where the hash ends in ``CUT_BITS`` zero bits, so equal passages are
cut alike wherever they stand, whatever precedes them. A worker encodes each distinct chunk once and keeps its ids.

Repair of joins. A cut may fall inside a word, where the ids on its two sides are wrong. White space always ends a
pre-token of this tokenizer and nothing it does looks across one, so the encoding of a text equals the concatenated encodings of
its parts when it is cut before white space. Of a chunk only the part between its first and its last white space is therefore
kept as ids (the body); at a join the window grows from the cut to the last white space before it and the first
one after it, across whole chunks without white space if need be, and is encoded anew. At both ends of the window the
repaired ids and the bodies agree exactly, and the result equals that of the library on the whole text.

Chunk bodies and windows are encoded from distinct white-space pieces, which again are encoded once per worker. Both caches
are bounded and emptied when full; what they hold never changes a result.

Scale: one pass over the texts in place, no shuffle; memory is a batch plus the two caches.

Defined cases. A null text is the empty text: no ids, empty decoding. Ids are unsigned little-endian of 2 bytes, or 4
for vocabularies over 65,536. Repeated rows are encoded alike. Texts are read whole. An empty table gives an empty result.
Other columns are dropped except those named in ``keep``; columns that encoding adds replace same-named ones.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockplan.llm.common import power_of_two_at_least, ship, table, whole_text, worker_cache
from dockplan.llm.pieces import LETTERS, Known, Pieces, lower_byte_form, plain_latin

WINDOW = 8  # a power of two
CUT_BITS = 7  # a cut every 128 bytes on average
GAPS = (" ", "\n")
PARTS = re.compile(f"[{LETTERS}]+|[^{LETTERS} ]+")


def byte_values() -> np.ndarray:
    """A pseudo-random 32-bit value per byte, by a fixed rule."""
    x = np.arange(256, dtype=np.uint64)
    x = (x * np.uint64(0x9E3779B1) + np.uint64(0x7F4A7C15)) & np.uint64(0xFFFFFFFF)
    x ^= x >> np.uint64(15)
    x = (x * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)
    return (x ^ (x >> np.uint64(13))).astype(np.uint32)


VALUES = byte_values()


def cut_points(data: bytes) -> np.ndarray:
    """Byte positions to cut at, each the start of a character; a function of the ``WINDOW`` bytes before it alone."""
    b = np.frombuffer(data, dtype=np.uint8)
    if len(b) <= WINDOW:
        return np.zeros(0, dtype=np.int64)
    # A byte k places on is turned by 4 * k bits; the hash of twice as many bytes is that of the first half and the turned one of the second.
    h, k = VALUES[b[:-1]], 1
    while k < WINDOW:
        part = h[k:]
        h = h[:-k] ^ ((part << np.uint32(4 * k)) | (part >> np.uint32(32 - 4 * k)))
        k *= 2
    at = np.flatnonzero((h & np.uint32((1 << CUT_BITS) - 1)) == 0) + WINDOW
    return at[(b[at] & 0xC0) != 0x80]


def edges(chunk: str) -> tuple[int, int]:
    """First and last white space of a chunk, (-1, -1) without one."""
    first = min((i for i in map(chunk.find, GAPS) if i >= 0), default=-1)
    return first, max(map(chunk.rfind, GAPS))


class ChunkEncoder:
    """Texts to ids, with bounded caches of chunks and pieces."""

    def __init__(self, path: str, chunk_limit: int = 100_000, piece_limit: int = 400_000):
        self.pieces = Pieces(path, piece_limit, lower_byte_form)
        self.tokenizer, self.dtype = self.pieces.tokenizer, self.pieces.dtype
        self.known = Known(self.pieces)
        self.chunk_limit = chunk_limit
        self.chunks: dict[bytes, tuple[str, bytes | None, str]] = {}
        tokens = [self.tokenizer.id_to_token(i) for i in range(len(self.pieces.raw))]
        plain = self.tokenizer.decoder is None and None not in tokens
        self.spelled = np.array(tokens, dtype=object) if plain else None

    def _parts(self, text: str) -> list[str]:
        """White-space pieces; of Latin-1 texts without apostrophes, runs of letters and of other characters."""
        return PARTS.findall(text) if plain_latin(text, self.pieces.added) else text.split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.known.trim()
        if len(self.chunks) > self.chunk_limit:
            self.chunks = {}
        chunks, added, known = self.chunks, self.pieces.added, self.known
        plans, fresh, late = [], {}, set()

        def ids_of(parts: list[str]) -> bytes | list[str]:
            """The ids, or the parts as they are where some are not known yet."""
            try:
                return b"".join(map(known.__getitem__, parts))
            except KeyError:
                late.update(x for x in parts if x not in known)
                return parts

        def late_ids(x: bytes | list[str] | None) -> bytes | None:
            return b"".join(map(known.__getitem__, x)) if isinstance(x, list) else x

        for t in texts:
            # What holds of a whole text holds of its chunks and windows; those of other texts are looked at one by one.
            parts_of = PARTS.findall if plain_latin(t, added) else self._parts
            data = t.encode("utf-8", "surrogatepass")
            at = [0, *cut_points(data).tolist(), len(data)]
            plan, window = [], ""
            for a, b in zip(at[:-1], at[1:]):
                p = data[a:b]
                chunk = chunks.get(p) or fresh.get(p)
                if chunk is None:
                    s = p.decode("utf-8", "surrogatepass")
                    a, b = edges(s)
                    chunk = fresh[p] = (s, None, "") if a < 0 else (s[:a], ids_of(parts_of(s[a:b])), s[b:])
                head, body, tail = chunk
                window += head
                if body is not None:
                    plan += [ids_of(parts_of(window)), body]
                    window = tail
            plans.append([*plan, ids_of(parts_of(window))])
        known.learn(late)
        chunks.update((p, (head, late_ids(body), tail)) for p, (head, body, tail) in fresh.items())
        return [np.frombuffer(b"".join(map(late_ids, plan)), dtype=self.dtype) for plan in plans]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """As the library does; it joins the tokens by blanks where the vocabulary names no decoder."""
        if self.spelled is not None:
            return [" ".join(self.spelled[x].tolist()) for x in ids]
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    return worker_cache(("chunks", path), lambda: ChunkEncoder(path))


def ids_and_text(batch: pd.DataFrame, ids: list[np.ndarray], decoded: list[str]) -> pd.DataFrame:
    return batch.assign(ids=[x.tobytes() for x in ids], decoded=decoded)


def encode_documents(df: DataFrame, text: str, tokenizer: str, keep: tuple[str, ...],
                     finish: Callable = ids_and_text, schema: str = "ids binary, decoded string") -> DataFrame:
    """``keep`` columns with the ids and the decoded text of every document, or what ``finish`` makes of these."""
    ship(df.sparkSession)
    added = StructType.fromDDL(schema).fieldNames()
    names = [c for c in keep if c not in added]
    own = "_text"  # no kept column's name
    while own in names:
        own = f"_{own}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for pdf in batches:
            for k in range(0, len(pdf), 512):
                part = pdf.iloc[k : k + 512]
                ids = enc.encode(part[own].tolist())
                yield finish(part[names], ids, enc.decode(ids))

    source = df.select(*[F.col(f"`{c}`") for c in names], whole_text(f"`{text}`").alias(own))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInPandas(run, f"{kept}, {schema}" if kept else schema)


@functools.cache
def numerals(n: int) -> np.ndarray:
    """The decimal forms of 0 to n - 1."""
    return np.array([str(i) for i in range(n)], dtype=object)


def digests(batch: pd.DataFrame, ids: list[np.ndarray], decoded: list[str]) -> pd.DataFrame:
    """Counts and SHA-256 of the decimal ids and of the decoded text."""
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    decimal = numerals(power_of_two_at_least(1 + max((int(x.max()) for x in ids if len(x)), default=0)))
    return batch.assign(n_tokens=[len(x) for x in ids], ids_sha256=[sha(" ".join(decimal[x].tolist())) for x in ids],
                        decoded_sha256=[sha(t) for t in decoded])


TOKENIZER = "word_bpe_49k.json"


def op4_chunk_reuse_bpe(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = encode_documents(docs, "text", tokenizer or public_tokenizers.path(TOKENIZER), ("doc_id",), digests,
                           "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
