"""Token-id shards with a minimal perfect hash index (operator 8).

``write_store`` range-partitions documents by key; each task encodes its range and writes one payload file:

    magic | ids, raw little-endian | document offsets, u64 x (documents + 1) | documents, ids, id width | magic

so the files, taken in key order, hold all ids in ascending key order. The keys are then dealt to index files by
hash. An index file holds a minimal perfect hash of its keys: levels of bit arrays, each key taking the first level where
its position is its own, and its slot being the number of set bits before that position. A slot stores a 32-bit
fingerprint, the payload shard, the key's first document there and its number of documents. A lookup is: hash to the
index file, a few bits, one slot, fingerprint, then one offset and one read.

Files go through a file system handle for the store's URI (pyarrow), under names that no two attempts share; only
files named in the tables that Spark committed count, so lost executors and repeated tasks leave unread files at worst.

Scale: texts are shuffled once, ids never. An index file has about ``keys_per_index`` keys whatever the corpus size. What
reaches the driver is one row per payload or index file.

Defined cases. A null text is the empty text (only the end id). Null keys are first in order and have their own index entry.
Rows that repeat a key stand next to each other, in order of text, and one lookup finds them all. An empty table gives
an empty store. Other columns are ignored.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockplan.llm.common import scratch_dir, ship, stored, table, whole_text, worker_cache
from dockplan.llm.mapped import open_fs
from dockplan.llm.pieces import ByteEncoder

MAGIC = b"IDSHARD1"
FOOT = "<QQI8s"
END_ID = 2
KEYS_PER_INDEX = 100_000
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("count", "<u8")])

def encoder(path: str) -> ByteEncoder:
    """One encoder per worker process and vocabulary."""
    return worker_cache(("bytes", path), lambda: ByteEncoder(path))


# ---- payload files -------------------------------------------------------------------------------------------


def _write_payloads(root: str, tokenizer: str, end_id: int):
    """Rows (key, text) of one key range, in order -> one file; yields (key, file, ordinal, n_tokens)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        out, lengths, base = None, [], 0
        for pdf in batches:
            if out is None:
                fs, folder = open_fs(root)
                name = f"ids-{uuid.uuid4().hex}"
                out = fs.open_output_stream(f"{folder}/{name}")
                out.write(MAGIC)
            n_tokens = np.zeros(len(pdf), dtype=np.int64)
            texts = pdf["text"].tolist()
            for k in range(0, len(texts), 512):
                blobs = [ids + end for ids in enc.encode(texts[k : k + 512])]
                n_tokens[k : k + len(blobs)] = [len(b) // enc.width for b in blobs]
                out.write(b"".join(blobs))
            lengths.append(n_tokens)
            yield pd.DataFrame({"key": pdf["key"], "file": name, "ordinal": np.arange(base, base + len(pdf)), "n_tokens": n_tokens})
            base += len(pdf)
        if out is not None:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
            out.write(offsets.tobytes())
            out.write(struct.pack(FOOT, base, int(offsets[-1]), enc.width, MAGIC))
            out.close()

    return run


class Payload:
    """One payload file: offsets in memory (8 bytes a document), ids read on demand."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        foot = struct.calcsize(FOOT)
        docs, ids, self.width, magic = struct.unpack(FOOT, self.file.read_at(foot, size - foot))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not an id shard: {path}")
        self.dtype = np.dtype(f"<u{self.width}")
        at = len(MAGIC) + ids * self.width
        self.offsets = np.frombuffer(self.file.read_at(8 * (docs + 1), at), dtype="<u8").astype(np.int64)

    def ids(self, first: int, count: int = 1) -> np.ndarray:
        a, b = self.offsets[first], self.offsets[first + count]
        return np.frombuffer(self.file.read_at(int(b - a) * self.width, len(MAGIC) + int(a) * self.width), dtype=self.dtype)


# ---- minimal perfect hash ------------------------------------------------------------------------------------


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A bijective 64-bit mix for each salt: distinct keys stay distinct."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Levels of bit arrays over 64-bit keys; ``slots`` maps the n keys of the build one-to-one onto 0..n-1."""

    GAMMA = 1.5

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, total = [], 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64)
            self.before.append(ranks - bits + total)
            total += int(ranks[-1]) if len(ranks) else 0

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rest, levels = np.unique(keys), []
        while len(rest):
            size = max(8, int(cls.GAMMA * len(rest)))
            at = (mix(rest, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key outside the build gets any slot or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mix(keys[todo], k + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.before[k][at[hit]]
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        parts = [struct.pack("<I", len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, f: io.BytesIO) -> PerfectHash:
        levels = []
        for _ in range(struct.unpack("<I", f.read(4))[0]):
            n = struct.unpack("<Q", f.read(8))[0]
            levels.append(np.unpackbits(np.frombuffer(f.read((n + 7) // 8), np.uint8), count=n).astype(bool))
        return cls(levels)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0) >> np.uint64(32)).astype(np.uint32)


class Index:
    """Keys of one index file: perfect hash, slots, and the entry of the null key."""

    def __init__(self, hashed: PerfectHash, slots: np.ndarray, null: np.ndarray):
        self.hashed, self.slots, self.null = hashed, slots, null

    @classmethod
    def build(cls, pdf: pd.DataFrame) -> Index:
        null = pdf["key"].isna().to_numpy()
        entry = np.zeros(len(pdf), dtype=SLOT)
        for c in ("shard", "first", "count"):
            entry[c] = pdf[c]
        keys = pdf["key"][~null].astype(np.int64).to_numpy().view(np.uint64)
        hashed = PerfectHash.build(keys)
        slots = np.zeros(len(keys), dtype=SLOT)
        at = hashed.slots(keys)
        slots[at] = entry[~null]
        slots["fingerprint"][at] = fingerprints(keys)
        return cls(hashed, slots, entry[null])

    def lookup(self, keys: pd.Series) -> np.ndarray:
        """An entry per key, count 0 where the key is absent."""
        out = np.zeros(len(keys), dtype=SLOT)
        null = keys.isna().to_numpy()
        if len(self.null):
            out[null] = self.null[0]
        k = keys[~null].astype(np.int64).to_numpy().view(np.uint64)
        at = self.hashed.slots(k)
        got = np.zeros(len(k), dtype=SLOT)
        got[at >= 0] = self.slots[at[at >= 0]]
        got[got["fingerprint"] != fingerprints(k)] = np.zeros(1, dtype=SLOT)
        out[~null] = got
        return out

    def dump(self) -> bytes:
        return b"".join([MAGIC, struct.pack("<QQ", len(self.slots), len(self.null)), self.slots.tobytes(), self.null.tobytes(),
                         self.hashed.dump()])

    @classmethod
    def load(cls, data: bytes) -> Index:
        f = io.BytesIO(data)
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError("not an index file")
        n, m = struct.unpack("<QQ", f.read(16))
        slots, null = np.frombuffer(f.read(n * SLOT.itemsize), SLOT), np.frombuffer(f.read(m * SLOT.itemsize), SLOT)
        return cls(PerfectHash.load(f), slots, null)


def index_of(key: int | None, n_indexes: int) -> int:
    """Index file of a key: what ``pmod(xxhash64(key), n)`` gives in SQL."""
    h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    return (h - (1 << 64) if h >> 63 else h) % n_indexes


# ---- the store -----------------------------------------------------------------------------------------------


class TokenStore:
    """Tables that name a store's files: ``shards`` (shard, file, documents, ids, base) and ``indexes`` (bucket, file)."""

    def __init__(self, root: str, shards: DataFrame, indexes: DataFrame, n_indexes: int):
        self.root, self.shards, self.indexes, self.n_indexes = root, shards, indexes, n_indexes

    def locate(self, keys: DataFrame) -> DataFrame:
        """Distinct ``key`` values -> (key, shard, first, count) through the index; absent keys give no row."""
        root = self.root

        def probe(left: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, index = None, None
            for pdf in left:
                for file, part in pdf.groupby("file", sort=False):
                    if file != name:
                        fs, folder = open_fs(root)
                        with fs.open_input_file(f"{folder}/{file}") as f:
                            name, index = file, Index.load(f.read())
                    got = index.lookup(part["key"])
                    frame = pd.DataFrame({"key": part["key"].to_numpy(), **{c: got[c].astype(np.int64) for c in ("shard", "first", "count")}})
                    yield frame[frame["count"] > 0]

        # One row per index file, so at most keys / KEYS_PER_INDEX rows and no text.
        routed = keys.select("key").distinct().withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.n_indexes)).cast("int"))
        routed = routed.join(F.broadcast(self.indexes), "bucket").repartition("bucket").sortWithinPartitions("bucket", "key")
        return routed.select("file", "key").mapInPandas(probe, "key long, shard long, first long, count long")

    def read(self, located: DataFrame) -> DataFrame:
        """Located keys -> one row per document: key, start, n_tokens, ids_crc32, ids (raw, little-endian u32)."""
        root = self.root

        def fetch(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, payload = None, None
            for pdf in rows:
                for file, part in pdf.groupby("file", sort=False):
                    if file != name:
                        fs, folder = open_fs(root)
                        name, payload = file, Payload(fs, f"{folder}/{file}")
                    out = []
                    for key, first, count, base in zip(part["key"], part["first"], part["count"], part["base"]):
                        ids = payload.ids(first, count)
                        starts = payload.offsets[first : first + count + 1]
                        for a, b in zip(starts[:-1], starts[1:]):
                            raw = ids[a - starts[0] : b - starts[0]].astype("<u4").tobytes()
                            out.append((key, base + a, b - a, zlib.crc32(raw), raw))
                    yield pd.DataFrame(out, columns=["key", "start", "n_tokens", "ids_crc32", "ids"])

        shards = F.broadcast(self.shards.select("shard", "file", "base"))  # one row per payload file
        rows = located.join(shards, "shard").repartition("shard").sortWithinPartitions("shard", "first")
        return rows.select("file", "key", "first", "count", "base").mapInPandas(
            fetch, "key long, start long, n_tokens long, ids_crc32 long, ids binary")


def write_store(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int = END_ID, root: str | None = None,
                shards: int | None = None, keys_per_index: int = KEYS_PER_INDEX) -> TokenStore:
    """Encode ``docs`` and write payload and index files under ``root`` (a URI; default: the shared scratch folder)."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    root = root or f"{scratch_dir(spark)}/ids-{uuid.uuid4().hex}"
    fs, folder = open_fs(root)
    fs.create_dir(folder, recursive=True)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), whole_text(text).alias("text"))
    ranged = rows.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")
    placed = stored(ranged.mapInPandas(_write_payloads(root, tokenizer, end_id),
                                       "key long, file string, ordinal long, n_tokens long"))
    per_file = placed.groupBy("file").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("ids"),
                                          F.min("key").alias("_first"), F.max(F.col("key").isNull()).alias("_null"))
    # One row per payload file from here on.
    order = Window.orderBy(F.col("_null").desc(), "_first")
    files = stored(per_file.select(
        (F.row_number().over(order) - 1).alias("shard"), "file", "documents", "ids",
        F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")))
    keys = stored(placed.groupBy("key", "file").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("count"))
                  .join(F.broadcast(files.select("file", "shard")), "file").drop("file"))
    n_indexes = max(1, -(-keys.count() // keys_per_index))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, folder = open_fs(root)
        name = f"index-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{folder}/{name}") as f:
            f.write(Index.build(pdf).dump())
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "file": [name]})

    bucketed = keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n_indexes)).cast("int"))
    indexes = stored(bucketed.groupBy("bucket").applyInPandas(build, "bucket int, file string"))
    return TokenStore(root, files, indexes, n_indexes)


TOKENIZER = "byte_bpe_50k.json"


def op8_perfect_hash_ids(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All ``documents`` written, then each looked up by key and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = write_store(docs, "doc_id", "text", tokenizer or public_tokenizers.path(TOKENIZER))
    keys = docs.select(F.col("doc_id").cast("long").alias("key"))
    back = store.read(store.locate(keys))
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")
