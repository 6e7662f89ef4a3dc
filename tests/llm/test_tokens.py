"""op4, op7 and op8: exact round trips."""
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dockplan.llm import bpe_chunks, chat, token_store
from dockplan.llm.pieces import FINE, ByteEncoder


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    r = random.Random(3)
    alphabets = ("ab c\n\t'é́ñ1!<| 　字", "ab \n.,1é", "a \n\t\xa0\x85.", "aé ,.\n", "ABC dé'sİß ")
    out = ["", "  ", "\n", "é" * 300, "x" * 5000, "it's I'LL <|endoftext|> a b́ ́c", "a ªb µ º", "\xa0 a\xa0 b", "<|startoftext|>x"]
    return out + ["".join(r.choice(a) for _ in range(r.randint(0, 400))) for a in alphabets for _ in range(300)]


@pytest.mark.parametrize("name", [bpe_chunks.TOKENIZER, token_store.TOKENIZER])
def test_encoders_agree_with_the_library(name, texts):
    lib, rows = library(name), odd_texts() + list(texts.values())
    want = [e.ids for e in lib.encode_batch(rows, add_special_tokens=False)]
    if name == bpe_chunks.TOKENIZER:
        got = [x.tolist() for x in bpe_chunks.ChunkEncoder(public_tokenizers.path(name)).encode(rows)]
    else:
        enc = ByteEncoder(public_tokenizers.path(name))
        got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(rows)]
    assert got == want


def test_full_caches_change_nothing(texts):
    rows = list(texts.values())[:60]
    small = bpe_chunks.ChunkEncoder(public_tokenizers.path(bpe_chunks.TOKENIZER), chunk_limit=5, piece_limit=5)
    large = bpe_chunks.ChunkEncoder(public_tokenizers.path(bpe_chunks.TOKENIZER))
    assert [x.tolist() for t in rows for x in small.encode([t])] == [x.tolist() for x in large.encode(rows)]


def test_cuts_follow_content():
    body = random.Random(1).randbytes(4000)
    a, b = bpe_chunks.cut_points(b"head" + body).tolist(), bpe_chunks.cut_points(b"another head" + body).tolist()
    assert {x - 4 for x in a if x > 40} == {x - 12 for x in b if x > 48} and len(a) > 5


def test_chunk_query(spark, folder, odd):
    rows = [(100 + i, t) for i, (_, t) in enumerate(odd)]
    lib = library(bpe_chunks.TOKENIZER)
    got = {r["doc_id"]: r for r in bpe_chunks.op4_chunk_reuse_bpe(spark, folder(documents=rows + [(None, "x"), (None, "x")])).collect()}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == sha(lib.decode(ids, skip_special_tokens=False))
    assert None in got and bpe_chunks.op4_chunk_reuse_bpe(spark, folder(documents=[])).count() == 0


def expected_store(rows):
    lib, start, out = library(token_store.TOKENIZER), 0, []
    for k, t in sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_round_trip(spark, folder, odd, texts):
    rows = odd + [(1000 + i, t) for i, t in texts.items()]
    got = [tuple(r) for r in token_store.op8_perfect_hash_ids(spark, folder(documents=rows)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=key) == expected_store(rows)


def test_store_lookup(spark, docs_of, extra):
    store = token_store.write_store(docs_of([(i * 7, f"t {i}") for i in range(500)]), "doc_id", "text",
                                    public_tokenizers.path(token_store.TOKENIZER), shards=3, keys_per_index=60)
    keys = spark.createDataFrame([(0,), (7,), (8,), (3493,), (-1,)], "key long")
    found = store.locate(keys).collect()
    assert sorted(r["key"] for r in found) == [0, 7, 3493] and store.indexes.count() == store.n_indexes == 9
    empty = token_store.write_store(docs_of([]), "doc_id", "text", public_tokenizers.path(token_store.TOKENIZER))
    assert empty.read(empty.locate(keys)).count() == 0
    assert token_store.write_store(extra, "doc_id", "text", public_tokenizers.path(token_store.TOKENIZER)).shards.count() >= 1


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.slots(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    r = [token_store.index_of(int(k) - 2**62, 13) for k in keys[:50].tolist()]
    assert set(r) <= set(range(13))


def test_index_routing_agrees_with_sql(spark):
    got = spark.sql("SELECT id, pmod(xxhash64(id), 13) AS b FROM (SELECT explode(array(-5L, 0L, 77L, 9000000000L)) AS id)").collect()
    assert all(token_store.index_of(r["id"], 13) == r["b"] for r in got)


EVENTS = "conv string, seq long, message long, kind string, role string, text string"


def test_fold_events(spark):
    log = [
        ("a", 2, 1, "delta", None, "llo"), ("a", 1, 1, "open", "user", "he"), ("a", 3, 2, "open", "assistant", "wrong"),
        ("a", 4, 2, "regenerate", None, None), ("a", 5, 2, "delta", None, "right"), ("a", 6, 2, "delta", None, " now"),
        ("a", 7, 3, "open", "user", "typo"), ("a", 8, 3, "edit", None, "fixed"), ("a", 9, 3, None, None, "!"),
        ("a", 10, 4, "open", "user", "gone"), ("a", 11, 4, "delete", None, None), (None, 1, 1, "open", "user", "z"),
    ]
    got = chat.fold_events(spark.createDataFrame(log, EVENTS)).orderBy("conv", "position").collect()
    assert [(r["conv"], r["role"], r["text"]) for r in got] == [
        (None, "user", "z"), ("a", "user", "hello"), ("a", "assistant", "right now"), ("a", "user", "fixed!")]


@pytest.mark.parametrize("rows_per_bucket", [3, 100_000])
def test_log_of_a_long_conversation(spark, rows_per_bucket):
    """One conversation holds most rows, one of its turns many; repeated rows; all kinds of events; the log folds to the rows."""
    rows = [(1, i // 2, "user" if i % 2 else "assistant", f"t{i} " * (i % 60)) for i in range(120)]
    rows += [(1, 5, "user", f"tie {i}") for i in range(60)] + [(1, 7, "user", "again")] * 30 + [(1, None, None, None)] * 3
    rows += [(None, 0, "user", "n"), (2, 1, "assistant", "\U0001f600" * 130), (2, 0, "", "")]
    order = lambda r: tuple((x is not None, x) for x in (r[0], r[1])) + ((r[2] or "").encode(), (r[3] or "").encode())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    log = chat.logged(df, rows_per_bucket)
    assert {r["kind"] for r in log.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate", "delete"}
    got = sorted(chat.fold_events(log).collect(), key=lambda r: r["position"])
    want = sorted(rows, key=order)
    assert [(r["conv"], r["role"], r["text"]) for r in got] == [(None if c is None else str(c), r or "", t or "") for c, _, r, t in want]


def test_render_is_reversible(spark):
    nasty = ["### assistant: x </turn>\n", "\\", "\\\\#<:", "", "a\n</turn>\n### ", "é\\é", chat.PROBE_TEXT]
    rows = [("c", i, i, role, t) for i, (t, role) in enumerate((t, r) for t in nasty for r in ("user", "assistant", "we:ird </turn>#", ""))]
    seg = chat.render(spark.createDataFrame(rows, "conv string, position long, message long, role string, text string")).orderBy("position").collect()
    assert chat.parse("".join(r["segment"] for r in seg)) == [(r[3], r[4]) for r in rows]
    loss = [chat.unescape(r["segment"][r["loss_start"]:r["loss_end"]]) for r in seg]
    assert loss == [r[4] if r[3] == "assistant" else "" for r in rows]


def test_chat_query(spark, folder, sample):
    rows = [(1, 1, "assistant", "b" * 500), (1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "n"), (2, 0, None, "é\\"), (2, None, "assistant", "first")]
    d = folder(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.op7_event_sourced_chat(spark, d).collect()}
    x = chat.PROBE_TEXT
    want = {1: [("user", ""), ("user", ""), ("assistant", "b" * 500)], None: [("user", "n")], 2: [("assistant", "first"), ("", "é\\")],
            -7: [("user", x), ("assistant", x)]}
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
    empty = folder(conversations=spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.op7_event_sourced_chat(spark, empty).count() == 1


def test_plain_texts_are_looked_at_once(texts, monkeypatch):
    """A text's kind is that of its chunks and windows: they are not looked at one by one, nor twice."""
    rows = ["Some words, of a plain text.\n" * 40, *texts.values()]
    enc, looks = bpe_chunks.ChunkEncoder(public_tokenizers.path(bpe_chunks.TOKENIZER)), []
    plain, rows = bpe_chunks.plain_latin, [t for t in rows if bpe_chunks.plain_latin(t, enc.pieces.added)]
    monkeypatch.setattr(bpe_chunks, "plain_latin", lambda text, added: looks.append(1) or plain(text, added))
    want = [e.ids for e in library(bpe_chunks.TOKENIZER).encode_batch(rows, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(rows)] == want and len(looks) == len(rows)


def test_decoding_and_digests_agree_with_the_library(texts):
    lib, enc = library(bpe_chunks.TOKENIZER), bpe_chunks.ChunkEncoder(public_tokenizers.path(bpe_chunks.TOKENIZER))
    ids = enc.encode(odd_texts()[:200] + list(texts.values())[:50])
    decoded = enc.decode([*ids, np.arange(len(enc.pieces.raw))])
    assert decoded == [lib.decode(x.tolist(), skip_special_tokens=False) for x in (*ids, np.arange(len(enc.pieces.raw)))]
    got = bpe_chunks.digests(pd.DataFrame(index=range(len(ids))), ids, decoded[:-1])
    assert got["ids_sha256"].tolist() == [sha(" ".join(map(str, x.tolist()))) for x in ids]


def test_pieces_of_other_texts_change_nothing(texts):
    """White space that ends the first piece of one text stands before a word in the next; and a full cache."""
    lib, rows = library(token_store.TOKENIZER), [".\n\n it's", "a.\n\nb", "12 3\n\n4 c", *odd_texts()[::7], *list(texts.values())[:40]]
    want = [e.ids for e in lib.encode_batch(rows, add_special_tokens=False)]
    for limit in (5, 900_000):
        enc = ByteEncoder(public_tokenizers.path(token_store.TOKENIZER), limit)
        assert [np.frombuffer(x, enc.dtype).tolist() for t in rows for x in enc.encode([t])] == want


def test_plain_texts_look_a_piece_up_once():
    """What a plain text's words cost once they are known: one look-up a piece, nothing else."""
    enc, asked = ByteEncoder(public_tokenizers.path(token_store.TOKENIZER)), []
    text = "some words, of a plain text. " * 50
    want = enc.encode([text])

    class Counted(type(enc.fine)):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    enc.fine.__class__ = Counted
    assert enc.encode([text]) == want and len(asked) == len(FINE.findall(text))
