"""Ids of many short strings through the tokenizers library, each distinct one encoded once per worker.

``Pieces`` encodes two kinds. A run of Latin letters (with the blank before it, for byte-level vocabularies) is one
pre-token; it goes to the library's BPE model directly. Other strings are joined by a special token of the vocabulary, which
ends every pre-token, encoded, and their ids cut at that token. Both give the ids of one call per string, without its cost.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np

BLOCK = 256
#: Letters of which a run is one pre-token wherever its neighbours are no letters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(moved)}}


ALPHABET = byte_letters()


def byte_form(word: str) -> str:
    if word.isascii() and word.isalpha():
        return word
    return word.encode().decode("latin-1").translate(ALPHABET)


def lower_byte_form(word: str) -> str:
    return byte_form(word.lower())


class Pieces:
    """Strings to id bytes (little-endian unsigned, ``dtype``). About ``limit`` strings stay in memory."""

    def __init__(self, tokenizer_path: str, limit: int, form: Callable[[str], str] = byte_form):
        # Spark already runs a task per core; threads of the library would only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        marks = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()
                 if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.mark_id, self.mark = marks[0] if marks else (None, "")
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.limit, self.form, self.tokenize = limit, form, self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        top = max(self.tokenizer.get_vocab().values(), default=-1) + 1
        #: The bytes of each id.
        self.raw = np.arange(top, dtype=self.dtype).view(f"V{self.dtype.itemsize}").tolist()

    def word(self, word: str) -> bytes:
        """The ids of a run of ``LETTERS``."""
        raw = self.raw
        return b"".join([raw[t.id] for t in self.tokenize(self.form(word))])

    def alone(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in got]

    def learn(self, texts: Iterable[str]) -> None:
        new = list({t for t in texts if t not in self.known})
        if self.mark_id is None:
            joined, single = [], new
        else:
            single = [t for t in new if self.mark in t]
            joined = [t for t in new if self.mark not in t] if single else new
        self.known.update(zip(single, self.alone(single)) if single else ())
        blocks = [joined[k : k + BLOCK] for k in range(0, len(joined), BLOCK)]
        for k in range(0, len(blocks), 64):
            part = blocks[k : k + 64]
            for block, e in zip(part, self.tokenizer.encode_batch([self.mark.join(b) for b in part], add_special_tokens=False)):
                ids = np.array(e.ids, dtype=self.dtype)
                width, at = self.dtype.itemsize, np.flatnonzero(ids == self.mark_id)
                if len(at) != len(block) - 1:
                    self.known.update(zip(block, self.alone(block)))
                    continue
                raw, at = ids.tobytes(), (at * width).tolist()
                self.known.update((t, raw[a:b]) for t, a, b in zip(block, [0, *[x + width for x in at]], [*at, len(raw)]))


#: A blank inside a run of white space, or at the end.
UNSAFE = re.compile(r"\s (?:\s|\Z)|\A\s*\Z")
#: Words with the blank before them, and what stands between words.
FINE = re.compile(rf" ?[{LETTERS}]+|[^{LETTERS}]+?(?= ?[{LETTERS}]|\Z)")
#: White space whose last character a following word would split off.
SPLIT = re.compile(r"\s[^\S ]\Z")
OTHER_LETTERS = re.compile("[ªµº]")


def plain_latin(text: str, added: tuple[str, ...]) -> bool:
    """No letters but ``LETTERS``, no apostrophe (contractions), none of the added tokens."""
    if "'" in text or any(x in text for x in added):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return text.isascii() or not OTHER_LETTERS.search(text)


WORD = re.compile(f" ?[{LETTERS}]+").fullmatch


class Known(dict):
    """Ids of pieces. A word that is missing is encoded where it is looked up, so a piece needs one look-up; other missing
    pieces raise KeyError, for the library encodes many of them at a time (``learn``)."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, piece: str) -> bytes:
        if not WORD(piece):
            raise KeyError(piece)
        ids = self[piece] = self.pieces.word(piece)
        return ids

    def trim(self) -> None:
        """Call between batches: forgets all when this and what the library encoded are over the limit."""
        if len(self) + len(self.pieces.known) > self.pieces.limit:
            self.clear()
            self.pieces.known = {}

    def learn(self, texts: set[str]) -> None:
        self.pieces.learn(texts)
        self.update((x, self.pieces.known[x]) for x in texts)


class ByteEncoder:
    """Whole texts to ids for byte-level BPE.

    A Latin-1 text without apostrophes is cut at its words: letters, punctuation and white space are different
    pre-tokens, a blank belongs to the word after it. Other texts are cut before each blank, which always starts a new pre-token
    unless it stands inside or ends a run of white space; a text with such a blank is encoded whole.
    """

    def __init__(self, tokenizer_path: str, limit: int = 900_000):
        self.pieces = Pieces(tokenizer_path, limit)
        self.dtype = self.pieces.dtype
        self.width = self.dtype.itemsize
        self.fine = Known(self.pieces)

    def encode(self, texts: list[str]) -> list[bytes]:
        self.fine.trim()
        p, get = self.pieces, self.fine.__getitem__
        done, late, rest = {}, {}, []
        for i, t in enumerate(texts):
            if not t or not plain_latin(t, p.added):
                rest.append(i)
                continue
            cut = FINE.findall(t)
            try:
                done[i] = b"".join(map(get, cut))
            except KeyError:
                late[i] = cut
        new = {x for cut in late.values() for x in cut if x not in self.fine and not WORD(x)}
        split = set(filter(SPLIT.search, new))
        self.fine.learn(new - split)
        for i, cut in late.items():
            if split.isdisjoint(cut):
                done[i] = b"".join(map(get, cut))
            else:
                rest.append(i)
        done.update(zip(rest, self.coarse([texts[i] for i in rest])))
        return [done[i] for i in range(len(texts))]

    def coarse(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if UNSAFE.search(t)]
        alone = dict(zip(whole, self.pieces.alone([texts[i] for i in whole]))) if whole else {}
        cut = [None if i in alone else blanks(t) for i, t in enumerate(texts)]
        self.pieces.learn(x for c in cut if c for x in c)
        get = self.pieces.known.__getitem__
        return [alone[i] if c is None else b"".join(map(get, c)) for i, c in enumerate(cut)]


def blanks(text: str) -> list[str]:
    """The text cut before each blank."""
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]
