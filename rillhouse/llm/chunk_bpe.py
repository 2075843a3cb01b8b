"""BPE encoding that reuses content-defined chunks, and decoding.

A rolling hash over the bytes cuts every text where its low bits are set, so equal
passages fall into equal chunks wherever they stand.  A chunk's inside, from its first to
its last white space, is encoded once and kept; copies of passages in other documents
reuse it.  What stands around a cut is a joint: the words on both sides of it with one
whole word of either chunk.  It is encoded anew; if its ends do not agree with the ids of
those whole words, the joint grows by further words until they do, at worst over the two
whole chunks.

New chunks and joints are split into the tokenizer's own pieces (lower-cased, cut as its
pre-tokenizer cuts), so different spellings share them.  The pieces that a slice of
documents brings for the first time go to the library together, a few hundred to a call.
Text with characters beyond Latin-1 is split into words at white space instead, and the
library does the rest.

Kept chunks and pieces live in a worker process and are bounded; texts are never shuffled.

Defined results
* null text counts as empty: no ids, and it decodes to an empty text.
* special token strings inside a text are that token, as in the tokenizers library.
* repeated rows each appear; an empty table gives an empty result; other columns are not
  read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from rillhouse.llm.common import id_and_text, longs, map_slices, strings

#: A cut is made where the low bits of the hash are set: about every 512 bytes.
CUT_BITS = 9
#: Bytes in the rolling hash.
SPAN = 16
#: Chunks, joints and pieces kept, in two generations each.
KEPT_CHUNKS, KEPT_JOINTS, KEPT_PIECES = 20_000, 40_000, 200_000
#: Pieces encoded in one call.
TOGETHER = 500

_WORDS = re.compile(r"[^ \n]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# the pre-tokenizer's pattern, its classes spelled out for the characters up to U+00FF
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+")
_WIDE = re.compile("[^\x00-\xff]")


class Kept(dict):
    """A cache in two generations; the older one is dropped when the younger one is full."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def find(self, key):
        found = self.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self[key] = found
        return found

    def age(self) -> None:
        """Between slices, so that what a slice needs stays."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()


def cuts(data: bytes) -> list[int]:
    """Where chunks begin, from 0; never inside a UTF-8 sequence."""
    if len(data) <= SPAN:
        return [0]
    raw = np.frombuffer(data, np.uint8)
    values = raw.astype(np.uint64)
    rolled = np.zeros(len(raw) - SPAN + 1, np.uint64)
    for i in range(SPAN):
        rolled = rolled * np.uint64(0x100000001B3) + values[i:len(raw) - SPAN + 1 + i]
    mixed = (rolled * _FACTOR) >> np.uint64(64 - CUT_BITS)
    at = np.flatnonzero(mixed == np.uint64((1 << CUT_BITS) - 1)) + SPAN
    at = at[at < len(raw)]
    return [0, *at[(raw[at] & 0xC0) != 0x80].tolist()]


class ChunkEncoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to those of the library."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.chunks, self.joints = Kept(KEPT_PIECES), Kept(KEPT_CHUNKS), Kept(KEPT_JOINTS)

    def _split(self, text: str) -> list[str]:
        """Parts that are encoded apart: no token spans two of them."""
        if _WIDE.search(text) or any(s in text for s in self.special):
            return _WORDS.findall(text)
        return _PIECES.findall(text.lower())

    def _learn(self, parts: set[str]) -> None:
        """Encode the parts that are not known, many to a call."""
        new = [p for p in parts if self.pieces.find(p) is None]
        for at in range(0, len(new), TOGETHER):
            some = new[at:at + TOGETHER]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
            ends = np.searchsorted(of, np.arange(len(some)), "right").tolist()
            for part, a, b in zip(some, [0, *ends], ends):
                self.pieces[part] = ids[a:b].tobytes()

    def _joined(self, parts: list[str]) -> bytes:
        return b"".join([self.pieces[p] for p in parts])

    @staticmethod
    def _opened(chunk: str) -> tuple | None:
        """(head, inside, first words, last words, tail): the head and the tail are parts of
        words that other chunks may hold the rest of; None for a chunk without white space."""
        begin = re.search(r"[ \n]", chunk)
        if begin is None:
            return None
        end = max(chunk.rfind(" "), chunk.rfind("\n"))
        inside = chunk[begin.start():end + 1]
        words = _WORDS.findall(inside)
        return chunk[:begin.start()], inside, tuple(words[:3]), tuple(words[-3:]), chunk[end + 1:]

    def _agreed(self, before: tuple, middle: str, after: tuple) -> bytes:
        """Ids of the text around cuts, agreed with the whole words on both sides."""
        for width in range(1, max(len(before), len(after), 1) + 1):
            left, right = " ".join(before[-width:]), " ".join(after[:width])
            parts = [self._split(x) for x in (f"{left} {middle} {right}", left, right)]
            self._learn({p for x in parts for p in x})
            ids, known_left, known_right = map(self._joined, parts)
            if ids.startswith(known_left) and ids.endswith(known_right):
                return ids[len(known_left):len(ids) - len(known_right)]
        self._learn(set(self._split(middle)))
        return self._joined(self._split(middle))

    def _plan(self, text: str, new_chunks: dict, new_joints: set) -> list:
        """The text as chunks and joints, in order; those that are not known are noted."""
        data = text.encode()
        starts = cuts(data)
        plan, before, open_text = [], (), ""
        for a, b in zip(starts, [*starts[1:], len(data)]):
            chunk = data[a:b].decode()
            opened = self._opened(chunk)
            if opened is None:
                open_text += chunk
                continue
            head, inside, first, last, tail = opened
            if open_text or head:
                plan.append((before, open_text + head, first))
            plan.append(inside)
            if inside not in new_chunks and self.chunks.find(inside) is None:
                new_chunks[inside] = self._split(inside)
            before, open_text = last, tail
        if open_text:
            plan.append((before, open_text, ()))
        new_joints.update(x for x in plan if isinstance(x, tuple) and self.joints.find(x) is None)
        return plan

    def encode_all(self, texts: list[str]) -> list[bytes]:
        new_chunks: dict[str, list[str]] = {}
        new_joints: set[tuple] = set()
        plans = [self._plan(t, new_chunks, new_joints) for t in texts]
        parts = {p for x in new_chunks.values() for p in x}
        for before, middle, after in new_joints:
            parts.update(self._split(" ".join((*before, middle, *after))))
        self._learn(parts)
        for inside, split in new_chunks.items():
            self.chunks[inside] = self._joined(split)
        for joint in new_joints:
            self.joints[joint] = self._agreed(*joint)
        out = [b"".join([(self.joints if isinstance(x, tuple) else self.chunks)[x] for x in plan]) for plan in plans]
        for kept in (self.pieces, self.chunks, self.joints):
            kept.age()
        return out

    def __call__(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_known: dict[str, tuple] = {}


def encoder(name: str = "word_bpe_49k"):
    """(encoder, token texts) of a worker process, kept between its tasks."""
    if name not in _known:
        import public_tokenizers as public
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public.path(f"{name}.json"))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        texts = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        _known[name] = ChunkEncoder(tokenizer), texts
    return _known[name]


def decode(ids: bytes, texts: list[str]) -> str:
    """The vocabulary has no decoder, so a text is its tokens with spaces between."""
    return " ".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoded(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row."""
    def make():
        encode, texts = encoder()

        def work(docs, rows):
            ids = encode.encode_all(rows)
            sha = [hashlib.sha256(i).hexdigest() for i in ids]
            back = [hashlib.sha256(decode(i, texts).encode()).hexdigest() for i in ids]
            return longs(docs), longs([len(i) // 4 for i in ids]), strings(sha), strings(back)
        return work

    return map_slices(id_and_text(documents), make,
                      "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def token_ids(documents: DataFrame) -> DataFrame:
    """doc_id and the ids themselves."""
    import pyarrow as pa

    def make():
        encode, _ = encoder()

        def work(docs, rows):
            ids = [np.frombuffer(x, "<u4").tolist() for x in encode.encode_all(rows)]
            return longs(docs), pa.array(ids, pa.list_(pa.int64()))
        return work

    return map_slices(id_and_text(documents), make, "doc_id bigint, ids array<bigint>")
