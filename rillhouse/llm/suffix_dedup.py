"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts
anywhere else are removed, in all places where it stands.

Not every suffix is sorted.  Anchors are places chosen by content: in every window of
``length`` bytes the k-gram with the smallest hash, so equal windows hold equal anchors at
equal offsets, and an anchor comes about every ``length * 0.32`` bytes.  A repeated window
is then a pair of anchors with L equal bytes to the left, R to the right, L + R >= length,
and the bytes it covers are [a - L, a + R).

1. One pass over the texts writes a row per anchor: hash of its k-gram and of its whole
   context (all bytes that windows around it can reach).
2. K-grams are counted, partial sums first.  Most stand once, and their anchors go no
   further: everything below touches anchors of repeated k-grams only.
3. Contexts are counted, copies being added up before the shuffle.  A context that stands
   twice is covered whole: copies of any number end here.
4. An anchor whose context is unique but whose k-gram is not stands near the border of a
   repeat.  Only these go on: their contexts are sorted, to the right and (reversed) to the
   left of the anchor, by deep-shallow sorting: multikey quicksort to a shallow depth, then
   blind tries for the groups whose long common prefix it has not split.  The prefixes
   shared with neighbours in both orders give, for every offset, which contexts share the
   whole window.
5. A k-gram with more than ``GROUP`` different contexts (a passage that a large share of all
   texts hold, each with other text beside it) is no group for one task.  Its windows are
   counted by hash instead, with partial sums, over all tasks; the result is the same.

The same search runs over words (``cut_passages``): each word becomes a 32-bit code, and the
search goes by codes as it goes by bytes otherwise, whatever the words' lengths and the white
space between them.  Two different windows of 51 words are taken for equal only if all codes
agree.

Defined results
* null text counts as empty; texts shorter than ``length`` keep all bytes.
* repeated rows are repeats of each other and lose what is long enough.
* a null ``doc_id`` is carried through; an empty table gives an empty result; other columns
  are not read (``cut_documents`` keeps them).
* removed bytes may end inside a character; as text, broken characters are left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import (
    SLICE_ROWS, dropped, longs, partitions, stored, stored_result, strings,
)
from rillhouse.session import release_shuffles

LENGTH = 400
#: Window starts handled at once, which bounds a task's memory for very long texts.
BLOCK = 1 << 17
#: Different contexts of one k-gram that are sorted in one task at most, and contexts sorted
#: together, in whole groups.
GROUP, SORTED = 8_000, 8_000
#: Anchors of one document that are worked off at once.
SOME = 500
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 32
#: Words that a passage must have to be cut by ``cut_passages``; characters of a word at most.
PASSAGE, LONGEST = 51, 64


def window_of(length: int) -> tuple[int, int]:
    """(k, w): bytes of a k-gram and k-grams in a window of ``length`` bytes."""
    w = max(1, length * 256 // 400)
    return length - w + 1, w


# ------------------------------------------------------------------ words

# characters of scripts without spaces between words count as a word each, and long runs
# (encoded data) as a word for every 64 characters
_SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(f"[{_SINGLE}]|[^\\s{_SINGLE}]{{1,{LONGEST}}}")


_SHIFT, _FACTORS = np.uint64(33), (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mix(x: np.ndarray) -> np.ndarray:
    for factor in _FACTORS:
        x = x ^ (x >> _SHIFT)
        x *= factor
    x ^= x >> _SHIFT
    return x


@functools.cache
def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a character: white space 0, part of a word 1, a word 2; its hash, up to U+FFFF; powers
    of the hash of a word."""
    kind = np.ones(0x110000, np.uint8)
    kind[[c for c in range(0x10000) if chr(c).isspace()]] = 0
    for a, b in re.findall("(.)-(.)", _SINGLE):
        kind[ord(a):ord(b) + 1] = 2
    powers = np.cumprod(np.full(LONGEST, 0x9E3779B97F4A7C15, np.uint64))
    return kind, _mix(np.arange(1, 0x10001, dtype=np.uint64)), powers


def word_codes(text: str) -> np.ndarray:
    """A 32-bit code for each match of ``WORD``."""
    kind, hashes, powers = _kinds()
    points = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = kind.take(points)
    inside = np.zeros(len(kinds) + 2, bool)
    np.equal(kinds, 1, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    if len(sizes) and sizes.max() > LONGEST:
        pieces = -(-sizes // LONGEST)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = np.repeat(starts, pieces) + LONGEST * within, np.repeat(ends, pieces)
        sizes = np.minimum(ends - starts, LONGEST)
    single = np.flatnonzero(kinds == 2)
    if len(single):
        starts, sizes = np.concatenate([starts, single]), np.concatenate([sizes, np.ones(len(single), np.int64)])
        order = np.argsort(starts)
        starts, sizes = starts[order], sizes[order]
    if not len(starts):
        return np.zeros(0, np.uint32)
    firsts = np.cumsum(sizes) - sizes  # of each word, among the characters of words
    inside = points[kinds > 0]
    values = hashes.take(inside) if text.isascii() or inside.max() < len(hashes) else _mix(inside.astype(np.uint64) + np.uint64(1))
    place = np.arange(len(inside)) - np.repeat(firsts, sizes)
    return (_mix(np.add.reduceat(values * powers.take(place), firsts)) >> np.uint64(32)).astype(np.uint32)


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


# ------------------------------------------------------------------ hashes

class Rolling:
    """Polynomial hashes of any part of a string of bytes or codes, modulo 2^64, for one odd base."""

    def __init__(self, base: int, size: int):
        self.base = np.uint64(base | 1)
        self.codes = _mix(np.arange(1, 257, dtype=np.uint64) * self.base)
        self.powers, self.inverse = (
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))])
            for b in (base | 1, pow(base | 1, -1, 1 << 64)))

    def sums(self, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, np.uint64)
        codes = self.codes.take(raw) if raw.dtype == np.uint8 else _mix((raw + np.uint64(1)) * self.base)
        np.cumsum(codes * self.powers[:len(raw)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.inverse[start])


_rolling: dict[int, tuple[Rolling, Rolling]] = {}


def _hashes(length: int) -> tuple[Rolling, Rolling]:
    if length not in _rolling:
        size = BLOCK + 4 * length
        _rolling[length] = Rolling(0x9E3779B97F4A7C15, size), Rolling(0xC2B2AE3D27D4EB4F, size)
    return _rolling[length]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def anchors(data: bytes | np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """place, k-gram hash, context hash, bytes (or codes) to the left and to the right.

    Contexts are told apart by both hashes, 128 bits of two different bases.
    """
    k, w = window_of(length)
    one, two = _hashes(length)
    n, found = len(data), []
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    for begin in range(0, n - length + 1, BLOCK):
        end = min(begin + BLOCK, n - length + 1)
        low, high = max(0, begin - w), min(n, end + w + length)
        part = raw[low:high]
        sums = one.sums(part)
        first, after = begin - low, end + w - 1 - low
        grams = _mix((sums[first + k:after + k] - sums[first:after]) * one.inverse[first:after])
        padded = np.zeros(len(grams) + w - 1, np.uint64)
        padded[w - 1:len(grams)] = _sliding(grams, w, np.minimum)
        at = np.flatnonzero(_sliding(padded, w, np.maximum) == grams)
        grams = grams[at]
        at += first
        left = np.minimum(at + low, w - 1)
        right = np.minimum(n - low - at, length)
        salt = _mix((left * 65_537 + right).astype(np.uint64) + np.uint64(1))
        more = two.sums(part)
        found.append((at + low, grams, two.of(more, at - left, at + right) ^ salt, left, right))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(found) == 1:
        return tuple(x.view(np.int64) for x in found[0])
    out = [np.concatenate(x) for x in zip(*found)]
    _, first = np.unique(out[0], return_index=True)
    return tuple(x[first].view(np.int64) for x in out)


# ------------------------------------------------------------------ deep-shallow sorting

def _common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are certain."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Orders strings with a long common prefix; only branching bytes are stored.

    A node is [depth, {byte: child}], a leaf the numbers of equal strings; byte -1 stands
    for the end of a string.
    """

    def __init__(self, texts: list[bytes]):
        self.texts, self.root = texts, None

    def _byte(self, number: int, depth: int) -> int:
        text = self.texts[number]
        return text[depth] if depth < len(text) else -1

    def add(self, number: int) -> None:
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while isinstance(node, tuple):  # blind: bytes between branches are not compared
            children = node[1]
            node = children.get(self._byte(number, node[0])) or next(iter(children.values()))
        mine, other = self.texts[number], self.texts[node[0]]
        shared = _common(mine, other)
        if shared == len(mine) == len(other):
            node.append(number)
            return
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < shared:
            above, key = node, self._byte(number, node[0])
            node = node[1][key]
        if isinstance(node, tuple) and node[0] == shared:
            node[1][self._byte(number, shared)] = [number]
            return
        old = other[shared] if shared < len(other) else -1
        fork = (shared, {old: node, self._byte(number, shared): [number]})
        if above is None:
            self.root = fork
        else:
            above[1][key] = fork

    def ordered(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and the prefix each shares with the one before it (first: 0)."""
        order, shared, stack = [], [], [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if isinstance(node, tuple):
                keys = sorted(node[1])
                stack += [(node[1][b], node[0]) for b in reversed(keys[1:])]
                stack.append((node[1][keys[0]], before))
            else:
                for i, number in enumerate(node):
                    order.append(number)
                    shared.append(len(self.texts[number]) if i else before)
        return order, shared


def deep_shallow(texts: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): numbers sorted within each group, and the prefix shared with the
    predecessor, -1 at the start of a group."""
    n = len(texts)
    heads = np.frombuffer(b"".join(t[:SHALLOW].ljust(SHALLOW, b"\0") for t in texts), ">u8").reshape(n, -1)
    short = np.fromiter((min(len(t), SHALLOW) for t in texts), np.int64, n)
    order = _multikey(np.column_stack([heads.astype(np.uint64), short.astype(np.uint64)]), groups)
    g, h, s = groups[order], heads[order], short[order]
    same = np.zeros(n, bool)
    same[1:] = (g[1:] == g[:-1]) & (h[1:] == h[:-1]).all(axis=1) & (s[1:] == s[:-1])
    shared = np.full(n, -1, np.int64)
    bounds = np.concatenate([np.flatnonzero(~same), [n]])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            trie = BlindTrie(texts)
            for number in order[a:b].tolist():
                trie.add(number)
            order[a:b], shared[a:b] = trie.ordered()
        if a and g[a] == g[a - 1]:
            shared[a] = _common(texts[order[a]], texts[order[a - 1]])
        else:
            shared[a] = -1
    return order, shared


def _multikey(keys: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Multikey quicksort by groups and then word after word: parts that are already
    single are left alone, the others are split by their next word."""
    order = np.argsort(groups, kind="stable")
    part = np.concatenate([[0], np.cumsum(np.diff(groups[order]) != 0)]) if len(order) else order
    for column in keys.T:
        sizes = np.bincount(part)
        open_ = np.flatnonzero(sizes[part] > 1)
        if not len(open_):
            break
        rows = order[open_]
        by = np.lexsort((column[rows], part[open_]))
        order[open_] = rows[by]
        values = column[order]
        part = np.concatenate([[0], np.cumsum((part[1:] != part[:-1])
                                              | ((values[1:] != values[:-1]) & (sizes[part[1:]] > 1)))])
    return order


def _most_shared(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The longest prefix that each string shares with another of its group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(shared, np.append(shared[1:], -1))
    return out


def shared_windows(lefts: list[bytes], rights: list[bytes], groups: np.ndarray,
                   length: int, unit: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) offset to the left at which each context shares a whole window with
    another of its group; most is -1 if there is none.  Offsets and length count codes of
    ``unit`` bytes."""
    n = len(rights)
    right_order, right_shared = deep_shallow(rights, groups)
    left_order, left_shared = deep_shallow([x[::-1] for x in lefts], groups)
    right_shared, left_shared = right_shared // unit, left_shared // unit  # -1 stays -1
    least, most = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    # a window is shared only where both of its sides are
    to_right, to_left = _most_shared(right_order, right_shared), _most_shared(left_order, left_shared)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(window_of(length)[1]):
        able = np.flatnonzero((to_left >= offset) & (to_right >= length - offset))
        if not len(able):
            continue
        right_class[right_order] = np.cumsum(right_shared < length - offset)
        left_class[left_order] = np.cumsum(left_shared < offset)
        _, where, count = np.unique(right_class[able] * (n + 1) + left_class[able],
                                    return_inverse=True, return_counts=True)
        both = able[count[where] > 1]
        least[both[most[both] < 0]] = offset
        most[both] = offset
    return least, most


# ------------------------------------------------------------------ Spark side

_KEY = ("k1", "k2")  # of a document: id and hash of id and text


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text and a key that is never null; equal rows share it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    return documents.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(-1)).alias("k1"),
                            F.xxhash64(doc, text).alias("k2"), text.alias("text"))


#: The first anchor of a document has its key.  ``spot`` holds the anchor's place and, in its low bits, the bytes of context to the right.
_ANCHOR = "gram bigint, context bigint, doc bigint, spot bigint, k1 bigint, k2 bigint"
_SPOT_BITS = 20


def anchor_rows(rows: DataFrame, length: int, encode: Callable[[str], np.ndarray] = text_bytes,
                least: int | None = None) -> DataFrame:
    """Anchors of the encoded texts, documents numbered by task; ``least`` bytes of text are
    needed for ``length`` encoded ones."""
    names = [x.split()[0] for x in _ANCHOR.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out, sizes = [], []
                for text in part.column(2).to_pylist():
                    at, gram, context, _, right = anchors(encode(text), length)
                    out.append((gram, context, at << _SPOT_BITS | right))
                    sizes.append(len(at))
                docs = np.repeat(np.arange(number, number + len(sizes)), sizes)
                number += len(sizes)
                gram, context, spot = (longs(np.concatenate(x)) for x in zip(*out))
                first = np.zeros(sum(sizes), bool)
                first[(np.cumsum(sizes) - sizes)[np.array(sizes) > 0]] = True
                keys = [pa.array(np.repeat(part.column(i).to_numpy(), sizes), pa.int64(), mask=~first) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([gram, context, longs(docs), spot, *keys], names=names)

    long_enough = rows.filter(F.octet_length("text") >= (length if least is None else least))
    return long_enough.select(*_KEY, "text").mapInArrow(run, _ANCHOR)


def _around(rows: DataFrame, wanted: DataFrame, encode: Callable[[str], np.ndarray], schema: str,
            work: Callable[[list, np.ndarray, pa.StructArray], list]) -> DataFrame:
    """``work(key, encoded text, some wanted anchors)``, the columns of ``schema``, for every
    document that holds wanted anchors.  One Python step: a second one on its rows would run
    beside it, with a worker of its own in each running task."""
    per_document = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("gram", "m", "n", "at")).alias("a"))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for i in range(batch.num_rows):
                key = [batch.column(k)[i].as_py() for k in _KEY]
                if key == before:
                    continue  # a repeated row has the same contexts
                before = key
                data = encode(batch.column("text")[i].as_py())
                found = batch.column("a")[i].values
                for j in range(0, len(found), SOME):
                    yield pa.RecordBatch.from_arrays(work(key, data, found.slice(j, SOME)), names=names)

    # doc_id is carried so that this side equals that of the last join, and is shuffled once
    return rows.join(per_document, list(_KEY)).select("doc_id", *_KEY, "text", "a").mapInArrow(run, schema)


def _with_bytes(rows: DataFrame, wanted: DataFrame, length: int,
                encode: Callable[[str], np.ndarray] = text_bytes) -> DataFrame:
    """The bytes around the wanted anchors, cut out of the documents they stand in."""
    _, w = window_of(length)

    def work(key: list, data: np.ndarray, some: pa.StructArray) -> list:
        at = some.field("at").to_pylist()
        return [some.field("gram"), some.field("m"), some.field("n"), *(longs([k] * len(at)) for k in key),
                some.field("at"), pa.array([data[max(0, x - w + 1):x].tobytes() for x in at], pa.binary()),
                pa.array([data[x:x + length].tobytes() for x in at], pa.binary())]

    return _around(rows, wanted, encode, "gram bigint, m bigint, n bigint, k1 bigint, k2 bigint, at bigint, "
                                         "head binary, tail binary", work)


_SPAN = "k1 bigint, k2 bigint, begin bigint, finish bigint"


def _sorted_spans(contexts: DataFrame, length: int, unit: int = 1) -> DataFrame:
    """Spans of unique contexts, from groups that one task can sort."""
    names = [x.split()[0] for x in _SPAN.split(", ")]

    def judged(held: list[list]) -> pa.RecordBatch:
        gram, _, n, k1, k2, at, head, tail = held
        least, most = shared_windows(head, tail, np.array(gram), length, unit)
        keep = np.flatnonzero((most >= 0) & (np.array(n) == 1))
        k1, k2, at = (np.array(x, np.int64)[keep] for x in (k1, k2, at))
        return pa.RecordBatch.from_arrays(
            [longs(x) for x in (k1, k2, at - most[keep], at + length - least[keep])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(8)]
        for batch in batches:
            for column, more in zip(held, batch.columns):
                column += more.to_pylist()
            if len(held[0]) >= SORTED:
                last = held[0].index(held[0][-1])  # the last group may go on
                if last:
                    yield judged([x[:last] for x in held])
                    held = [x[last:] for x in held]
        if held[0]:
            yield judged(held)

    dealt = contexts.repartition(partitions(contexts.sparkSession), "gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, _SPAN)


def _counted_spans(rows: DataFrame, wanted: DataFrame, length: int,
                   encode: Callable[[str], np.ndarray] = text_bytes) -> DataFrame:
    """The same for groups of any size: windows around the wanted anchors are counted by hash."""
    _, w = window_of(length)

    def work(key: list, data: np.ndarray, some: pa.StructArray) -> list:
        one, two = _hashes(length)
        out = []
        for at in some.field("at").to_pylist():
            left = min(at, w - 1)
            raw = data[at - left:at + length]
            offsets = np.arange(left + 1)
            offsets = offsets[left - offsets + length <= len(raw)]
            starts = left - offsets
            out.append((offsets, *(x.of(x.sums(raw), starts, starts + length).view(np.int64) for x in (one, two))))
        sizes = [len(x[0]) for x in out]
        same = [np.repeat(some.field(k).to_numpy(), sizes) for k in ("gram", "at", "n")]
        keys = [np.full(sum(sizes), k) for k in key]
        return [longs(x) for x in (*same, *keys, *map(np.concatenate, zip(*out)))]

    windows = _around(rows, wanted, encode, "gram bigint, at bigint, n bigint, k1 bigint, k2 bigint, "
                                            "offset bigint, h1 bigint, h2 bigint", work)
    window = ["gram", "offset", "h1", "h2"]  # one place counts once for each of its anchors
    twice = windows.groupBy(*window).agg(F.sum("n").alias("t")).filter("t > 1").select(*window)
    found = windows.filter("n = 1").join(twice, window, "left_semi")
    return found.groupBy("k1", "k2", "at").agg(F.min("offset").alias("least"), F.max("offset").alias("most")).select(
        "k1", "k2", (F.col("at") - F.col("most")).alias("begin"),
        (F.col("at") + length - F.col("least")).alias("finish"))


def spans(rows: DataFrame, length: int = LENGTH, group: int = GROUP, *,
          encode: Callable[[str], np.ndarray] = text_bytes, least: int | None = None) -> DataFrame:
    """(k1, k2, begin, finish): repeated bytes of documents from ``keyed``; may overlap."""
    _, w = window_of(length)
    marks = stored(anchor_rows(rows, length, encode, least), "anchors")
    owners = stored(marks.filter("k1 IS NOT NULL").select("doc", *_KEY), "owners")
    twice = marks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    again = stored(marks.select("gram", "context", "doc", "spot")
                   .join(twice.hint("shuffle_hash"), "gram", "left_semi"), "repeated-anchors")
    dropped(marks)
    release_shuffles(rows.sparkSession)

    # both firsts come from one row, and contexts that stand once have only one
    contexts = stored(again.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.first("doc").alias("doc"), F.first("spot").alias("spot")), "contexts")
    copies = contexts.filter("n > 1").select("gram", "context")
    at, right = F.shiftright("spot", _SPOT_BITS), F.col("spot").bitwiseAND((1 << _SPOT_BITS) - 1)
    left = F.least(F.col("at"), F.lit(w - 1))
    covered = stored(
        again.join(copies, ["gram", "context"], "left_semi")
        .select("doc", at.alias("at"), right.alias("r")).filter(left + F.col("r") >= length)
        .select("doc", (F.col("at") - left).alias("begin"), (F.col("at") + F.col("r")).alias("finish"))
        .join(owners, "doc").select(*_KEY, "begin", "finish").distinct(), "covered")
    dropped(again)
    mixed = (contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("fewest"))
             .filter("m > 1 AND fewest = 1").select("gram", "m"))
    wanted = stored(contexts.join(mixed, "gram").join(owners, "doc")
                    .select(*_KEY, "gram", "m", "n", at.alias("at")), "wanted")
    # the texts are shuffled next: nothing of the steps above is on disk beside them
    dropped(contexts)
    dropped(owners)
    release_shuffles(rows.sparkSession)
    small = _with_bytes(rows, wanted.filter(F.col("m") <= group), length, encode)
    large = _counted_spans(rows, wanted.filter(F.col("m") > group), length, encode)
    return covered.unionByName(_sorted_spans(small, length, encode("").itemsize)).unionByName(large)


def merged(begins: list[int], finishes: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(begins, finishes)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def merged_rows(found: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``merged`` for every row of a column: ends of the rows' runs among all, begins, finishes."""
    row = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy())
    begin, finish = (found.flatten().field(k).to_numpy() for k in ("begin", "finish"))
    order = np.lexsort((begin, row))
    row, begin, finish = row[order], begin[order], finish[order]
    base = row * (finish.max(initial=0) + 1)  # no run goes on into the next row
    reach = np.maximum.accumulate(base + finish)
    fresh = np.flatnonzero(np.append(True, (base + begin)[1:] > reach[:-1])[:len(row)])
    last = np.append(fresh[1:], len(row))[:len(fresh)] - 1
    return np.cumsum(np.bincount(row[fresh], minlength=len(found))), begin[fresh], (reach - base)[last]


def _kept(data: bytes, cut: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in cut:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def _word_spans(rows: DataFrame, words: int) -> DataFrame:
    """(k1, k2, begin, finish): words of passages that repeat, numbered from 0."""
    return spans(rows, words, encode=word_codes, least=words)


def _collected(found: DataFrame, name: str) -> DataFrame:
    return found.groupBy(*_KEY).agg(F.collect_list(F.struct("begin", "finish")).alias(name))


def repeated_spans(documents: DataFrame, length: int = LENGTH, words: int = PASSAGE) -> DataFrame:
    """Every row's repeated bytes and, beside them, its repeated passages: doc_id, n_bytes,
    n_removed, n_spans, kept_sha256, spans, then n_passages (runs of repeated passages of
    ``words`` words or more) and n_passage_words (their words)."""
    schema = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
              "spans array<struct<begin:bigint,finish:bigint>>, n_passages bigint, n_passage_words bigint")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "n_passages", "n_passage_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                (ends, begin, finish), passages = (merged_rows(part.column(i)) for i in (2, 3))
                bounds, texts = np.append(0, ends), part.column(1).cast(pa.binary()).to_pylist()
                kept = [hashlib.sha256(_kept(data, list(zip(begin[a:b].tolist(), finish[a:b].tolist())))).hexdigest()
                        for data, a, b in zip(texts, bounds[:-1], bounds[1:])]
                each = pa.StructArray.from_arrays([longs(begin), longs(finish)], names=["begin", "finish"])
                sums = [np.append(0, np.cumsum(f - a))[np.append(0, e)] for e, a, f in ((ends, begin, finish), passages)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), longs([len(x) for x in texts]), longs(np.diff(sums[0])), longs(np.diff(bounds)),
                     strings(kept), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each),
                     longs(np.diff(np.append(0, passages[0]))), longs(np.diff(sums[1]))], names=names)

    rows = keyed(documents)
    in_bytes = stored_result(lambda: spans(rows, length), "byte-spans")
    release_shuffles(documents.sparkSession)
    in_words = stored_result(lambda: _word_spans(rows, words), "word-spans")
    release_shuffles(documents.sparkSession)
    tagged = in_bytes.withColumn("words", F.lit(False)).unionByName(in_words.withColumn("words", F.lit(True)))
    place = F.struct("begin", "finish")
    found = tagged.groupBy(*_KEY).agg(
        F.collect_list(F.when(~F.col("words"), place)).alias("in_bytes"),
        F.collect_list(F.when(F.col("words"), place)).alias("in_words"))
    return (rows.join(found, list(_KEY), "left").select("doc_id", "text", "in_bytes", "in_words")
            .mapInArrow(run, schema))


def _kept_words(text: str, cut: list[tuple[int, int]]) -> str:
    """The text without the words in a span."""
    places = [m.span() for m in WORD.finditer(text)]
    at, parts = 0, []
    for a, b in cut:
        parts.append(text[at:places[a][0]])
        at = places[b - 1][1]
    parts.append(text[at:])
    return "".join(parts)


def _kept_bytes(text: str, cut: list[tuple[int, int]]) -> str:
    return _kept(text.encode(), cut).decode(errors="ignore")


def _cut(documents: DataFrame, find: Callable[[DataFrame], DataFrame],
         kept: Callable[[str, list[tuple[int, int]]], str]) -> DataFrame:
    """The documents, with what was found cut out.  Their columns travel in one struct, so no
    name of theirs can clash."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, begins: pd.Series, finishes: pd.Series) -> pd.Series:
        return pd.Series([kept(t, merged(list(a), list(b)))
                          for t, a, b in zip(texts, begins, finishes)], dtype=object)

    found = _collected(find(keyed(documents)), "found")
    text, doc = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").cast("bigint")
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    rows = documents.select(F.coalesce(doc, F.lit(-1)).alias("k1"), F.xxhash64(doc, text).alias("k2"),
                            F.col("text").alias("whole"), F.struct(*others).alias("row"))
    joined = rows.join(found, list(_KEY), "left")
    shorter = F.when(F.col("found").isNotNull(), cut(
        F.coalesce(F.col("whole"), F.lit("")),
        *(F.coalesce(F.col(f"found.{x}"), F.array().cast("array<bigint>")) for x in ("begin", "finish"))
    )).otherwise(F.col("whole"))
    cut_text = joined.select("row", shorter.alias("text"))
    return cut_text.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c)
                             for c in documents.columns])


def cut_documents(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated bytes taken out of their texts and all columns kept."""
    return _cut(documents, lambda rows: spans(rows, length), _kept_bytes)


def cut_passages(documents: DataFrame, words: int = PASSAGE) -> DataFrame:
    """The documents without the passages of ``words`` words or more that also stand elsewhere.

    What stays keeps its own white space; all columns are kept.
    """
    return _cut(documents, lambda rows: _word_spans(rows, words), _kept_words)
