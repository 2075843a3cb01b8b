"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes decides where a text is cut: at block size 2**L,
wherever its low L bits are zero, so a cut depends on its context alone and an edit changes
only the chunks it touches.  A cut less than a quarter of the block size behind the last one
is passed over, and four block sizes without a cut make one; so a signature's length is
bounded for periodic texts too.  Each chunk becomes a symbol of twelve bits, two base64
digits.  L follows the number of bytes, for about 48 to 96 chunks; a fingerprint holds the
symbols at that block size and at twice that size:

    L:symbols at 2**L:symbols at 2**(L+1)

Two fingerprints are compared at the block sizes they share, by the edit distance of their
symbols over the longer one's length; without a common size their likeness is zero.

Texts are dealt once, by ranges of ``doc_id``, so that a document stands in front of the
next one; only the last document of a range waits for the first one of the next range.

Defined results
* null text counts as empty; an empty text's fingerprint is ``0::``, which equals itself
  (likeness 1) and nothing else (likeness 0).
* rows with one ``doc_id`` follow each other by a hash of their text, and a null ``doc_id``
  stands before all others; equal rows follow each other, so the next document of all but the
  last of them is the same text.  A single row is its own next document.
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import SLICE_ROWS, id_and_text, stored

#: Bytes of context that decide on a cut.
CONTEXT = 7
#: Chunks of a text, at least, at the smaller of its two block sizes.
CHUNKS = 48

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = [a + b for a in _DIGITS for b in _DIGITS]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_POWERS = np.cumprod(np.full(1 << 16, _BASE, np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * _FACTOR
    return values ^ (values >> np.uint64(32))


def context_hashes(values: np.ndarray) -> np.ndarray:
    """A hash of the last bytes up to each one."""
    padded = np.concatenate([np.zeros(CONTEXT - 1, np.uint64), values])
    rolled = padded[CONTEXT - 1:].copy()
    for i in range(1, CONTEXT):
        rolled += padded[CONTEXT - 1 - i:len(padded) - i] * _POWERS[i - 1]
    return _mixed(rolled)


def chunk_ends(hashes: np.ndarray, size: int) -> list[int]:
    """Behind which bytes a text is cut at a block size; the last byte is the last end."""
    least, most, last = size // 4, size * 4, len(hashes) - 1
    out, before = [], -1
    for cut in [*np.flatnonzero((hashes & np.uint64(size - 1)) == 0).tolist(), last]:
        if cut - before < least and cut != last:
            continue
        out.extend(range(before + most, cut, most))
        out.append(cut)
        before = cut
    return out[:-1] if len(out) > 1 and out[-2] == last else out


def _signature(values: np.ndarray, hashes: np.ndarray, size: int) -> str:
    """A symbol for each chunk."""
    ends = np.array(chunk_ends(hashes, size))
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(values)) - np.repeat(starts, ends - starts + 1)
    sums = np.add.reduceat(values * _POWERS.take(place, mode="wrap"), starts)
    return "".join([_SYMBOLS[i] for i in (_mixed(sums) >> np.uint64(52)).tolist()])


def fingerprint(text: str) -> str:
    """``L:symbols:symbols`` of a whole text."""
    values = np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
    if not len(values):
        return "0::"
    level = max((len(values) // CHUNKS).bit_length() - 1, 0)
    hashes = context_hashes(values)
    parts = [_signature(values, hashes, 1 << x) for x in (level, level + 1)]
    return f"{level}:{parts[0]}:{parts[1]}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements of symbols, a column of bits per step."""
    x = [a[i:i + 2] for i in range(0, len(a), 2)]
    y = [b[i:i + 2] for i in range(0, len(b), 2)]
    if not x or not y:
        return len(x) + len(y)
    places: dict[str, int] = {}
    for i, symbol in enumerate(x):
        places[symbol] = places.get(symbol, 0) | 1 << i
    full, top = (1 << len(x)) - 1, 1 << len(x) - 1
    up, down, distance = full, 0, len(x)
    for symbol in y:
        equal = places.get(symbol, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        distance += bool(right & top) - bool(left & top)
        right = right << 1 | 1
        up = (left << 1 | ~(diagonal | right)) & full
        down = right & diagonal & full
    return distance


def likeness(a: str, b: str) -> float:
    """0 to 1: the larger of the likenesses at the block sizes that both have."""
    if a == b:
        return 1.0
    sizes = []
    for text in (a, b):
        level, *parts = text.split(":")
        sizes.append({int(level) + i: part for i, part in enumerate(parts) if part})
    shared = sizes[0].keys() & sizes[1].keys()
    return max((1 - edit_distance(x, y) / (max(len(x), len(y)) // 2)
                for x, y in ((sizes[0][s], sizes[1][s]) for s in shared)), default=0.0)


def edited(text: str, after: str) -> str:
    """The last quarter replaced by as many code points from the start of the next text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + after[:quarter]


_OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _row(doc, text: str, own: str, after: str, after_print: str) -> tuple:
    new = edited(text, after)
    new_print = own if new == text else fingerprint(new)
    return (doc, len(text), hashlib.sha256(new.encode()).hexdigest(), own, new_print,
            likeness(own, new_print), likeness(own, after_print))


def _record(rows: list, more: dict | None = None) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)] if rows else [
        pa.array([], t) for t in _TYPES]
    more = more or {}
    return pa.RecordBatch.from_arrays([*columns, *more.values()], names=[*_NAMES, *more])


def _followed(batches):
    """Rows of a range in order.  All but the last document are finished; the first and the
    last one are handed on with their text (``edge`` 1: first, 2: last)."""
    def marked(rows, edge, part, text):
        n = len(rows)
        return _record(rows, {"part": pa.array([part] * n, pa.int32()), "edge": pa.array([edge] * n, pa.int32()),
                              "text": pa.array([text] * n, pa.string())})

    before = part = None
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            docs, texts, parts = (c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns)
            done = []
            for doc, text in zip(docs, texts):
                same = before is not None and before[1] == text
                now = (doc, text, before[2] if same else fingerprint(text))
                if before is None:
                    part = parts[0]
                    yield marked([(doc, None, None, now[2], None, None, None)], 1, part, text)
                else:
                    done.append(_row(*before, text, now[2]))
                before = now
            yield marked(done, 0, part, None)
    if before is not None:
        yield marked([(before[0], None, None, before[2], None, None, None)], 2, part, before[1])


def _finished(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            yield _record([_row(row["doc_id"], row["text"], row["fingerprint"],
                                row["after"], row["after_print"])])


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited form, and their likeness to it and to the
    next document's."""
    ordered = (id_and_text(documents)
               .withColumn("tie", F.xxhash64("text")).withColumn("rid", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "tie", "rid").sortWithinPartitions("doc_id", "tie", "rid")
               .select("doc_id", "text", F.spark_partition_id().alias("part")))
    found = stored(ordered.mapInArrow(_followed, f"{_OUT}, part int, edge int, text string"), "fingerprints")

    # one row per range: the first document of the next range that holds any
    heads = found.filter("edge = 1").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("after_print"))
    parts = heads.select("part")
    by_part = W.orderBy("part")
    following = parts.select(F.col("part").alias("at"), F.coalesce(
        F.lead("part").over(by_part), F.first("part").over(by_part)).alias("part"))
    tails = (found.filter("edge = 2").select("doc_id", "fingerprint", "text", F.col("part").alias("at"))
             .join(following, "at").join(heads, "part")
             .select("doc_id", "fingerprint", "text", "after", "after_print"))
    return (found.filter("edge = 0").select(*_NAMES)
            .unionByName(tails.mapInArrow(_finished, _OUT)))
