"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes.  Two that differ in at most three bits differ in
at most three bytes, so they share at least five of the eight: that is the guaranteed
minimum number of matches.  Lists of single bytes would hold a 256th of all fingerprints
each, so the index files a fingerprint under each choice of five positions with their bytes;
two fingerprints meet in a list exactly when they reach the minimum.  Inside a list the
shared positional bytes of each pair are tallied; a pair is retained only where the tally
reaches the minimum and this list is the first of those it shares, and only the bits of
retained pairs are compared.

A list fixes five bytes, so it holds 2^24 distinct fingerprints at the very most whatever
the corpus, and equal fingerprints are one entry.  Of a list only links to the smallest
member of each of its clusters leave the task, never all pairs.

Defined results
* null text counts as empty; texts without words share fingerprint zero and are linked
  like any other.
* repeated rows each appear; a null ``doc_id`` takes part but names no component unless
  the whole component has null ids.
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import id_and_text, longs, map_slices, partitions, stored
from rillhouse.llm.components import components

#: Bytes of a text split into words at once.
BLOCK_BYTES = 1 << 20
#: Members of a list compared in one go, all against all, inside numpy.
PAIR_BLOCK = 2048


# ------------------------------------------------------------------ fingerprints

def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, block by block; a word is never cut."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK_BYTES)
        while end < n and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end].split()
        at = end


def shingle_hashes(words: list[bytes], width: int) -> list[int]:
    """Hashes of all runs of ``width`` words; fewer words are one run."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) < width:
        return [xxhash.xxh64_intdigest(joined, 42)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in
            zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())]


def votes_of(hashes) -> np.ndarray:
    """How many of the shingles' hashes set each of the 64 bits, highest bit first."""
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):  # sums of 255 bits fit a byte, which numpy adds fastest
        votes += bits[at:at + 255].sum(0, dtype=np.uint8)
    return votes


def majority(votes: np.ndarray, shingles: int) -> int:
    """The fingerprint: bits that over half of the shingles set."""
    return int(np.packbits((votes * 2 > shingles).astype(np.uint8)).view(">u8")[0])


def fingerprint(text: str, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    votes, shingles, carry = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.encode().lower()):
        words = carry + words
        if len(words) >= width:
            votes += votes_of(shingle_hashes(words, width))
            shingles += len(words) - width + 1
            carry = words[len(words) - width + 1:]
        else:
            carry = words
    if not shingles and carry:
        votes, shingles = votes_of(shingle_hashes(carry, width)), 1
    return majority(votes, shingles)


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp (signed 64-bit) for every row."""
    def make():
        def work(ids, texts):
            prints = np.array([fingerprint(t, width) for t in texts], np.uint64)
            return longs(ids), longs(prints.view(np.int64))
        return work

    return map_slices(id_and_text(documents), make, "doc_id bigint, fp bigint")


# ------------------------------------------------------------------ links

def _choices(minimum: int) -> list[int]:
    """Byte masks of every choice of ``minimum`` positions, as signed 64-bit numbers."""
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(8), minimum)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the clusters of each pair a-b; ``root`` names the smallest member of each."""
    while True:
        x, y = root[a], root[b]
        if np.array_equal(x, y):
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, root[root]):
            root[:] = root[root]


def first_choices(minimum: int) -> np.ndarray:
    """For every set of shared positions (a bit each): the number of the first choice of
    ``minimum`` of them, or -1 if there are not as many."""
    numbers = {chosen: i for i, chosen in enumerate(combinations(range(8), minimum))}
    out = []
    for shared in range(256):
        positions = [p for p in range(8) if shared >> p & 1]
        out.append(numbers[tuple(positions[:minimum])] if len(positions) >= minimum else -1)
    return np.array(out)


def shared_positions(apart: np.ndarray) -> np.ndarray:
    """The positions of equal bytes, a bit each, from two fingerprints' difference."""
    zero = (np.ascontiguousarray(apart).astype("<u8").view(np.uint8).reshape(*apart.shape, 8) == 0)
    return np.packbits(zero, axis=-1, bitorder="little")[..., 0]


def _near(apart: np.ndarray, choice, first: np.ndarray, max_bits: int) -> tuple:
    """Places of the pairs that this list retains and whose bits are near enough."""
    retained = np.nonzero(first[shared_positions(apart)] == choice)  # one choice, or one per pair
    near = np.bitwise_count(apart[retained]) <= max_bits
    return tuple(x[near] for x in retained)


def _list_links(values: np.ndarray, choice: int, first: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (hi, lo) inside one sorted list of distinct fingerprints, as star edges.

    Block by block, so that neither all pairs nor all links are ever held.
    """
    n, bits, root = len(values), values.view(np.uint64), np.arange(len(values))
    for i in range(0, n, PAIR_BLOCK):
        for j in range(i, n, PAIR_BLOCK):
            apart = bits[i:i + PAIR_BLOCK, None] ^ bits[None, j:j + PAIR_BLOCK]
            a, b = _near(apart, choice, first, max_bits)
            _merge(root, a + i, b + j)
    linked = np.flatnonzero(root != np.arange(n))
    return values[linked], values[root[linked]]


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(hi, lo) links whose closure is that of all pairs within ``max_bits`` bits.

    ``prints`` has distinct values in the bigint column ``fp``.
    """
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7: at 8 no positional byte has to match")
    minimum = 8 - max_bits
    masks, first = _choices(minimum), first_choices(minimum)
    filed = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("held"))
        for i, m in enumerate(masks)]))
    lists = prints.select("fp", filed.alias("k")).select("k.choice", "k.held", "fp")
    lists = (lists.repartition(partitions(prints.sparkSession), "choice", "held")
             .sortWithinPartitions("choice", "held", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in chain(_arrays(batches), [None]):
            now = [np.concatenate(x) for x in zip(carry, batch)] if carry and batch else (batch or carry)
            if now is None:
                return
            choice, held, fp = now
            new = np.flatnonzero((choice[1:] != choice[:-1]) | (held[1:] != held[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(fp)]])
            last = len(bounds) - 1 if batch is None else len(bounds) - 2
            sizes = np.diff(bounds)[:last]
            at = bounds[:-1][:last][sizes == 2]
            apart = (fp[at] ^ fp[at + 1]).view(np.uint64)  # all lists of two members at once
            two, = _near(apart, choice[at], first, max_bits)
            out = [(fp[at[two] + 1], fp[at[two]])]  # lists are sorted
            for k in np.flatnonzero(sizes > 2):
                a, b = bounds[k], bounds[k + 1]
                out.append(_list_links(fp[a:b], int(choice[a]), first, max_bits))
            hi, lo = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([longs(hi), longs(lo)], names=["hi", "lo"])
            carry = None if batch is None else [x[bounds[last]:] for x in now]

    return lists.mapInArrow(run, "hi bigint, lo bigint").distinct()


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield [c.to_numpy(zero_copy_only=False) for c in batch.columns]


# ------------------------------------------------------------------ the operator

def near_duplicates(documents: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp, component_id for every row; component_id is the smallest id reachable."""
    rows = stored(fingerprints(documents, width), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints.select("fp"), max_bits))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(of_root, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows of one id count as one document.
    """
    found = near_duplicates(documents, width, max_bits)
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_keep_doc")).distinct())
    return documents.join(kept, documents["doc_id"].eqNullSafe(kept["_keep_doc"]), "left_semi")
