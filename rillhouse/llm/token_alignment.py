"""Alignment of two tokenizers' tokens by coalescing their byte intervals.

Every text is encoded by a byte-level BPE (A, over a space and the text) and by a piece BPE
with byte fallback (B, which adds that space itself).  Both cut the same bytes, so each
token is an interval.  The intervals of A and B of a slice of documents are sorted together
by start with a lexsort; a running maximum of their ends tells where a start reaches
everything before it, and there a group ends.  Inside the groups, each A token expands to
the B tokens whose bytes it overlaps: the links.

Over the corpus, an id pair counts the documents that hold it linked.  Documents are dealt
to blocks of bounded size where they are encoded.  A block's different pairs are far fewer
than its links, and only these are shuffled: summed over blocks into the counts, and given
back to each block with the counts.  A pair that nearly every document holds is one row per
block.  The highest count of each A id has at most as many rows as A's vocabulary, so it is
broadcast.

Defined results
* texts that are null or empty, or whose joined A or B bytes differ from the space and the
  text, have no tokens: zeros and an empty ``groups_sha256``.
* special token strings inside a text are plain text.
* every row is aligned, repeated rows too, and each counts as a document of its own; a null
  ``doc_id`` is carried through; an empty table gives an empty result; other columns are
  not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import id_and_text, longs, stored, strings

BYTE_BPE, PIECE_BPE = "byte_bpe_50k", "piece_bpe_32k"
#: A block of documents ends at so many rows, or at so many bytes of text.
BLOCK_ROWS, BLOCK_BYTES = 512, 1 << 20

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def piece_bytes(piece: str) -> bytes:
    """Bytes that a piece of a byte-fallback vocabulary stands for."""
    single = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()


class TokenizerPair:
    """Ids and token bytes of both tokenizers."""

    def __init__(self, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE):
        import public_tokenizers as public
        import sentencepiece
        import tiktoken

        with open(public.path(f"{byte_bpe}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # without special tokens their strings are ordinary text
        encoding = tiktoken.Encoding("a", pat_str=public.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
        self.encode_a = encoding.encode_ordinary
        pieces = sentencepiece.SentencePieceProcessor(model_file=public.path(f"{piece_bpe}.model"))
        self.encode_b = lambda text: pieces.encode(text, num_threads=1)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [piece_bytes(pieces.id_to_piece(i)) for i in range(pieces.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        numbers = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        #: id texts behind the mark that parts them from what stands before
        self.marked = {mark: np.array([mark + n for n in numbers], object) for mark in ",|;"}

    def encode(self, text: str | None) -> tuple[list, list]:
        """Ids of A and B, both empty where their bytes are not those of the text."""
        if not text:
            return [], []
        spaced = " " + text
        data = spaced.encode()
        a, b = self.encode_a(spaced), self.encode_b(text)
        same = (b"".join([self.a_bytes[i] for i in a]) == data
                and b"".join([self.b_bytes[i] for i in b]) == data)
        return (a, b) if same else ([], [])


_known: dict[tuple, TokenizerPair] = {}


def tokenizer_pair(byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> TokenizerPair:
    """The pair of a worker process, kept between its tasks."""
    key = (byte_bpe, piece_bpe)
    if key not in _known:
        _known[key] = TokenizerPair(*key)
    return _known[key]


def coalesced(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval, numbered by position."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order[1:]] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group


def overlaps(a_ends, a_sizes, b_ends, b_sizes) -> tuple[np.ndarray, np.ndarray]:
    """Positions in A and B of all pairs that share a byte; both cut the bytes without gaps."""
    a_starts, b_starts = a_ends - a_sizes, b_ends - b_sizes
    first = np.searchsorted(b_ends, a_starts, "right")
    times = np.searchsorted(b_starts, a_ends, "left") - first
    in_a = np.repeat(np.arange(len(a_ends)), times)
    in_b = np.arange(len(in_a)) - np.repeat(np.cumsum(times) - times - first, times)
    return in_a, in_b


class Aligned:
    """Tokens, groups and links of a slice of documents, laid one behind the other."""

    def __init__(self, pair: TokenizerPair, texts: list):
        a_ids, b_ids = array("q"), array("q")
        counts = np.zeros((2, len(texts)), np.int64)
        for row, text in enumerate(texts):
            a, b = pair.encode(text)
            a_ids.extend(a)
            b_ids.extend(b)
            counts[:, row] = len(a), len(b)
        self.n_a, self.n_b = counts
        self.a, self.b = (np.frombuffer(x, np.int64) if x else np.zeros(0, np.int64) for x in (a_ids, b_ids))
        sizes_a, sizes_b = pair.a_sizes[self.a], pair.b_sizes[self.b]
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        ends = np.concatenate([ends_a, ends_b])
        self.group = coalesced(ends - np.concatenate([sizes_a, sizes_b]), ends)
        self.link_a, self.link_b = overlaps(ends_a, sizes_a, ends_b, sizes_b)
        rows = np.arange(len(texts))
        self.doc_a, doc_b = np.repeat(rows, self.n_a), np.repeat(rows, self.n_b)
        self.link_doc = self.doc_a[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=len(texts))
        # a document's first group holds its first token, its last group its last
        group_a, group_b = self.group[:len(self.a)], self.group[len(self.a):]
        groups = np.zeros(int(self.group.max(initial=-1)) + 1, np.int64)
        groups[group_a] = self.doc_a
        self.n_groups = np.bincount(groups, minlength=len(texts))
        self.order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        self.pair = pair

    def listings(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document."""
        side = np.repeat([0, 1], [len(self.a), len(self.b)])[self.order]
        ids = np.concatenate([self.a, self.b])[self.order]
        place = self.group[self.order] * 2 + side
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        words = self.pair.marked[","][ids]
        for mark, chosen in ((";", first & (side == 0)), ("|", first & (side == 1))):
            words[chosen] = self.pair.marked[mark][ids[chosen]]
        words = words.tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[a:b])[1:] for a, b in zip([0, *ends], ends)]

    def linked_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different id pairs per document, document by document: how many pairs each
        document has, the pairs as a * 2**32 + b, and how often each is linked."""
        keys, index = np.unique((self.a[self.link_a] << 32) | self.b[self.link_b], return_inverse=True)
        cells, times = np.unique(self.link_doc * max(len(keys), 1) + index, return_counts=True)
        per_doc = np.bincount(cells // max(len(keys), 1), minlength=len(self.n_a))
        return per_doc, keys[cells % max(len(keys), 1)], times


def _blocks(batch: pa.RecordBatch):
    """Bounds of the blocks in a batch."""
    sizes = np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32)[
        batch.column(1).offset:batch.column(1).offset + batch.num_rows + 1]) if batch.num_rows else []
    begin = held = 0
    for row, size in enumerate(sizes):
        if row > begin and (row - begin >= BLOCK_ROWS or held + size > BLOCK_BYTES):
            yield begin, row
            begin, held = row, 0
        held += size
    if batch.num_rows:
        yield begin, batch.num_rows


_ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "groups_sha256 string, block bigint, pairs array<bigint>, times array<int>")


def aligned(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Counts and groups per document, its block, and its different linked id pairs
    (a * 2**32 + b) with how often each is linked."""
    def run(batches):
        pair = tokenizer_pair(byte_bpe, piece_bpe)
        for batch in batches:
            for begin, end in _blocks(batch):
                part = batch.slice(begin, end - begin)
                found = Aligned(pair, part.column(1).to_pylist())
                sha = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.listings()]
                per_doc, pairs, times = found.linked_pairs()
                at = pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32())
                block = part.column(2)[0].as_py()
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *map(longs, (found.n_a, found.n_b, found.n_groups, found.n_links)),
                    strings(sha), longs([block] * len(sha)),
                    pa.ListArray.from_arrays(at, longs(pairs)),
                    pa.ListArray.from_arrays(at, pa.array(times, pa.int32()))],
                    names=[x.split()[0] for x in _ALIGNED.split(", ")])

    numbered = id_and_text(documents).withColumn("rid", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, _ALIGNED)


def pair_counts(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different pairs of each block, and over all blocks: pair, a, count."""
    of_block = (found.select("block", F.explode("pairs").alias("pair"))
                .groupBy("block", "pair").agg(F.count(F.lit(1)).alias("docs")))
    counts = (of_block.groupBy("pair").agg(F.sum("docs").alias("count"))
              .withColumn("a", F.shiftright("pair", 32)))
    return of_block.select(F.col("block").alias("in_block"), "pair"), counts


_RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


def _judged(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Looks the pairs of a block's documents up in the counts of the block's pairs."""
    docs = docs.combine_chunks()
    order = np.argsort(known["pair"].to_numpy())
    pairs, counts, best = (known[x].to_numpy()[order] for x in ("pair", "count", "best"))
    lists = docs["pairs"].to_pylist()
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.array([p for x in lists for p in x], np.int64)
    times = np.array([t for x in docs["times"].to_pylist() for t in x], np.int64)
    at = np.searchsorted(pairs, flat)
    ends = np.cumsum(sizes)

    def total(values):
        running = np.concatenate([[0], np.cumsum(values)])
        return longs(running[ends] - running[ends - sizes])

    n_best = total(times * (counts[at] == best[at])) if len(flat) else longs(sizes * 0)
    count_sum = total(times * counts[at]) if len(flat) else longs(sizes * 0)
    names = [x.split()[0] for x in _RESULT.split(", ")]
    given = {"n_best": n_best, "count_sum": count_sum}
    return pa.table({n: given[n] if n in given else docs[n] for n in names})


def alignment(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    found = stored(aligned(documents, byte_bpe, piece_bpe), "aligned")
    of_block, counts = pair_counts(found)
    counts = stored(counts, "pair-counts")
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    known = (of_block.join(counts, "pair").join(F.broadcast(best), "a")
             .select("in_block", "pair", "count", "best"))
    return (found.groupBy("block").cogroup(known.groupBy("in_block"))
            .applyInArrow(_judged, _RESULT))
