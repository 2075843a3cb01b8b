"""Best-fit packing of token sequences by bin completion.

Documents are encoded inside the tasks; those longer than a sequence are cut so that only
the first piece is short, and full pieces are sequences of their own.  What is left to
pack are lengths from 1 to the capacity.  Their histogram has at most ``capacity`` entries
whatever the corpus, and the plan is made on it:

* incumbents come from best-fit decreasing over the histogram;
* bin completion then branches on how the sequence around the largest remaining length is
  filled, over undominated fillings only, best fit first;
* a branch ends when the waste so far, with the waste that no filling can avoid, leaves no
  room for a solution with fewer sequences than the incumbent;
* a filling is used as often as the counts allow, so the depth follows the number of
  different lengths, not of documents.

The plan (a few thousand runs at most) is looked up by length and rank.  Ranks come from
counts per length and hash slot, so a length that very many documents share is spread.

Defined results
* null text counts as empty and is one piece that holds the end token.
* every row is packed, repeated rows too; ties are broken in any way; a null ``doc_id``
  is carried through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import id_and_text, longs, map_slices, partitions, stored

CAPACITY = 1024
END_TOKEN = 2
#: Texts between special tokens are split into pieces at white space before encoding;
#: as many encoded pieces are kept for reuse, in two generations.
KEPT_PIECES = 150_000
#: Second lengths and fillings tried at one step of the search, and steps of the search.
SECONDS, FILLINGS, STEPS = 48, 6, 10_000

_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


# ------------------------------------------------------------------ encoding

class PieceCache(dict):
    """Encoded pieces; the older generation is dropped when the younger one is full."""

    def __init__(self, encode, limit: int = KEPT_PIECES):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class ByteLevelEncoder:
    """Ids of a byte-level BPE as little-endian unsigned 32-bit bytes.

    The rank file holds the vocabulary of the tokenizer file under the same name.  A token
    never spans from a character that is no white space to one that is, so a text whose
    white space is spaces and line feeds is the sum of pieces that begin there.
    """

    def __init__(self, rank_file: str, pattern: str, special: dict[str, int]):
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        bpe = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.plain = lambda text: np.array(bpe.encode_ordinary(text), "<u4").tobytes()
        self.pieces = PieceCache(self.plain)

    def _ordinary(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text):
            return self.plain(text)
        pieces = self.pieces
        return b"".join([pieces[p] for p in _PIECES.findall(text)])

    def __call__(self, text: str) -> bytes:
        if self.split is None or not any(s in text for s in self.special):
            return self._ordinary(text)
        parts = self.split.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special
                        else self._ordinary(p) for p in parts if p)


_encoders: dict[str, ByteLevelEncoder] = {}


def byte_encoder(name: str = "byte_bpe_50k") -> ByteLevelEncoder:
    """The encoder of a worker process, kept between its tasks."""
    if name not in _encoders:
        import json

        import public_tokenizers as public

        with open(public.path(f"{name}.json"), encoding="utf-8") as file:
            special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        _encoders[name] = ByteLevelEncoder(public.path(f"{name}.tiktoken"), public.PATTERN, special)
    return _encoders[name]


def pieces(documents: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids, if wanted) of every piece."""
    def make():
        encode = byte_encoder()
        end = np.array([END_TOKEN], "<u4").tobytes()

        def work(docs, texts):
            out = [[] for _ in range(5 + with_ids)]
            for doc, text in zip(docs, texts):
                ids = encode(text) + end
                total = len(ids) // 4
                first = total % capacity or min(total, capacity)
                starts = [0, *range(first, total, capacity)]
                for number, (a, b) in enumerate(zip(starts, [*starts[1:], total])):
                    part = ids[4 * a:4 * b]
                    row = (doc, number, a, b - a, zlib.crc32(part))
                    for column, value in zip(out, row):
                        column.append(value)
                    if with_ids:
                        out[5].append(np.frombuffer(part, "<u4"))
            columns = [longs(out[0]), pa.array(out[1], pa.int32()), *map(longs, out[2:5])]
            if with_ids:
                columns.append(pa.array([x.tolist() for x in out[5]], pa.list_(pa.int64())))
            return columns
        return work

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_slices(id_and_text(documents), make, schema + (", ids array<bigint>" if with_ids else ""))


# ------------------------------------------------------------------ the plan

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used: longest first, each gap filled by the longest
    length that fits."""
    left, out = dict(counts), []
    sizes = sorted(left)
    while sizes:
        room, used = capacity, []
        upto = len(sizes)
        while upto:
            at = bisect_right(sizes, room, 0, upto) - 1
            if at < 0:
                break
            size = sizes[at]
            take = min(left[size], room // size)
            used.append((size, take))
            room -= take * size
            upto = at
        times = min(left[s] // n for s, n in used)
        out.append((tuple(used), times))
        for s, n in used:
            left[s] -= n * times
            if not left[s]:
                sizes.remove(s)
    return out


def fillings(sizes: list[int], counts: dict[int, int], capacity: int,
             most: int = FILLINGS) -> list[tuple[int, Filling]]:
    """Undominated ways to fill the sequence around the largest length, as (waste, filling),
    best fit first.  ``sizes`` are the lengths in use, ascending.

    Each candidate for the second place is completed by the longest lengths that still fit,
    so nothing can be added.  A filling is dominated if a longer free length fits in place
    of one in it; of the rest the ``most`` with least waste are returned.
    """
    first = sizes[-1]
    found = {}
    start = bisect_right(sizes, capacity - first) - 1
    for second in range(start, max(-1, start - SECONDS), -1):
        room, taken, at = capacity - first, {first: 1}, second
        while at >= 0:
            size = sizes[at]
            copies = min(counts[size] - taken.get(size, 0), room // size)
            if copies > 0:
                taken[size] = taken.get(size, 0) + copies
                room -= copies * size
            at = min(at - 1, bisect_right(sizes, room) - 1)
        found[tuple(taken.items())] = room
    if not found:
        found[((first, 1),)] = capacity - first

    def dominated(filling: Filling, room: int) -> bool:
        taken = dict(filling)
        for size, _ in filling[1:]:
            low, high = bisect_right(sizes, size), bisect_right(sizes, size + room)
            if any(counts[x] > taken.get(x, 0) for x in sizes[low:high]):
                return True
        return False

    order = sorted((room, filling) for filling, room in found.items())
    kept = [x for x in order if x[0] == 0 or not dominated(x[1], x[0])]
    return (kept or order)[:most]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: the sum, or more if long lengths cannot share."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    for k in range(1, capacity // 2 + 1):
        over = sum(n for s, n in counts.items() if s > capacity - k)
        middle = sum(n for s, n in counts.items() if capacity / 2 < s <= capacity - k)
        space = middle * capacity - sum(s * n for s, n in counts.items() if capacity / 2 < s <= capacity - k)
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        best = max(best, over + middle + max(0, -(-(small - space) // capacity)))
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[tuple[Filling, int]]:
    """Bin completion, depth first: the fillings to use and how often.

    A node is left as soon as its waste rules out a packing with fewer sequences than the
    incumbent.  The search ends when the lower bound is met, or after ``steps`` nodes; the
    incumbent is a complete packing at any time, so nothing is left out.
    """
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit_decreasing(counts, capacity)
    bins = sum(n for _, n in best)
    goal, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    # (lengths left, waste, fillings so far as a chain, sequences so far, next filling)
    stack = [(counts, 0, None, 0, None)]
    while stack and bins > goal and steps > 0:
        steps -= 1
        left, waste, chain, used, filling = stack.pop()
        if filling is not None:
            room = capacity - sum(s * n for s, n in filling)
            times = min(left[s] // n for s, n in filling)
            left, waste = _without(left, filling, times), waste + room * times
            chain, used = (filling, times, chain), used + times
        if waste > (bins - 1) * capacity - total:
            continue
        if not left:
            best, bins = _unchained(chain), used
            continue
        allowed = (bins - 1) * capacity - total - waste
        options = fillings(sorted(left), left, capacity)
        stack += [(left, waste, chain, used, f) for room, f in reversed(options) if room <= allowed]
    return best


def _unchained(chain) -> list[tuple[Filling, int]]:
    out = []
    while chain is not None:
        filling, times, chain = chain
        out.append((filling, times))
    return out[::-1]


def _without(left: dict[int, int], option: Filling, times: int) -> dict[int, int]:
    taken = dict(option)
    out = {s: n - taken.get(s, 0) * times for s, n in left.items()}
    return {s: n for s, n in out.items() if n}


@dataclass
class Places:
    """Where the document of some length and rank goes."""

    starts: dict[int, list[int]]
    runs: dict[int, list[tuple[int, int, int]]]  # first sequence, copies in one, offset
    sequences: int

    @classmethod
    def of(cls, fillings_used: list[tuple[Filling, int]]) -> Places:
        starts, runs, given, sequence = defaultdict(list), defaultdict(list), defaultdict(int), 0
        for used, times in fillings_used:
            offset = 0
            for size, copies in used:
                starts[size].append(given[size])
                runs[size].append((sequence, copies, offset))
                given[size] += copies * times
                offset += size * copies
            sequence += times
        return cls(dict(starts), dict(runs), sequence)

    def place(self, size: int, rank: int) -> tuple[int, int]:
        at = bisect_right(self.starts[size], rank) - 1
        sequence, copies, offset = self.runs[size][at]
        within = rank - self.starts[size][at]
        return sequence + within // copies, offset + (within % copies) * size


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` from 0 within each length: a rank in a hash slot plus what earlier slots hold."""
    slots = partitions(rows.sparkSession)
    keyed = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id", "ids_crc32", "start"), F.lit(slots)))
    before = W.partitionBy("length").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    base = keyed.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "slot").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (keyed.withColumn("within", F.row_number().over(inside) - 1)
            .join(base, ["length", "slot"])
            .withColumn("rank", F.col("within") + F.col("base")))


def pack(documents: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and offset."""
    rows = stored(pieces(documents, capacity, with_ids), "pieces")
    histogram = {r[0]: r[1] for r in rows.filter(F.col("length") < capacity)
                 .groupBy("length").agg(F.count(F.lit(1))).collect()}  # at most capacity entries
    places = Places.of(plan(histogram, capacity))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def make():
        def work(sizes, ranks):
            found = [places.place(s, r) for s, r in zip(sizes, ranks)]
            return [longs([x[i] for x in found]) for i in (0, 1)]
        return work

    partial = _ranked(rows.filter(F.col("length") < capacity))
    placed = _with_places(partial, make, names)
    full = rows.filter(F.col("length") == capacity).select(
        *names, (F.monotonically_increasing_id() + places.sequences).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(full)


def _with_places(rows: DataFrame, make, names: list[str]) -> DataFrame:
    @F.pandas_udf("sequence_id bigint, offset bigint")
    def find(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        a, b = make()(sizes.tolist(), ranks.tolist())
        return pd.DataFrame({"sequence_id": a.to_numpy(), "offset": b.to_numpy()})

    return (rows.withColumn("_place", find("length", "rank"))
            .select(*names, F.col("_place.sequence_id").alias("sequence_id"),
                    F.col("_place.offset").alias("offset")))
