"""URL filters by a cascade of Bloom filters over the complete key universe.

Every url yields candidate keys: each suffix of its host with each path prefix whose
length some rule has.  All candidate keys of the corpus form the universe.  Level one of
the cascade holds the listed keys; level two those keys of the universe that level one
lets through wrongly; level three the listed keys that level two lets through wrongly;
and so on until nothing is left.  The number of the first level that rejects a key then
tells exactly, for every key of the universe, whether it is listed: no join is needed,
and the levels grow with the list and not with the corpus.

Defined results
* a null url, or one without ``://``, has empty host and path and matches no rule.
* A-Z are lower-cased in hosts only; ports and user names stay part of the host.
* the longest rule (its text, host and path) wins; a rule that is listed under both
  verdicts counts as block.
* urls without a fitting rule get ``default``; an empty table or rule list works alike.
* repeated rows each appear; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import dropped, longs, map_slices, stored, strings

#: False positives of the first level, and of each later one.
FIRST_RATE, LATER_RATE = 2.0 ** -10, 0.5


@dataclass
class Bloom:
    """A Bloom filter of ``bits`` bits; ``level`` salts its hashes."""

    level: int
    bits: int
    hashes: int
    cells: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, keys: list[str], level: int, rate: float) -> Bloom:
        bits = max(64, math.ceil(len(keys) * -math.log(rate) / math.log(2) ** 2))
        made = cls(level, bits, max(1, round(-math.log2(rate))), np.zeros(-(-bits // 8), np.uint8))
        for key in keys:
            for at in made._places(key):
                made.cells[at >> 3] |= 1 << (at & 7)
        return made

    def _places(self, key: str) -> list[int]:
        digest = xxhash.xxh3_128_intdigest(key.encode(), self.level)
        a, b = digest >> 64, (digest & ((1 << 64) - 1)) | 1
        return [(a + i * b) % self.bits for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        return all(self.cells[at >> 3] >> (at & 7) & 1 for at in self._places(key))


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for number, level in enumerate(self.levels):
            if key not in level:
                return number % 2 == 1
        return len(self.levels) % 2 == 1


def _passing(keys: DataFrame, levels: list[Bloom]) -> DataFrame:
    """Keys that every level lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [k for k in batch.column(0).to_pylist() if all(k in x for x in levels)]
            yield pa.RecordBatch.from_arrays([strings(found)], names=["key"])

    return keys.mapInArrow(run, "key string")


def build_cascade(listed: list[str], universe: DataFrame, first_rate: float = FIRST_RATE) -> Cascade:
    """Levels over ``listed`` keys and a frame of distinct keys in column ``key``.

    The list is given by hand and small.  What the first level lets through wrongly is
    ``first_rate`` of the universe; the rate falls with the size of the universe, so that
    those keys never outnumber the list by more than a few times, and the sum of all
    levels follows the list.
    """
    inside = sorted(set(listed))
    if not inside:
        return Cascade([Bloom.of([], 0, first_rate)])
    size = universe.count()
    rate = min(first_rate, max(len(inside), 64) / max(size, 1))
    levels = [Bloom.of(inside, 0, rate)]
    members = set(inside)
    outside = [r[0] for r in _passing(universe, levels).collect() if r[0] not in members]
    held = inside
    while outside:
        levels.append(Bloom.of(outside, len(levels), LATER_RATE))
        held, outside = outside, [k for k in held if k in levels[-1]]
    return Cascade(levels)


# ------------------------------------------------------------------ urls

def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: str, path: str, lengths: list[int], most: int) -> list[str]:
    """Host suffixes of at most ``most`` labels with path prefixes, longest first."""
    if not host:
        return []
    labels = host.rsplit(".", most)[-most:]
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    keys = [h + path[:n] for h in hosts for n in lengths if len(path) >= n]
    return sorted(keys, key=lambda k: (-len(k), k))


def filter_urls(pages: DataFrame, block: list[tuple[str, str]], allow: list[tuple[str, str]],
                default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row.

    ``block`` and ``allow`` list (host, path prefix) rules; a path starts with ``/``.
    """
    blocked = {h + p for h, p in block}
    allowed = {h + p for h, p in allow} - blocked
    lengths = sorted({len(p) for _, p in (*block, *allow)})
    most = max((h.count(".") + 1 for h, _ in (*block, *allow)), default=1)  # longer suffixes fit no rule
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def keys_of():
        def work(hosts, paths):
            found = [candidate_keys(h, p, lengths, most) for h, p in zip(hosts, paths)]
            return [pa.array(found, pa.list_(pa.string()))]
        return work

    heads = urls.select("host", F.substring("path", 1, max(lengths, default=0)).alias("path"))
    keys = map_slices(heads.distinct(), keys_of, "keys array<string>")
    universe = keys.select(F.explode("keys").alias("key")).distinct()
    universe = stored(universe if lengths else universe.limit(0), "universe")
    blocks, allows = (build_cascade(sorted(x), universe) for x in (blocked, allowed))
    dropped(universe)

    def judge():
        def work(ids, hosts, paths):
            rules, verdicts = [], []
            for h, p in zip(hosts, paths):
                rule, verdict = None, default
                for key in candidate_keys(h, p, lengths, most):
                    if key in blocks:
                        rule, verdict = key, "block"
                    elif key in allows:
                        rule, verdict = key, "allow"
                    else:
                        continue
                    break
                rules.append(rule)
                verdicts.append(verdict)
            return longs(ids), strings(hosts), strings(paths), strings(rules), strings(verdicts)
        return work

    return map_slices(urls, judge, "page_id bigint, host string, path string, rule string, verdict string")
