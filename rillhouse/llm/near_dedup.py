"""Near-dedup of the pipeline: documents whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more are linked, and one of each group of linked documents stays.

Candidates come from the SimHash of each set, by the byte-position index and its tally
(``simhash.links``).  A similarity of 0.8 moves a 64-bit SimHash by about ten bits, and then no
byte of it has to be equal: the index finds the pairs of up to three bits, not these.  The rest
therefore comes from ``BANDS`` further fingerprints, each made of ``ROWS`` minima of the set
under different orders.  Two sets of similarity s share one with probability s ** ROWS, so a
pair at 0.8 shares about 15 of 30, and fewer than ``MATCHES`` with probability 2e-7.  Every
link is verified by the exact similarity of the two sets of 64-bit shingle hashes.

1. One pass over the texts: a node is a set of shingles (its digest); equal sets are one.
2. Nodes whose SimHashes the index links, and members of each list of the other fingerprints
   with its smallest member, are pairs; they are verified and closed to components.  A large
   group of copies ends here, with few pairs each.
3. Lists that still hold more than one component are tried across components.  A list is
   dealt to tiles of bounded size; inside a tile the shared fingerprints of each pair are
   tallied, and only pairs with ``MATCHES`` or more of them, whose sizes allow the similarity,
   count, each in the first list that it shares.  The nodes of such pairs get their sets; the
   tile verifies its pairs with them and gives only the links that connect something new,
   fewer than its nodes.  Documents that share a boilerplate, and so one fingerprint, never
   become pairs.

Texts are shuffled only to get the sets of nodes that are in a pair.

Defined results
* words are split at ASCII white space and compared without ASCII case; a text of fewer
  than five words is one shingle; null text counts as empty.
* the document with the smallest id of a group stays, with all its columns; rows of one id
  count as one document, so an id stays if any of its rows is the smallest of its group.
* a null ``doc_id`` stays only where its whole group has null ids.
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import dropped, longs, map_slices, partitions, stored
from rillhouse.llm.components import components
from rillhouse.llm.simhash import links, majority, shingle_hashes, votes_of, word_blocks
from rillhouse.llm.suffix_dedup import keyed

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS, MATCHES = 30, 3, 3
#: Shingles whose minima are taken at once; nodes of a list in a tile, and their shingles, on
#: average; pairs tallied at once.
BLOCK, TILE, TILE_SHINGLES, TALLIED = 1 << 12, 2048, 1 << 21, 1 << 20

_RNG = np.random.default_rng(20)
_ORDERS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


# ------------------------------------------------------------------ sets and fingerprints

def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text."""
    found: list[np.ndarray] = []
    carry: list[bytes] = []
    for words in word_blocks(text.encode().lower()):
        words = carry + words
        if len(words) >= WIDTH:
            found.append(np.unique(np.array(shingle_hashes(words, WIDTH), np.uint64)))
            carry = words[len(words) - WIDTH + 1:]
        else:
            carry = words
    return np.unique(np.concatenate(found)) if found else np.array(shingle_hashes(carry, WIDTH), np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def bands(members: np.ndarray) -> np.ndarray:
    """The independent fingerprints of a set, 32 bits each."""
    least = np.full(len(_ORDERS), np.uint64(2 ** 64 - 1))
    for at in range(0, len(members), BLOCK):
        some = members[at:at + BLOCK]
        turned = (some ^ _SALTS[:, None]) * _ORDERS[:, None]
        turned ^= turned >> np.uint64(32)
        turned *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, turned.min(axis=1), out=least)
    key = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return (key >> np.uint64(32)).astype(np.uint32)


def _sketches(rows: DataFrame) -> DataFrame:
    """k1, k2, doc_id, node, size, SimHash and other fingerprints of every row."""
    def make():
        def work(k1, k2, ids, texts):
            nodes, sizes, prints, keys = [], [], [], []
            for text in texts:
                members = shingles(text)
                nodes.append(xxhash.xxh64_intdigest(members.tobytes(), 7))
                sizes.append(len(members))
                prints.append(majority(votes_of(members), len(members)))
                keys.append(bands(members).tobytes())
            nodes, prints = (longs(np.array(x, np.uint64).view(np.int64)) for x in (nodes, prints))
            return longs(k1), longs(k2), longs(ids), nodes, longs(sizes), prints, pa.array(keys, pa.binary())
        return work

    return map_slices(rows.select("k1", "k2", "doc_id", "text"), make,
                      "k1 bigint, k2 bigint, doc_id bigint, node bigint, size bigint, fp bigint, bands binary")


# ------------------------------------------------------------------ candidates

_LIST = ["list", "node", "size"]


def _entries(sketches: DataFrame) -> DataFrame:
    """(list, node, size): a row for each fingerprint of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(BANDS, dtype=np.int64) << 32
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.uint32)
                lists = (keys.reshape(-1, BANDS).astype(np.int64) | place).ravel()
                node, size = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("node", "size"))
                yield pa.RecordBatch.from_arrays([longs(lists), longs(node), longs(size)], names=_LIST)

    return sketches.select("node", "size", "bands").mapInArrow(run, "list bigint, node bigint, size bigint")


def _stars(entries: DataFrame) -> DataFrame:
    """Lists of two nodes or more, each entry with the list's smallest node."""
    names = [*_LIST, "first", "first_size"]
    dealt = (entries.repartition(partitions(entries.sparkSession), "list")
             .sortWithinPartitions("list", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # list, its first node and size, and the node before
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, nodes, sizes = (c.to_numpy() for c in batch.columns)
            n = len(lists)
            starts = np.concatenate([[True], lists[1:] != lists[:-1]])
            before = np.concatenate([[0], nodes[:-1]])
            first = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
            first_node, first_size = nodes[first], sizes[first]
            if last and last[0] == lists[0]:
                same = first == 0
                first_node, first_size = (np.where(same, x, y) for x, y in ((last[1], first_node), (last[2], first_size)))
                starts[0], before[0] = False, last[3]
            fresh = ~starts & (nodes != before)  # the smallest node itself is not an entry
            yield pa.RecordBatch.from_arrays(
                [longs(x[fresh]) for x in (lists, nodes, sizes, first_node, first_size)], names=names)
            last = lists[-1], first_node[-1], first_size[-1], nodes[-1]

    return dealt.mapInArrow(run, "list bigint, node bigint, size bigint, first bigint, first_size bigint")


def _able(a, b):
    """Sets of these sizes can reach the similarity."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(SIMILARITY) - F.lit(1e-6)


def _near_prints(sketches: DataFrame) -> DataFrame:
    """Pairs (hi, lo) of nodes whose SimHashes the byte-position index links: nodes of one SimHash
    with the smallest of them, and the smallest ones of two linked SimHashes."""
    least = sketches.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("x"))
    least = stored(least.select("fp", F.col("x.node").alias("other"), F.col("x.size").alias("other_size")), "prints")
    equal = sketches.select("fp", "node", "size").join(least, "fp")
    near = (links(least.select("fp")).join(least.select(
        F.col("fp").alias("hi"), F.col("other").alias("node"), F.col("other_size").alias("size")), "hi")
            .join(least.withColumnRenamed("fp", "lo"), "lo"))
    columns = ["node", "size", "other", "other_size"]
    pairs = equal.select(*columns).unionByName(near.select(*columns)).filter("node <> other")
    pairs = pairs.filter(_able(F.col("size"), F.col("other_size")))
    found = stored(pairs.select(F.greatest("node", "other").alias("hi"), F.least("node", "other").alias("lo")).distinct(),
                   "near-prints")
    dropped(least)
    return found


def _tallied(band: int, own: tuple, other: tuple | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (in ``own``, in ``other`` or in ``own`` before) of different components
    that share enough fingerprints, none of them before ``band``.  A side is (node, size,
    root, fingerprints)."""
    node, size, root, keys = own
    with_self = other is None
    node2, size2, root2, keys2 = own if with_self else other
    step = max(1, TALLIED // max(len(node2), 1))
    for at in range(0, len(node), step):
        some = slice(at, at + step)
        shared = np.zeros((len(node[some]), len(node2)), np.uint8)
        fresh = np.ones(shared.shape, bool)
        for i in range(BANDS):
            equal = keys[some, i][:, None] == keys2[:, i]
            shared += equal
            if i < band:
                fresh &= ~equal
        low, high = np.minimum(size[some, None], size2), np.maximum(size[some, None], size2)
        fresh &= (shared >= MATCHES) & (root[some, None] != root2) & (low >= high * SIMILARITY - 1e-6)
        if with_self:
            fresh &= (np.arange(at, at + len(shared))[:, None] > np.arange(len(node2)))
        a, b = np.nonzero(fresh)
        yield a + at, b


def _compared(key: tuple, columns: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the tile ``key`` (list, x, y) that ``_tallied`` finds; columns are tile,
    node, size, root and fingerprints, sorted by tile."""
    tile, *side = columns
    with_self = key[1] == key[2]
    cut = len(tile) if with_self else int(np.searchsorted(tile, key[1], "right"))
    if not cut or (not with_self and cut == len(tile)):
        return
    # a pair across components has a node outside the largest one
    roots, counts = np.unique(side[2], return_counts=True)
    inside = side[2] == roots[counts.argmax()]
    out, held_in, other_out, other_in = (
        at + np.flatnonzero(chosen[at:end]) for at, end in ((0, cut), (cut, len(tile))) for chosen in (~inside, inside))
    for own, other in [(out, None), (out, held_in)] if with_self else [
            (out, other_out), (out, other_in), (held_in, other_out)]:
        second = own if other is None else other
        for x, y in _tallied(key[0] >> 32, tuple(c[own] for c in side),
                             None if other is None else tuple(c[other] for c in side)):
            yield own[x], second[y]


_TILE = ["list", "x", "y", "tile", "node", "size", "root", "bands"]
_TILE_TYPES = ", ".join(f"{n} bigint" for n in _TILE[:-1]) + ", bands binary"


def _by_tile(rows: DataFrame, work: Callable[[tuple, list], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work(key, columns)`` for every tile (list, x, y); columns are those after the key, the
    fingerprints as a matrix, binary ones behind them as lists of bytes."""
    names = rows.columns[3:]
    dealt = (rows.repartition(partitions(rows.sparkSession), "list", "x", "y")
             .sortWithinPartitions("list", "x", "y", "tile", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        key = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [sum(c, []) if isinstance(c[0], list) else np.concatenate(c) for c in zip(*held)]
                held.clear()
                if (made := work(key, columns)) is not None:
                    yield made

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("list", "x", "y")])
            columns = []
            for name in names:
                if name == "bands":
                    columns.append(np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(-1, BANDS))
                elif name == "members":
                    columns.append(batch.column(name).to_pylist())
                else:
                    columns.append(batch.column(name).to_numpy())
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(bounds, bounds[1:]):
                now = tuple(keys[a].tolist())
                if now != key:
                    yield from flush()
                    key = now
                held.append([c[a:b] for c in columns])
        yield from flush()

    return dealt.mapInArrow(run, schema)


def _tiled(lists: DataFrame) -> DataFrame:
    """Nodes of one list dealt to pairs of tiles (x, y).  ``lists`` has list, n (its nodes),
    shingles (of all of them), node, size, root and bands."""
    tiles = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES))
    tile = F.pmod(F.xxhash64("node"), tiles)
    each = lists.withColumn("tile", tile).withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1)))
    return each.select("list", F.least("tile", "with").alias("x"), F.greatest("tile", "with").alias("y"),
                       "tile", "node", "size", "root", "bands")


def _paired(tiled: DataFrame) -> DataFrame:
    """The rows of each tile that are in a pair there: no more than it holds."""
    def work(key: tuple, columns: list) -> pa.RecordBatch | None:
        used = np.zeros(len(columns[0]), bool)
        for x, y in _compared(key, columns):
            used[x] = used[y] = True
        at = np.flatnonzero(used)
        if not len(at):
            return None
        return pa.RecordBatch.from_arrays(
            [longs(np.full(len(at), k)) for k in key] + [longs(c[at]) for c in columns[:-1]]
            + [pa.array([columns[-1][i].tobytes() for i in at], pa.binary())], names=_TILE)

    return _by_tile(tiled, work, _TILE_TYPES)


def _across(lists: DataFrame, sketches: DataFrame, rows: DataFrame) -> DataFrame:
    """Verified links (hi, lo) across components, as the module says: a spanning forest of those
    that a tile finds, so fewer than its nodes."""
    paired = stored(_paired(_tiled(lists)), "paired")
    sets = _sets(paired.select("node").distinct(), sketches, rows)

    def work(key: tuple, columns: list) -> pa.RecordBatch | None:
        *columns, members = columns
        above: dict[int, int] = {}
        links: list[tuple[int, int]] = []

        def top(root: int) -> int:
            while root in above:
                if above[root] in above:
                    above[root] = above[above[root]]
                root = above[root]
            return root

        nodes, roots = columns[1], columns[3].tolist()
        for xs, ys in _compared(key, columns):
            for x, y in zip(xs.tolist(), ys.tolist()):
                one, two = top(roots[x]), top(roots[y])
                if one != two and _alike(np.frombuffer(members[x], np.uint64), np.frombuffer(members[y], np.uint64)):
                    above[one] = two
                    links.append((int(nodes[x]), int(nodes[y])))
        return pa.RecordBatch.from_arrays(
            [longs([max(k) for k in links]), longs([min(k) for k in links])], names=["hi", "lo"]) if links else None

    found = stored(_by_tile(paired.join(sets.dropDuplicates(["node"]), "node").select(*_TILE, "members"), work, "hi bigint, lo bigint").distinct(),
                   "across")
    dropped(sets)
    dropped(paired)
    return found


# ------------------------------------------------------------------ verification

def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Do two sets have the similarity?"""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= SIMILARITY * (len(a) + len(b) - shared) - 1e-6


def _sets(wanted: DataFrame, sketches: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, members) of the nodes in ``wanted``; repeated rows give their set more than once."""
    holders = sketches.join(wanted, "node").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k"))
    holders = holders.select("node", "k.k1", "k.k2")

    def make():
        def work(nodes, texts):
            return longs(nodes), pa.array([shingles(t).tobytes() for t in texts], pa.binary())
        return work

    texts = rows.join(holders, ["k1", "k2"]).select("node", "text")
    return stored(map_slices(texts, make, "node bigint, members binary"), "sets")


def _verified(pairs: DataFrame, sketches: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (hi, lo) whose sets have the similarity."""
    pairs = stored(pairs.distinct(), "candidates")
    wanted = pairs.select(F.col("hi").alias("node")).union(pairs.select(F.col("lo").alias("node"))).distinct()
    sets = _sets(wanted, sketches, rows)
    both = (pairs.join(sets.select(F.col("node").alias("lo"), F.col("members").alias("a")), "lo")
            .join(sets.select(F.col("node").alias("hi"), F.col("members").alias("b")), "hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                if _alike(a, b):
                    keep.append(i)
            yield batch.select(["hi", "lo"]).take(pa.array(keep, pa.int64()))

    found = stored(both.select("hi", "lo", "a", "b").mapInArrow(run, "hi bigint, lo bigint").distinct(), "verified")
    dropped(sets)
    dropped(pairs)
    return found


# ------------------------------------------------------------------ the operator

def near_copies(documents: DataFrame) -> DataFrame:
    """doc_id, component_id for every row; component_id is the smallest id reachable."""
    rows = keyed(documents)
    sketches = stored(_sketches(rows), "sketches")
    lists = stored(_stars(_entries(sketches)), "lists")
    stars = lists.filter(_able(F.col("size"), F.col("first_size"))).select(
        F.col("node").alias("hi"), F.col("first").alias("lo"))
    near = _near_prints(sketches)
    first = _verified(near.unionByName(stars), sketches, rows)
    dropped(near)

    roots = components(first)
    whole = lists.select(*_LIST).unionByName(lists.select(
        "list", F.col("first").alias("node"), F.col("first_size").alias("size")).distinct())
    named = whole.join(roots, "node", "left").select(*_LIST, F.coalesce("root", "node").alias("root"))
    open_ = named.groupBy("list").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("shingles")).filter("a <> b").select("list", "n", "shingles")
    prints = sketches.groupBy("node").agg(F.first("bands").alias("bands"))
    second = _across(named.join(open_, "list").join(prints, "node"), sketches, rows)
    dropped(lists)

    roots = components(first.unionByName(second))
    nodes = sketches.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(of_root, "root").select("node", "component_id")
    found = stored(sketches.join(classes, "node").select("doc_id", "component_id"), "near-copies")
    dropped(sketches)
    return found


def one_of_each(documents: DataFrame) -> DataFrame:
    """The document with the smallest id of each group, with all its columns."""
    found = near_copies(documents)
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_keep_doc")).distinct())
    return documents.join(kept, documents["doc_id"].eqNullSafe(kept["_keep_doc"]), "left_semi")
