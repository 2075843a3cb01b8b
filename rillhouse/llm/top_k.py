"""Exact top-k inner-product search in three phases with a uniform threshold.

The components of the vectors are cut into lists of neighbouring components; a score is
the sum of its partial scores over the lists.

1. Every task takes its first tile of candidates and gathers, for each query and list, the k
   best partial scores.  The full scores of these heads are worked out, and the k-th best of
   all tasks is a score that k candidates reach: a safe cutoff.
2. The cutoff t of each query is broadcast.  A candidate that reaches t has a partial score of
   at least t / lists in some list, so each list collects its entries from that uniform
   threshold on; nothing else can be among the best k.  A list is read only for candidates
   whose part is long enough to reach the threshold at all (Cauchy-Schwarz).
3. The partial scores that the collected entries miss are worked out exactly, entries below t
   leave, and the rest are ranked.

Queries are a stated share of the rows.  They are read in blocks of bounded size and
broadcast to the candidates, which stay where they are stored and are never shuffled.  A task
returns the best few per query, whatever it reads.

Defined results
* components become floor(256 * x), x as double; vectors that are null or hold a null or
  non-finite component take no part; finite ones of any size do.
* shorter vectors are padded with zeros; an empty vector is all zeros.
* scores are compared exactly; those beyond 64 bits are returned as the ends of that range.
* candidates are all rows but the query's own; a repeated ``vec_id`` is told apart by the
  row, so copies of a query's row are candidates, and each repeated query row is one
  query.  A null ``vec_id`` is a candidate that loses ties, never a query.
* fewer than k candidates: all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import stored
from rillhouse.llm.vectors import (
    FOUND, TILE_QUERIES, Best, clipped, first_columns, found_rows, padded, query_block, query_blocks,
    ranked, tiles, usable,
)

#: Lists that the components are cut into.
LISTS = 4


def product(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while they are exact, else in wider integers."""
    if not queries.shape[1] or not len(queries) or not len(candidates):
        return np.zeros((len(queries), len(candidates)), np.int64)
    top = int(abs(queries).max()) * int(abs(candidates).max()) * queries.shape[1]
    if top < 2 ** 52:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    if top < 2 ** 62:
        return queries @ candidates.T
    return queries.astype(object) @ candidates.T.astype(object)


class _Lists:
    """Queries and candidates cut into lists of components of one width."""

    def __init__(self, queries: np.ndarray, candidates: np.ndarray):
        width = max(queries.shape[1], candidates.shape[1])
        q, c = padded(queries, width), padded(candidates, width)
        cuts = np.linspace(0, width, LISTS + 1).astype(int)
        self.parts = [(q[:, a:b], c[:, a:b]) for a, b in zip(cuts, cuts[1:])]

    def partial(self, number: int, columns: np.ndarray | None = None) -> np.ndarray:
        q, c = self.parts[number]
        return product(q, c if columns is None else c[columns])

    def exact(self, number: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Partial scores of single entries."""
        q, c = self.parts[number]
        wide = q.dtype == object or c.dtype == object or (
            q.size and c.size and int(abs(q).max()) * int(abs(c).max()) * q.shape[1] >= 2 ** 62)
        a, b = (q[rows].astype(object), c[columns].astype(object)) if wide else (q[rows], c[columns])
        return (a * b).sum(axis=1) if q.shape[1] else np.zeros(len(rows), np.int64)

    def lengths(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            return tuple(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in self.parts[number])


def _heads(queries, k: int):
    """Phase 1: the best of the heads of the first tile's lists."""
    def run(batches):
        rids, parts = queries.value
        best = Best(k)
        for tile in tiles(batches):
            for at in range(0, len(rids), TILE_QUERIES):
                own = rids[at:at + TILE_QUERIES]
                lists = _Lists(parts[at:at + TILE_QUERIES], tile.parts)
                valid = own[:, None] != tile.rid
                heads = {pair for number in range(LISTS)
                         for pair in zip(*(x.tolist() for x in first_columns(lists.partial(number), valid, k)))}
                if not heads:
                    continue
                rows, cols = (np.array(x) for x in zip(*sorted(heads)))
                scores = sum(lists.exact(number, rows, cols) for number in range(LISTS))
                for row, col, score in zip(rows.tolist(), cols.tolist(), scores.tolist()):
                    best.add((int(own[row]), 0), score, bool(tile.unnamed[col]), int(tile.ids[col]), int(tile.rid[col]))
            break
        yield found_rows(best)
    return run


def collected(lists: _Lists, cuts: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3 for one tile: rows, columns and exact scores of the entries that reach the
    cutoffs (None: everything does)."""
    n, m = len(lists.parts[0][0]), len(lists.parts[0][1])
    # a sum of at least t has a part of at least t / LISTS, rounded up as parts are whole
    share = [None if t is None else -(-t // LISTS) for t in cuts]
    least = min((s for s in share if s is not None), default=None)
    every = np.array([s is None for s in share])
    kind = object if any(s is not None and abs(s) >= 2 ** 62 for s in share) else np.int64
    bound = np.array([0 if s is None else s for s in share], kind)[:, None]
    chosen = np.broadcast_to(every[:, None], (n, m)).copy()
    partials: list[tuple[np.ndarray, np.ndarray | None]] = []
    for number in range(LISTS):
        q_length, c_length = lists.lengths(number)
        if every.any() or least is None or least <= 0:
            reach = np.ones(m, bool)
        else:
            reach = ~(q_length.max(initial=0) * c_length < float(least) * (1 - 1e-9))
        columns = np.flatnonzero(reach)
        scores = lists.partial(number, columns)
        chosen[:, columns] |= (scores >= bound) & ~every[:, None]
        place = np.full(m, -1)
        place[columns] = np.arange(len(columns))
        partials.append((place, scores))
    rows, cols = np.nonzero(chosen)
    total = np.zeros(len(rows), np.int64)
    if any(scores.dtype == object for _, scores in partials):
        total = total.astype(object)
    for number, (place, scores) in enumerate(partials):
        known = place[cols] >= 0
        part = np.zeros(len(rows), total.dtype)
        part[known] = scores[rows[known], place[cols[known]]]
        missing = np.flatnonzero(~known)
        if len(missing):
            part[missing] = lists.exact(number, rows[missing], cols[missing])
        total = total + part
    whole = np.array([0 if t is None else t for t in cuts], kind)
    enough = every[rows] | (total >= whole[rows])
    return rows[enough], cols[enough], total[enough]


def _entries(queries, cutoffs, k: int):
    """Phases 2 and 3 over all tiles of a task."""
    def run(batches):
        rids, parts = queries.value
        cuts = [cutoffs.value.get(rid) for rid in rids.tolist()]
        best = Best(k)
        for tile in tiles(batches):
            for at in range(0, len(rids), TILE_QUERIES):
                own = rids[at:at + TILE_QUERIES]
                rows, cols, scores = collected(_Lists(parts[at:at + TILE_QUERIES], tile.parts), cuts[at:at + TILE_QUERIES])
                other = own[rows] != tile.rid[cols]
                for row, col, score in zip(rows[other].tolist(), cols[other].tolist(), scores[other].tolist()):
                    best.add((int(own[row]), 0), score, bool(tile.unnamed[col]), int(tile.ids[col]), int(tile.rid[col]))
        yield found_rows(best)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    ``vectors`` has ``vec_id`` and the array ``embedding``; ``is_query`` marks queries.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, is_query), "vectors")
    candidates = rows.select("rid", "vec_id", "embedding")
    asked = stored(rows.filter("asks").drop("asks"), "queries")
    blocks = query_blocks(asked)
    results = None
    for number in range(blocks):
        block = query_block(asked, number, blocks)
        if block is None:
            continue
        queries = spark.sparkContext.broadcast(block)
        heads = ranked(candidates.mapInArrow(_heads(queries, k), FOUND), k).filter(F.col("rank") == k)
        cutoffs = spark.sparkContext.broadcast(
            {r["query"]: int(r["score"]) for r in heads.select("query", "score").collect()})
        found = stored(ranked(candidates.mapInArrow(_entries(queries, cutoffs, k), FOUND), k), "entries")
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    named = asked.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return results.join(named, "query").select("query_id", "rank", "vec_id", clipped(F.col("score")).alias("score"))
