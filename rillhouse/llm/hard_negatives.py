"""Hard negatives by exact inner products, several candidates to a multiplication.

Components are whole numbers.  Candidates' components are biased to be no less than zero and
several candidates are packed into separated fields of one wide integer per component
(Kronecker substitution); the field is as wide as the largest possible score of biased
vectors.  An anchor, biased too, multiplies each wide integer once per component; the fields
of the sum are the biased scores, from which the biases are taken out exactly.  Wide integers
are the 53 bits that a double holds exactly, as long as two fields fit; larger components
use Python's integers, of any width.

Anchors are a stated share of the rows.  They are read in blocks of bounded size, and each
block is broadcast to the candidates, which stay where they are stored and are never
shuffled.  A first pass finds each anchor's positives, a second one the negatives in the
score range of each positive.  A task keeps only the best few per anchor, whatever it reads;
no group of a label is ever collected.

Defined results
* rows with a null label, a null vector, or a null or non-finite component take no part.
* components become floor(256 * x), x as double; shorter vectors are padded with zeros.
* scores are compared exactly, however large; those beyond 64 bits are returned as the ends
  of that range.
* rows are told apart by the row, so copies of an anchor's row are other rows, and each
  repeated anchor row is an anchor of its own.  A null ``vec_id`` is no anchor and loses ties.
* no positives or no negatives in range: no rows; an empty table gives an empty result; other
  columns are not read.
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

#: Candidates packed into one of Python's wide integers.
WIDE_FIELDS = 16
#: Bits that a double holds exactly.
EXACT_BITS = 53


# ------------------------------------------------------------------ exact products

def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows with all rows by packed multiplications."""
    width = max(anchors.shape[1], candidates.shape[1])
    a, c = padded(anchors, width), padded(candidates, width)
    if not width or not len(a) or not len(c):
        return np.zeros((len(a), len(c)), np.int64)
    # Python integers, as biased values of 64 bits may need one more
    a_bias, c_bias = max(0, -int(a.min())), max(0, -int(c.min()))
    a_top, c_top = int(a.max()) + a_bias, int(c.max()) + c_bias
    bits = max(1, (a_top * c_top * width).bit_length())
    fields = EXACT_BITS // bits
    exact = fields >= 2 and (a_top + a_bias) * (c_top + c_bias) * width < 2 ** 62
    if not exact:
        fields = WIDE_FIELDS
        a, c = a.astype(object), c.astype(object)
    a, c = a + a_bias, c + c_bias
    packs = -(-len(c) // fields)
    wide = np.zeros((width, packs), c.dtype)
    for field in range(fields):
        part = c[field * packs:(field + 1) * packs].T
        wide[:, :part.shape[1]] += part << (bits * field)
    if exact:
        sums = (a.astype(np.float64) @ wide.astype(np.float64)).astype(np.int64)
    else:
        sums = a @ wide
    mask = (1 << bits) - 1
    biased = np.concatenate([(sums >> (bits * field)) & mask for field in range(fields)], axis=1)[:, :len(c)]
    # (a + A)(c + C) = ac + C * sum(a + A) + A * sum(c + C) - width * A * C
    return biased - c_bias * a.sum(axis=1)[:, None] - a_bias * c.sum(axis=1)[None, :] + width * a_bias * c_bias


def _positives(anchors, k: int):
    """The k best other rows of an anchor's label."""
    def run(batches):
        rids, labels, parts = anchors.value
        best = Best(k)
        for tile in tiles(batches):
            for at in range(0, len(rids), TILE_QUERIES):
                part = slice(at, at + TILE_QUERIES)
                scores = products(parts[part], tile.parts)
                valid = (labels[part, None] == tile.label) & (rids[part, None] != tile.rid)
                for row, col in zip(*(x.tolist() for x in first_columns(scores, valid, k))):
                    best.add((int(rids[at + row]), 0), int(scores[row, col]), bool(tile.unnamed[col]),
                             int(tile.ids[col]), int(tile.rid[col]))
        yield found_rows(best)
    return run


def _negatives(anchors, limits, k: int, share: tuple[int, int]):
    """The k best rows of other labels in the range below each positive's score."""
    numerator, denominator = share

    def run(batches):
        rids, labels, parts = anchors.value
        tops = [limits.value.get(rid, []) for rid in rids.tolist()]
        best = Best(k)
        for tile in tiles(batches):
            for at in range(0, len(rids), TILE_QUERIES):
                part = slice(at, at + TILE_QUERIES)
                scores = products(parts[part], tile.parts)
                other = labels[part, None] != tile.label
                for number in range(max((len(t) for t in tops[part]), default=0)):
                    rows = [i for i, t in enumerate(tops[part]) if number < len(t)]
                    top = [tops[at + i][number] for i in rows]
                    least = [-(-numerator * t // denominator) for t in top]
                    kind = np.int64 if max(map(abs, (*top, *least))) < 2 ** 62 else object
                    some = scores[rows]
                    valid = (other[rows] & (some <= np.array(top, kind)[:, None])
                             & (some >= np.array(least, kind)[:, None]))
                    for row, col in zip(*(x.tolist() for x in first_columns(some, valid, k))):
                        best.add((int(rids[at + rows[row]]), number), int(some[row, col]),
                                 bool(tile.unnamed[col]), int(tile.ids[col]), int(tile.rid[col]))
        yield found_rows(best)
    return run


# ------------------------------------------------------------------ the operator

def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None,
                   positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has ``vec_id``, ``label`` and the array ``embedding``; ``is_anchor`` marks the
    anchors, ``label`` may replace the label.  A negative scores at most what the positive
    scores, and at least ``share`` (a fraction as two numbers) of it.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, is_anchor, F.col("label") if label is None else label), "candidates")
    candidates = rows.select("rid", "vec_id", "label", "embedding")
    asked = stored(rows.filter("asks").drop("asks"), "anchors")
    blocks = query_blocks(asked)
    results = None
    for number in range(blocks):
        block = query_block(asked, number, blocks, "label")
        if block is None:
            continue
        anchors = spark.sparkContext.broadcast(block)
        near = stored(ranked(candidates.mapInArrow(_positives(anchors, positives), FOUND), positives), "positives")
        tops: dict[int, list[int]] = {}
        for row in near.select("query", "rank", "score").orderBy("query", "rank").collect():
            tops.setdefault(row["query"], []).append(int(row["score"]))
        limits = spark.sparkContext.broadcast(tops)
        far = ranked(candidates.mapInArrow(_negatives(anchors, limits, negatives, share), FOUND), negatives)
        pairs = near.select("query", (F.col("rank") - 1).alias("part"),
                            F.col("vec_id").alias("positive_id"), clipped(F.col("score")).alias("positive_score"))
        found = stored(far.select("query", "part", "rank", F.col("vec_id").alias("negative_id"),
                                  clipped(F.col("score")).alias("negative_score"))
                       .join(pairs, ["query", "part"]), "negatives")
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, "
                                         "negative_id bigint, positive_score bigint, negative_score bigint")
    named = asked.select(F.col("rid").alias("query"), F.col("vec_id").alias("anchor_id"))
    return results.join(named, "query").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
