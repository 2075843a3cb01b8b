"""Helpers of the operators on vectors: whole-number components, the best few of a row of
scores, and what a task has found.

Scores are compared exactly, however large, and travel as text of whole numbers; the best of
a task are few.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Candidates and queries handled at once.
TILE_ROWS, TILE_QUERIES = 1024, 512
#: Components in a broadcast block of queries, on average (8 bytes each); a query counts as so
#: many more, for what is found for it.
BLOCK_COMPONENTS, QUERY_COST = 1 << 20, 16

_HIGH, _LOW = 2 ** 63 - 1, -(2 ** 63)


def quantised(vectors: pa.ListArray) -> np.ndarray:
    """floor(256 * x) of each component, one row per vector: int64, or Python integers where
    those are too small."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    small = np.abs(flat).max(initial=0) < 2.0 ** 44
    if small:
        values = np.floor(flat * 256).astype(np.int64)
    else:
        values = np.array([math.floor(x * 256) if abs(x) < 2.0 ** 44 else int(x) * 256
                           for x in flat.tolist()], object)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def padded(values: np.ndarray, width: int) -> np.ndarray:
    if values.shape[1] == width:
        return values
    out = np.zeros((len(values), width), values.dtype)
    out[:, :values.shape[1]] = values
    return out


def first_columns(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest valid scores of each row; ties go to smaller columns."""
    n = scores.shape[1]
    if scores.dtype == object or int(np.abs(scores).max(initial=0)) >= 2 ** 62 // max(n, 1):
        found = [(row, col) for row in range(len(scores)) for col in heapq.nsmallest(
            k, np.flatnonzero(valid[row]).tolist(), key=lambda c, row=row: (-scores[row, c], c))]
        return (np.array([r for r, _ in found], np.int64), np.array([c for _, c in found], np.int64))
    keys = np.where(valid, scores * n + (n - 1 - np.arange(n)), _LOW)
    if n > k:
        cols = np.argpartition(keys, n - k, axis=1)[:, n - k:]
    else:
        cols = np.broadcast_to(np.arange(n), keys.shape)
    keep = np.take_along_axis(valid, cols, 1)
    rows = np.broadcast_to(np.arange(len(scores))[:, None], cols.shape)
    return rows[keep], cols[keep]


class Best:
    """The best few of each key, over everything that a task has read."""

    def __init__(self, k: int):
        self.k, self.kept = k, {}

    def add(self, key, score: int, unnamed: bool, vec_id: int, rid: int) -> None:
        heap = self.kept.setdefault(key, [])
        entry = (score, not unnamed, -vec_id, -rid)  # the least of a heap is the worst
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)

    def rows(self):
        for key, heap in self.kept.items():
            for score, named, vec_id, rid in heap:
                yield key, score, not named, -vec_id, -rid


class Tile:
    """Candidates of a batch in the order in which ties are broken."""

    def __init__(self, batch: pa.RecordBatch):
        rid, ids = (batch.column(n) for n in ("rid", "vec_id"))
        unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        rid = rid.to_numpy()
        order = np.lexsort((rid, ids, unnamed))
        self.rid, self.ids, self.unnamed = rid[order], ids[order], unnamed[order]
        labels = [batch.column(n).to_numpy()[order] for n in batch.schema.names if n == "label"]
        self.label = labels[0] if labels else None
        self.parts = quantised(batch.column("embedding"))[order]


def tiles(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, TILE_ROWS):
            yield Tile(batch.slice(at, TILE_ROWS))


#: What tasks return: ``query`` is the row number of the asking vector, ``part`` tells several
#: questions of it apart.
FOUND = "query bigint, part int, score string, unnamed boolean, vec_id bigint, rid bigint"


def found_rows(best: Best) -> pa.RecordBatch:
    rows = [(key[0], key[1], str(score), unnamed, None if unnamed else vec_id, rid)
            for key, score, unnamed, vec_id, rid in best.rows()]
    types = [pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, types)],
        names=[x.split()[0] for x in FOUND.split(", ")])


def query_blocks(asked: DataFrame) -> int:
    """How many blocks the asking rows are dealt to."""
    total = asked.agg(F.sum(F.size("embedding") + QUERY_COST)).first()[0] or 0
    return max(1, -(-total // BLOCK_COMPONENTS))


def query_block(asked: DataFrame, number: int, blocks: int, *names: str) -> tuple | None:
    """The rows of one block as arrays: rid, the columns ``names``, and components."""
    rows = asked.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == number).select("rid", *names, "embedding")
    table = rows.toArrow().combine_chunks()
    if not table.num_rows:
        return None
    batch = table.to_batches()[0]
    return (*(batch.column(n).to_numpy() for n in ("rid", *names)), quantised(batch.column("embedding")))


def usable(vectors: DataFrame, is_query: Column, label: Column | None = None) -> DataFrame:
    """Rows that take part: rid (a row number), vec_id, label if one is given, embedding and
    whether the row asks."""
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    vector = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    labels = [] if label is None else [label.cast("bigint").alias("label")]
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), *labels, vector.alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("rid"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    return rows if label is None else rows.filter(F.col("label").isNotNull())


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each question, from the best of all tasks; scores of more
    than 38 digits are ordered by sign, length and digits."""
    negative = F.col("score").startswith("-")
    digits = F.length("score")
    order = W.partitionBy("query", "part").orderBy(
        negative, F.when(negative, -digits).otherwise(digits).desc(),
        F.when(~negative, F.col("score")).desc(), F.when(negative, F.col("score")).asc(),
        "unnamed", "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def clipped(score: Column) -> Column:
    return F.coalesce(score.try_cast("bigint"),
                      F.when(score.startswith("-"), F.lit(_LOW)).otherwise(F.lit(_HIGH)))
