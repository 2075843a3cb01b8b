"""From a table's snapshot to its changes without a gap and without going back.

A snapshot is read chunk by chunk while changes go on.  For every chunk the position of the
change log is noted before (``low``) and after (``high``) reading it.  A row of the chunk
shows its key somewhere in between, so it loses against the newest change of that key
inside the chunk's window, and changes up to ``high`` are part of the chunk.  Every key
starts with its state as of its chunk's ``high``, and goes on with the changes behind it.
All chunks are stitched at once, by equi-joins on the key and on the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETE = "d"


def stitched(snapshot: DataFrame, chunks: DataFrame, changes: DataFrame, chunk_of: Column) -> DataFrame:
    """``key, op, position, value`` of the whole history from the snapshot on.

    ``snapshot`` has ``key, value``; ``chunks`` has ``chunk, low, high``; ``changes`` has
    ``key, op, position, value``, where a delete has the op ``d``.  ``chunk_of`` gives the
    chunk of ``key``.  A key that changes but has no chunk was added behind all of them: its
    changes are passed on as they are.
    """
    dealt = changes.withColumn("chunk", chunk_of).join(chunks, "chunk", "left")
    in_window = dealt.filter((F.col("position") > F.col("low")) & (F.col("position") <= F.col("high")))
    newest = in_window.groupBy("key").agg(
        F.max_by(F.struct("op", "value"), "position").alias("change"))

    # a key may appear inside the window only, so both sides are kept
    start = (snapshot.select("key", F.struct("value").alias("row"))
             .join(newest, "key", "full_outer").withColumn("chunk", chunk_of).join(chunks, "chunk"))
    value = F.when(F.col("change").isNotNull(), F.col("change.value")).otherwise(F.col("row.value"))
    first = (start.filter(F.col("change").isNull() | (F.col("change.op") != DELETE))
             .select("key", F.lit("r").alias("op"), F.col("high").alias("position"), value.alias("value")))
    later = dealt.filter(F.col("high").isNull() | (F.col("position") > F.col("high")))
    return first.unionByName(later.select("key", "op", "position", "value"))
