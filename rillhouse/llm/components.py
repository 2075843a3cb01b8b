"""Connected components over links, by alternating star contractions.

Each round turns links into stars: every node's larger neighbours are linked to its
smallest one (large star), then every node's smaller neighbours and the node itself
(small star).  Minima are aggregates with partial results and the rest are equi-joins,
so a node with very many links is no group that a task has to hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import dropped, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    found = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return found.filter("hi <> lo").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    down = links.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    own = least.select("hi", F.col("m").alias("lo"))
    return down.unionByName(own).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                           F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node.

    ``links`` has two bigint columns ``hi`` > ``lo``.
    """
    now = stored(links.distinct(), "links")
    before, state = None, _state(now)
    while state != before:
        old, now = now, stored(_small_star(_large_star(now)), "links")
        dropped(old)
        before, state = state, _state(now)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
