"""Lateness row by row, in order of arrival.

A stream's watermark follows the largest event time that has arrived; a row is late when its
window had closed before it came.  Per micro-batch that depends on how a stream is cut.  Here
every row gets the watermark of its own place: the maximum over all rows before it.

The prefix maximum runs in parallel.  Rows are dealt to blocks by ranges of the arrival
order; every block runs its own maximum, and the blocks' maxima, one number per block, are
scanned and added to the blocks behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.session import scratch_path


def prefix_maximum(rows: DataFrame, value: Column, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the largest ``value`` of the rows before, null for the first ones.

    Rows that are equal in ``order`` follow each other in any way.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "blocks")
    # A block's number has to stay the same for its rows and for its maximum.
    (rows.withColumn("_value", value).withColumn("_row", F.monotonically_increasing_id())
     .repartitionByRange(*order, "_row").withColumn("_block", F.spark_partition_id())
     .write.parquet(path))
    blocks = spark.read.parquet(path)

    tops, known = [], None
    for row in blocks.groupBy("_block").agg(F.max("_value").alias("top")).orderBy("_block").collect():
        tops.append((row["_block"], known))
        known = row["top"] if known is None else max(known, row["top"] if row["top"] is not None else known)
    kind = blocks.schema["_value"].dataType.simpleString()
    carried = spark.createDataFrame(tops, f"_block int, _carried {kind}")

    before = (Window.partitionBy("_block").orderBy(*order, "_row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (blocks.join(F.broadcast(carried), "_block", "left")
            .withColumn(name, F.greatest(F.max("_value").over(before), "_carried"))
            .select(*rows.columns, name))


def with_lateness(parsed: DataFrame, order: list[str], window_seconds: int = 30,
                  delay_seconds: int = 3) -> DataFrame:
    """Usable rows (``event_ts``, no ``reason``) with ``watermark`` and ``late``: whether
    their window had closed when they arrived."""
    usable = parsed.filter(F.col("reason").isNull())
    known = prefix_maximum(usable, F.col("event_ts"), order, "_latest")
    end = (F.floor(F.unix_seconds("event_ts") / window_seconds) + 1) * window_seconds
    watermark = F.col("_latest") - F.expr(f"INTERVAL {delay_seconds} SECONDS")
    return (known.withColumn("watermark", watermark).drop("_latest")
            .withColumn("late", F.coalesce(F.timestamp_seconds(end) <= F.col("watermark"), F.lit(False))))
