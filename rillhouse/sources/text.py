"""Readers for text streams and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.sources.schemas import TEXT_SCHEMA


def kafka_text(spark: SparkSession, servers: str, topic: str, *, starting: str = "earliest",
               max_offsets_per_trigger: int = 5_000_000, streaming: bool = True,
               extra: dict[str, str] | None = None) -> DataFrame:
    """A topic as ``value, arrival_ts, seq``.

    Offsets live in the query's checkpoint; ``starting`` only matters for its
    first run.  ``max_offsets_per_trigger`` bounds one micro-batch, and with it
    the rows one key can bring to a stateful operator at a time.  Needs the
    Spark Kafka package on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka")
    for key, value in kafka_options(servers, topic, starting, max_offsets_per_trigger,
                                    streaming, extra).items():
        reader = reader.option(key, value)
    return from_kafka_rows(reader.load())


def kafka_options(servers: str, topic: str, starting: str = "earliest",
                  max_offsets_per_trigger: int = 5_000_000, streaming: bool = True,
                  extra: dict[str, str] | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting}
    if streaming:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **(extra or {})}


def from_kafka_rows(rows: DataFrame) -> DataFrame:
    """Kafka columns to ``value, arrival_ts, seq``; seq sorts like (partition, offset)."""
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival_ts"),
        F.format_string("%05d-%019d", F.col("partition"), F.col("offset")).alias("seq"))


def replay_text(spark: SparkSession, path: str, *, fmt: str = "parquet",
                streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Recorded documents from files: ``text`` (one document per line) or a table with
    the columns ``value, arrival_ts, seq``."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        return _text_lines(reader, path, streaming)
    return reader.schema(TEXT_SCHEMA).format(fmt).load(path)


def _text_lines(reader, path: str, streaming: bool) -> DataFrame:
    """Lines with a ``seq`` that sorts like (file, position).

    A batch reads split files; within a split rows are numbered as they are read.  A stream
    cannot number rows, so it reads file by file and numbers the lines of each: recorded
    files for streams should be of moderate size.
    """
    now = F.current_timestamp().alias("arrival_ts")
    file = F.col("_metadata.file_path")
    if streaming:
        rows = reader.format("text").option("wholetext", "true").load(path)
        lines = rows.select(file.alias("f"), F.posexplode(F.split(F.regexp_replace("value", "\\r?\\n\\z", ""), "\\r?\\n")))
        return lines.select(F.col("col").alias("value"), now, F.format_string("%s|%019d", "f", "pos").alias("seq"))
    rows = reader.format("text").load(path)
    return rows.select("value", now, F.format_string(
        "%s|%019d|%019d", file, F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("seq"))


def jdbc_options(url: str, table: str, *, partition_column: str, lower: int, upper: int, partitions: int,
                 properties: dict[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), **(properties or {})}


def jdbc_snapshot(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table read in parallel ranges of a numeric column (``jdbc_options``)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def table_snapshot_as_changes(rows: DataFrame, table: str) -> DataFrame:
    """Snapshot rows as change events with op ``r``, so that a first load and the later
    changes run through the same code.  Decimals are written as strings."""
    columns = [F.col(n).cast("string").alias(n) if t.startswith("decimal") else F.col(n)
               for n, t in rows.dtypes]
    now = F.current_timestamp()
    event = F.struct(
        F.lit("r").alias("op"),
        F.struct(*columns).alias("after"),
        F.struct(F.lit(table).alias("table")).alias("source"),
        F.unix_millis(now).alias("ts_ms"))
    return rows.select(F.to_json(event).alias("value"), now.alias("arrival_ts"),
                       F.lit("").alias("seq"))
