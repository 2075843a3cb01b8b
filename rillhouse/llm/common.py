"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.session import scratch_path

#: Rows handled at once inside a Python task; texts are turned into Python objects
#: slice by slice, so a task's memory follows its longest texts, not its partition.
SLICE_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Session options for Arrow batches: few rows, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that ``stored`` has written, in this order.
_folders: list[str] = []


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: evaluated once, lineage cut, and
    still there when an executor is lost."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    _folders.append(path)
    return spark.read.schema(rows.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dropped(rows: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    for folder in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
        _delete(rows.sparkSession, folder)


def stored_result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``stored`` for what ``make`` returns; everything that it stored on its way is deleted."""
    since = len(_folders)
    result = stored(make(), name)
    for folder in _folders[since:-1]:
        _delete(result.sparkSession, folder)
    del _folders[since:-1]
    return result


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_slices(rows: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Apply ``make()(list per column) -> list of columns`` to slices of every partition.

    ``make`` runs once per task, so models and caches are set up there.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                columns = work(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(list(columns), names=names)

    return rows.mapInArrow(run, schema)


def longs(values) -> pa.Array:
    return pa.array(values, type=pa.int64())


def strings(values) -> pa.Array:
    return pa.array(values, type=pa.string())


def doubles(values) -> pa.Array:
    return pa.array(values, type=pa.float64())


def booleans(values) -> pa.Array:
    return pa.array(values, type=pa.bool_())


def id_and_text(documents: DataFrame) -> DataFrame:
    """Only the two columns that are read, whatever else the table carries."""
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                            F.coalesce(F.col("text"), F.lit("")).alias("text"))
