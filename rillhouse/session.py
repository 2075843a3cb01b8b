"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  They are plain Spark options, so a cluster
# operator can pass the same ones with --conf instead of using build_session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "rillhouse",
                  time_zone: str = "UTC", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the settings above.

    ``time_zone`` decides window labels and ``cur_date``; pass for example
    ``Asia/Shanghai`` when business days follow that zone.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, "spark.sql.session.timeZone": time_zone, **(extra or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a folder in the
    warehouse, which is shared as well, where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written below ``scratch_path``; call it when no
    result is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def clear_files(spark: SparkSession, path: str, ending: str) -> None:
    """Delete the files of a scratch folder whose names end so."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(folder) if files.exists(folder) else []:
        if found.getPath().getName().endswith(ending):
            files.delete(found.getPath(), False)


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files stay until the driver's JVM collects the frames that made them; ask for
    that between two heavy steps, so that the second does not add to the first one's disk."""
    gc.collect()
    spark._jvm.System.gc()
