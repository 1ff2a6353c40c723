"""Session defaults and lineage cuts that survive executor loss."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans here were checked with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session (tests) may fall back to a folder of its own.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="cohortlens-")
    context.setCheckpointDir(own)
    return context.getCheckpointDir() or own


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where the same rows must be seen identically by several branches of a
    plan (range ids, hash ranks) and where iterative jobs re-read a table. The
    files outlive any executor, and a re-read prunes columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files of another kind, dropped with the written tables."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage, so that Spark deletes shuffle files that no plan in use refers to.

    It does so on its own only when the driver runs short of memory; a query that has written its rows and goes on to
    shuffle as much again would hold both.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_WRITTEN: dict[str, list[str]] = {}


def drop_materialised(spark: SparkSession) -> int:
    """Delete the tables this application wrote with ``materialise``; call when results are saved."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        folder = hadoop.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)
