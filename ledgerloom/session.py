"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join followed by another shuffle is still worth splitting
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it; a local one only where unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="ledgerloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df, name: str):
    """Write an intermediate table to the shared folder and read it back.

    For results that several later steps read: the work is done once, survives lost executors, and each
    reader scans only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged_alone(df, name: str):
    """``staged``, and the shuffle files that the write left behind are deleted at its end.

    Spark keeps them until the driver collects the plan, if ever, so that the jobs of one query add up on the disks.
    """
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return staged(df, name)


def broadcastable(df) -> bool:
    """Whether Spark would broadcast the table in a join, by its own estimate."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


@contextmanager
def compiled_methods(spark: SparkSession):
    """Jobs in which Spark gives up whole-stage code whose methods are too long for the JVM to compile (8,000 bytes).

    Long lists of cases would else be interpreted, row by row.
    """
    with setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000"):
        yield


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, or the folders that a pattern names, wherever they are stored."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(hadoop) or []:
        files.delete(found.getPath(), True)
