"""Session defaults and the shared folder for written intermediate data."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Only for sessions this package starts itself; a cluster brings its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def start(master: str | None = None, name: str = "shopmill", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Without the setting a machine-local folder is only acceptable when driver
    and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="shopmill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path of this application below the shared folder."""
    return "/".join([shared_folder(spark), "shopmill", spark.sparkContext.applicationId, *parts])


@contextmanager
def shuffles_end_with_queries(spark: SparkSession):
    """Inside it, shuffle files go when their query ends.

    Otherwise they stay until the driver's collector meets the query, so those of every table of a layer lie on the disks together.
    For queries that run once, as writes do; a frame that is collected again computes its shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
