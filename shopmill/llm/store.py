"""Written tables in the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill import session


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return session.work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """The frame, written once and read back, so that later jobs do not compute it again.

    ``free`` asks for a collection on the driver, after which Spark removes the
    shuffle files that only this write needed.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    if free:
        for _ in range(2):  # the first round drops the plans, the second what they alone held
            gc.collect()
            df.sparkSession.sparkContext._jvm.System.gc()
            time.sleep(0.5)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the files of a settled frame that no later job reads."""
    for file in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove(df.sparkSession, file)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Rows that go to a Python worker at a time. Texts may be long: Spark's 10,000 of them
#: would take a large part of an executor's memory.
ROWS_A_BATCH = 500


#: Most partitions of one shuffle. More buckets than that share partitions, in which they follow one another.
PARTITIONS = 1 << 14


def deal(sent: DataFrame, buckets: int) -> DataFrame:
    """The rows by ``bucket``; a partition's rows come bucket after bucket, so that a task holds one of them."""
    parts = min(buckets, PARTITIONS)
    return sent.repartitionById(parts, (F.col("bucket") % parts).cast("int")).sortWithinPartitions("bucket")


def prepared(query: Callable) -> Callable:
    """The query, with this package on the path of Python workers and small batches for them."""

    @wraps(query)
    def run(spark: SparkSession, *rest):
        root = str(Path(__file__).resolve().parents[2])
        own = spark.sparkContext.environment
        if root not in own.get("PYTHONPATH", "").split(":"):
            own["PYTHONPATH"] = ":".join(filter(None, [root, own.get("PYTHONPATH")]))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_A_BATCH)
        return query(spark, *rest)

    return run
