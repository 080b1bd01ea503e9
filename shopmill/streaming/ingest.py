"""Raw loads as restartable file streams: batches appended, or a table with one row per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopmill.operators.ingest import LATEST, PART, Batch, tag_part, transform
from shopmill.plans.tables import read_upserted, upsert_path
from shopmill.registry import landing_schema, primary_keys
from shopmill.sources.sinks import append_batch

#: The local property in which Spark names the stream that a micro-batch belongs to.
STREAM_ID = "sql.streaming.queryId"


def _clock(batch: int) -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def stream_into_raw(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    table: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    loaded_at: Callable[[int], str] = _clock,
) -> StreamingQuery:
    """Load all JSON-lines files of a landing folder that were not loaded yet, then stop.

    Every micro-batch becomes one batch of the raw table. A replayed micro-batch
    replaces itself, so each file counts once after any failure, and readers see
    the newest row per key. Nothing is kept in stream state, however large the
    table grows.
    """

    def load(rows: DataFrame, number: int) -> None:
        batch = Batch(f"stream-{number:012d}", loaded_at(number))
        append_batch(transform(tag_part(rows, LATEST), table, batch), raw_root, table, batch.batch_id)

    return _start(spark, landing, table, checkpoint, files_per_batch, load)


def stream_into_table(
    spark: SparkSession,
    landing: str,
    path: str,
    table: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    loaded_at: Callable[[int], str] = _clock,
    buckets: int = 256,
) -> StreamingQuery:
    """Keep a table of the newest row per key up to date with a landing folder, then stop.

    Every micro-batch is reduced to one row per key and replaces the rows of equal
    key; of the table only the hash buckets that hold its keys are rewritten. So readers
    need no pass for the newest row. ``BATCH_ID`` of a row is the stream's id and the number of
    the micro-batch that wrote it. A replayed micro-batch writes its keys again, and its rows
    without key, which replace nothing, take the place of those that bear its id. One
    stream at a time may write to a table, always with the same number of buckets; the stream's
    id comes from the checkpoint.
    """
    keys = [k.upper() for k in primary_keys(table)]
    if not keys:
        raise ValueError(f"{table} has no key")
    landed = [f.name.upper() for f in landing_schema(table).fields]

    def load(rows: DataFrame, number: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty(STREAM_ID)
        batch = Batch(f"{stream}-{number:012d}", loaded_at(number))
        new = transform(tag_part(rows, LATEST), table, batch).drop(PART)
        again = F.col("BATCH_ID") == batch.batch_id
        upsert_path(new, path, keys, buckets=buckets, spread=landed, again=again)

    return _start(spark, landing, table, checkpoint, files_per_batch, load)


def read_streamed(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``stream_into_table`` keeps: one row per key, and all rows without key."""
    return read_upserted(spark, path)


def _start(spark, landing: str, table: str, checkpoint: str, files_per_batch: int, load) -> StreamingQuery:
    return (
        spark.readStream.schema(landing_schema(table))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
