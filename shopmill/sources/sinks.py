"""Sinks: raw batches, CSV and JSON copies, batch metadata."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill import session
from shopmill.functions import temporal
from shopmill.operators import reshape
from shopmill.operators.ingest import EXTRACTED, HISTORIC, LATEST, PART
from shopmill.registry import BUSINESS_COLUMNS, base_name, pick_date_column, storage_type
from shopmill.sources import batches

BATCH = "INGEST_BATCH"


def append_batch(
    df: DataFrame,
    root: str,
    table: str,
    batch_id: str,
    rows_per_file: int = 0,
    replaces_from: str | None = None,
) -> dict:
    """Add one batch to a raw table and return its row in the list of batches.

    Rows go to a new folder and count once the batch is listed, so a batch is
    there whole or not at all. A rerun takes the place of the batch with its id, also where a
    part has become empty. A column whose type differs from that of other batches
    is an error before anything is written. ``replaces_from`` names the date
    column from whose first value on the batch replaces all rows loaded before
    it. The batch id is a text column, whatever it looks like. ``rows_per_file``
    bounds the files where a consumer needs it (0: no bound; small files slow
    every later scan). Of a table that the registry does not know, columns named
    like dates are kept as text; whether all their values are timestamps is found while the batch is
    written and goes to the list, from which readers type them.
    """
    spark = df.sparkSession
    known = batches.batches(spark, root, table)
    stored = df if PART in df.columns else df.withColumn(PART, F.lit(LATEST))
    stored = stored.withColumn(BATCH, F.lit(batch_id))
    probed = undeclared_temporals(stored, table)
    stored = stored.withColumns({c: F.col(c).cast("string") for c in probed}) if probed else stored
    schema = T.StructType([f for f in stored.schema.fields if f.name not in EXTRACTED])
    batches.columns_of([b for b in known if b.batch_id != batch_id], schema)
    folder = f"batch-{quote(batch_id, safe='')}/{uuid.uuid4().hex}"
    counts = write_counted(
        stored, table, batches.rows_path(root, table, folder), replaces_from, rows_per_file, probed
    )
    record = {"batch_id": batch_id, "folder": folder, "columns": schema.json(), **counts}
    batches.commit(spark, root, table, record)
    for old in known:
        if old.batch_id == batch_id:
            session.remove(spark, batches.rows_path(root, table, old.folder))
    return record


def undeclared_temporals(df: DataFrame, table: str) -> list[str]:
    """Text and timestamp columns of an unknown table that are named like dates."""
    if base_name(table) in BUSINESS_COLUMNS:
        return []
    kinds = dict(df.dtypes)
    named = reshape.temporal_candidates(df.columns)
    return [c for c in named if kinds[c] in ("string", "timestamp_ntz") and c != "LOADED_AT"]


def write_counted(
    df: DataFrame,
    table: str,
    path: str,
    replaces_from: str | None = None,
    rows_per_file: int = 0,
    probed: Sequence[str] = (),
) -> dict:
    """Write rows with their part, and what was counted on the way.

    The counts are taken where rows are written, in the job's last stage, whose
    tasks count once however often they run. Rows that carry what was extracted
    for them (``EXTRACTED``) are counted as that. Of each ``probed`` column it is found
    whether all values are timestamps (``temporals``, as JSON).
    """
    counted = set(EXTRACTED) <= set(df.columns)
    column, part = pick_date_column(df.columns, table), F.col(PART)
    dates = temporal.try_stamp(F.col(column)) if column else F.lit(None).cast("timestamp_ntz")
    loaded = F.col("LOADED_AT") if "LOADED_AT" in df.columns else F.lit(None).cast("timestamp_ntz")
    cut = temporal.try_stamp(F.col(replaces_from)) if replaces_from else F.lit(None).cast("timestamp_ntz")
    historic, latest, first = EXTRACTED
    seen = Observation()
    (
        df.observe(
            seen,
            (F.sum(historic) if counted else F.count_if(part == HISTORIC)).alias("historic_records"),
            (F.sum(latest) if counted else F.count_if(part == LATEST)).alias("latest_records"),
            (F.sum(F.col(historic) + F.col(latest)) if counted else F.count(F.lit(1))).alias("total_records"),
            F.min(F.col(first) if counted else dates).cast("string").alias("min_date"),
            F.min(loaded).cast("string").alias("first_loaded"),
            F.max(loaded).cast("string").alias("last_loaded"),
            F.min(cut).cast("string").alias("replaces_from"),
            *(c.alias(f"temporal_{i}") for i, c in enumerate(reshape.all_stamps(probed))),
        )
        .drop(*EXTRACTED)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
    found = seen.get
    holds = {c: found.pop(f"temporal_{i}") for i, c in enumerate(probed)}
    found["temporals"] = json.dumps(holds) if holds else None
    return {k: v or 0 if k.endswith("_records") else v for k, v in found.items()}


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A folder of bounded CSV files with header, quotes inside values doubled."""
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, in parallel; metadata goes to its own file."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """The one-row batch description."""
    metadata.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def create_table(df: DataFrame, name: str) -> None:
    """Create the raw table if it is absent; its columns follow the frame's types."""
    spark = df.sparkSession
    columns = T.StructType(
        [T.StructField(f.name, storage_type(f.dataType), True) for f in df.schema.fields]
    )
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source="parquet", schema=columns)


def append_rows(df: DataFrame, name: str, rows_per_file: int = 100_000) -> None:
    """Append to a table, creating it first; an empty frame adds nothing."""
    create_table(df, name)
    target = df.sparkSession.table(name).schema
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in target.fields])
    (
        typed.write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .saveAsTable(name, format="parquet")
    )
