"""Run the raw load of all tables; one failing table does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.operators import ingest, reshape
from shopmill.operators.ingest import HISTORIC, LATEST, PART, Batch
from shopmill.registry import TABLES, pick_date_column
from shopmill.sources import batches, sinks
from shopmill.sources.raw import read_raw
from shopmill.sources.sinks import BATCH

Read = Callable[[str, str], DataFrame]
STATUS = "table_name string, status string, error string"


def load_initial(
    spark: SparkSession, read: Read, table: str, root: str, batch: Batch, copies: str | None = None
) -> None:
    """Historic and latest part into the raw table; optionally CSV and metadata copies.

    Nothing is computed before the batch is written: which columns of an unknown
    table are dates is found on the way, and applied by readers.
    """
    extracted = ingest.tagged_parts(read(table, HISTORIC), read(table, LATEST))
    loaded = ingest.transform(extracted, table, batch, counted=True, verdict={})
    record = sinks.append_batch(loaded, root, table, batch.batch_id)
    if copies:
        written = spark.read.parquet(batches.rows_path(root, table, record["folder"])).drop(BATCH)
        write_copies(written, copies, table, batch, record, pick_date_column(extracted.columns, table))


def load_increment(
    spark: SparkSession, read: Read, table: str, root: str, batch: Batch, copies: str | None = None
) -> None:
    """The latest part into the raw table, where it supersedes equal keys and the overlap.

    The history is already there and is not written again: the batch records
    the date from which it replaces older rows, and readers leave those out. The
    optional copy is the whole combined table and gets a new folder per batch,
    because the history it is made of must stay readable while it is written.
    """
    history = read_raw(spark, root, table, before=batch.batch_id, typed=False)
    recent = read(table, LATEST)
    if copies:
        combined = ingest.incremental_load(history, recent, table, batch, verdict={})
        snapshot = f"{_copy_folder(copies, table, batch)}/rows"
        counts = sinks.write_counted(combined, table, snapshot)
        written = spark.read.parquet(snapshot)
        write_copies(written, copies, table, batch, counts, pick_date_column(written.columns, table))
    # Of the history the batch takes columns and types alone. Rows could not be left out by their part:
    # it comes out of an aggregate, behind which all of them would be read, shuffled and sorted first.
    columns = history.where(F.lit(False))
    latest = ingest.incremental_load(columns, recent, table, batch, verdict={})
    column = pick_date_column(latest.columns, table)
    sinks.append_batch(latest, root, table, batch.batch_id, replaces_from=column)


def load_into_table(
    spark: SparkSession, read: Read, table: str, database: str, batch: Batch
) -> None:
    """The latest part appended to a table of a catalog, which is created at the first load.

    The table's columns follow the first batch. Timestamps and dates go through
    the text form that a warehouse loader takes. A batch that is loaded again is
    appended again: readers take the newest row per key (``read_loaded``).
    """
    rows = ingest.transform(ingest.tag_part(read(table, LATEST), LATEST), table, batch).drop(PART)
    name = f"`{database}`.`{table}`"
    sinks.create_table(rows, name)
    sinks.append_rows(reshape.normalize_temporals(rows, spark.table(name).schema), name)


def read_loaded(spark: SparkSession, table: str, database: str) -> DataFrame:
    """The newest row per key of a table that ``load_into_table`` filled."""
    return ingest.drop_repeated_keys(spark.table(f"`{database}`.`{table}`"), table)


def _copy_folder(copies: str, table: str, batch: Batch) -> str:
    return f"{copies.rstrip('/')}/{table}/{batch.batch_id}"


def write_copies(
    rows: DataFrame, copies: str, table: str, batch: Batch, counts: dict, date_column: str | None
) -> None:
    """CSV of already written rows, and metadata from what was counted while they were."""
    folder = _copy_folder(copies, table, batch)
    sinks.write_csv(rows.drop(PART), f"{folder}/csv")
    metadata = ingest.described(counts, rows, table, batch, date_column)
    sinks.write_metadata(metadata, f"{folder}/metadata")


def run_loads(
    spark: SparkSession,
    load: Callable[..., None],
    read: Read,
    root: str,
    batch: Batch,
    tables: Iterable[str] = TABLES,
    copies: str | None = None,
    parallel: int = 4,
) -> DataFrame:
    """One status row per table: loaded or failed, with the error.

    Tables do not depend on each other; ``parallel`` of them are submitted at a
    time, so that small ones do not leave the cluster idle.
    """

    def outcome(table: str) -> tuple[str, str, str | None]:
        try:
            load(spark, read, table, root, batch, copies)
        except Exception as error:
            return table, "failed", f"{type(error).__name__}: {error}"
        return table, "loaded", None

    with ThreadPoolExecutor(parallel) as pool:
        return spark.createDataFrame(list(pool.map(outcome, tables)), STATUS)


def require_loaded(status: DataFrame) -> None:
    """Raise if a table failed. The frame has one row per table."""
    failed = [f"{r.table_name}: {r.error}" for r in status.where("status = 'failed'").collect()]
    if failed:
        raise RuntimeError("raw load failed: " + "; ".join(failed))
