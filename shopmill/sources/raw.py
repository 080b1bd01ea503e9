"""The raw layer: append-only batches, read as the newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.functions import temporal
from shopmill.operators import reshape
from shopmill.operators.ingest import PART
from shopmill.operators.latest import latest_by_key
from shopmill.registry import pick_date_column, primary_keys
from shopmill.sources import batches
from shopmill.sources.sinks import BATCH, append_batch

_CUTS = "_cuts"


def read_raw(
    spark: SparkSession,
    root: str,
    table: str,
    newest: bool = True,
    before: str | None = None,
    typed: bool = True,
) -> DataFrame:
    """The current rows: without what later batches replaced, one per key, the newest load first.

    At equal load time the latest part beats the historic one. ``newest=False``
    gives the rows of all batches as they were appended. ``before`` leaves one
    batch out, whose load is being repeated. A column that came with a later
    batch is NULL in rows of earlier ones. Only committed batches are read, in
    one scan with the columns that the list of batches names. Text columns of an unknown
    table that the list says are timestamps in every batch are returned as such; ``typed=False``
    leaves them text, as they are stored.
    """
    known = [b for b in batches.batches(spark, root, table) if b.batch_id != before]
    if not known:
        raise FileNotFoundError(f"no batch of {table} below {root}" + (f" but {before}" if before else ""))
    schema = batches.columns_of(known)
    df = spark.read.schema(schema).parquet(*(batches.rows_path(root, table, b.folder) for b in known))
    if newest:
        df = _without_replaced(df, table, batches.cuts(spark, known, BATCH, _CUTS))
        keys = [k.upper() for k in primary_keys(table)]
        if keys and set(keys) <= set(df.columns):
            df = latest_by_key(df, keys, ["LOADED_AT", PART])
    stamps = batches.temporals(known) if typed else {}
    return reshape.parse_temporals(df, verdict=stamps).drop(BATCH, PART)


def _without_replaced(df: DataFrame, table: str, cuts: DataFrame | None) -> DataFrame:
    """Rows that no batch loaded later replaces: it does so from a date on, and undated ones.

    Batches of one load time never replace each other's rows.
    """
    column = pick_date_column(df.columns, table)
    if cuts is None or column is None or "LOADED_AT" not in df.columns:
        return df
    date = temporal.try_stamp(F.col(column))
    replaced = F.exists(
        _CUTS, lambda c: (c["at"] > F.col("LOADED_AT")) & F.coalesce(date >= c["cut"], F.lit(True))
    )
    kept = df.join(cuts, BATCH, "left").where(~F.coalesce(replaced, F.lit(False)))
    return kept.select(*df.columns)


def compact(spark: SparkSession, root: str, table: str, new_root: str, batch_id: str) -> None:
    """Write the current rows as the only batch of a raw table below ``new_root``.

    Rows keep their load time, so batches appended later still supersede them.
    """
    append_batch(read_raw(spark, root, table, typed=False), new_root, table, batch_id)
