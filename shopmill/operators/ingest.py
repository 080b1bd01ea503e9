"""Raw load: transform one table's parts and describe the batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.functions import temporal
from shopmill.operators import combine, reshape
from shopmill.operators.latest import latest_by_key
from shopmill.registry import date_columns, pick_date_column, primary_keys

PART = "SOURCE_PART"
HISTORIC, LATEST = "historic", "latest"
#: Per kept row: how many rows of each part were extracted for it, and the first date of the latest ones.
EXTRACTED = ("_EXTRACTED_HISTORIC", "_EXTRACTED_LATEST", "_EXTRACTED_FIRST")


@dataclass(frozen=True)
class Batch:
    batch_id: str
    loaded_at: str | dt.datetime
    data_source: str = "historic"


def tag_part(df: DataFrame, part: str) -> DataFrame:
    return df.withColumn(PART, F.lit(part))


def drop_repeated_keys(df: DataFrame, table: str, counted: bool = False) -> DataFrame:
    """Newest row per primary key; unchanged if a key column is missing.

    ``counted`` adds what was extracted for each row, so that a batch can be
    described where its rows are written.
    """
    keys = [k.upper() for k in primary_keys(table)]
    part, column = F.col(PART), pick_date_column(df.columns, table)
    dates = temporal.try_stamp(F.col(column)) if column else F.lit(None).cast("timestamp_ntz")
    dates = F.when(part == LATEST, dates)
    if not keys or not set(keys) <= set(df.columns):
        own = [(part == p).cast("long") for p in (HISTORIC, LATEST)]
        return df.withColumns(dict(zip(EXTRACTED, [*own, dates]))) if counted else df
    # 'latest' sorts after 'historic', so at equal load time it wins.
    version = [c for c in ("LOADED_AT", PART) if c in df.columns]
    also = [F.count_if(part == HISTORIC), F.count_if(part == LATEST), F.min(dates)]
    return latest_by_key(df, keys, version, [a.alias(n) for a, n in zip(also, EXTRACTED)] if counted else [])


def transform(
    df: DataFrame,
    table: str,
    batch: Batch,
    counted: bool = False,
    verdict: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Flatten, audit columns, timestamps, NULLs, upper-case names, one row per key.

    ``verdict`` says which text columns of an unknown table are timestamps (``reshape.parse_temporals``).
    """
    return (
        reshape.flatten_nested(df)
        .transform(reshape.with_audit, batch.batch_id, batch.loaded_at, batch.data_source)
        .transform(reshape.parse_temporals, table, verdict)
        .transform(reshape.missing_to_null)
        .transform(reshape.upper_names)
        .transform(reshape.require_distinct_names)
        .transform(drop_repeated_keys, table, counted)
    )


def tagged_parts(historic: DataFrame, latest: DataFrame) -> DataFrame:
    return combine.union_parts(tag_part(historic, HISTORIC), tag_part(latest, LATEST))


def initial_load(historic: DataFrame, latest: DataFrame, table: str, batch: Batch) -> DataFrame:
    """First load: both parts in one frame, then transformed."""
    return transform(tagged_parts(historic, latest), table, batch)


def incremental_load(
    historic: DataFrame,
    latest: DataFrame,
    table: str,
    batch: Batch,
    verdict: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Daily load: each part transformed, the overlap replaced by the latest part."""
    old = transform(tag_part(historic, HISTORIC), table, batch, verdict=verdict)
    new = transform(tag_part(latest, LATEST), table, batch, verdict=verdict)
    column = pick_date_column(new.columns, table)
    if column is not None:
        old, new = (reshape.coerce_stamps(side, [column]) for side in (old, new))
        if column in old.columns:
            old = combine.outside_overlap(old, new, column)
    return combine.union_parts(old, new).transform(reshape.coerce_stamps, date_columns(table))


def batch_metadata(
    loaded: DataFrame, table: str, batch: Batch, extracted: DataFrame | None = None
) -> DataFrame:
    """One row about a loaded batch, from one pass over its part and date columns.

    By default the loaded rows are counted and their first date is given. An
    initial load passes its ``extracted`` rows instead (``tagged_parts``): it
    reports them before repeated keys go, and the first date of the latest part.
    Rows that are being written are counted on the way instead (``described``).
    """
    counted = loaded if extracted is None else extracted
    column = pick_date_column(counted.columns, table)
    part = F.col(PART)
    dates = temporal.try_stamp(F.col(column)) if column else F.lit(None).cast("timestamp_ntz")
    if extracted is not None:
        dates = F.when(part == LATEST, dates)
    counts = counted.agg(
        F.count_if(part == HISTORIC).alias("historic_records"),
        F.count_if(part == LATEST).alias("latest_records"),
        F.count(F.lit(1)).alias("total_records"),
        F.min(dates).alias("min_date"),
    )
    return _about(counts, loaded, table, batch, column)


def described(counts: dict, loaded: DataFrame, table: str, batch: Batch, column: str | None) -> DataFrame:
    """The same row from what ``sinks.write_counted`` counted."""
    names = ("historic_records", "latest_records", "total_records")
    values = [F.lit(counts[n]).cast("long").alias(n) for n in names]
    first = F.lit(counts["min_date"]).cast("timestamp_ntz").alias("min_date")
    return _about(loaded.sparkSession.range(1).select(*values, first), loaded, table, batch, column)


def _about(counts: DataFrame, loaded: DataFrame, table: str, batch: Batch, column: str | None) -> DataFrame:
    types = {name: kind for name, kind in loaded.dtypes if name not in (PART, *EXTRACTED)}
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(batch.batch_id).alias("batch_id"),
        temporal.moment(batch.loaded_at).alias("timestamp"),
        "historic_records",
        "latest_records",
        "total_records",
        F.lit(column).cast("string").alias("date_column_used"),
        F.array(*[F.lit(c) for c in types]).alias("columns"),
        F.create_map(*[F.lit(x) for pair in types.items() for x in pair]).alias("data_types"),
        "min_date",
    )
