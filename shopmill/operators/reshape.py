"""Column work on raw frames: flatten, name, stamp, align."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.functions import numbers, temporal
from shopmill.registry import BUSINESS_COLUMNS, LENIENT_STAMPS, STAMP, base_name, stamp_columns


def flatten_nested(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct column ``c`` becomes ``c_<field>`` columns; lists become JSON text.

    Every value stays on its own row, also behind rows where the struct is NULL.
    """
    flat: list[Column] = []
    nested: list[Column] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            nested += _leaves(F.col(f"`{field.name}`"), field.name, field.dataType, separator)
        else:
            flat.append(_plain(F.col(f"`{field.name}`"), field.dataType).alias(field.name))
    return df.select(*flat, *nested)


def _leaves(parent: Column, prefix: str, dtype: T.StructType, separator: str) -> list[Column]:
    found = []
    for field in dtype.fields:
        column, name = parent.getField(field.name), f"{prefix}{separator}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(column, name, field.dataType, separator)
        else:
            found.append(_plain(column, field.dataType).alias(name))
    return found


def _plain(column: Column, dtype: T.DataType) -> Column:
    return F.to_json(column) if isinstance(dtype, (T.ArrayType, T.MapType)) else column


def with_audit(
    df: DataFrame, batch_id: str, loaded_at: str | dt.datetime, data_source: str = "historic"
) -> DataFrame:
    """Audit columns; values are passed in so that a repeated run is identical."""
    return df.withColumns(
        {
            "data_source": F.lit(data_source),
            "batch_id": F.lit(batch_id),
            "loaded_at": temporal.moment(loaded_at),
        }
    )


def temporal_candidates(columns: Iterable[str]) -> list[str]:
    """Columns whose name says they hold a date."""
    # Name fragments and whole names that mark a temporal column.
    fragments = ("date", "time")
    names = ("loaded_at", "created_at", "updated_at")
    return [
        c for c in columns if any(f in c.lower() for f in fragments) or c.lower() in names
    ]


def temporal_probe(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row, one boolean per column: does every non-NULL value parse?"""
    columns = list(columns)
    return df.agg(*[found.alias(c) for c, found in zip(columns, all_stamps(columns))])


def all_stamps(columns: Iterable[str]) -> list[Column]:
    """The aggregates of ``temporal_probe``; those of parts of a table are combined by AND."""
    stamps = [temporal.try_stamp(F.col(c)).isNotNull() | F.col(c).isNull() for c in columns]
    return [F.coalesce(F.bool_and(stamp), F.lit(True)) for stamp in stamps]


def parse_temporals(
    df: DataFrame, table: str | None = None, verdict: Mapping[str, bool] | None = None
) -> DataFrame:
    """Turn text columns with temporal names into timestamps.

    For a registered table the registry says which ones, at no cost. For an
    unknown table ``verdict`` does, as ``temporal_probe`` gives it; without one
    an aggregate over all candidates is run at once. A column with any
    unparsable value stays text.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    candidates = [c for c in temporal_candidates(df.columns) if c in text]
    if table is not None and base_name(table) in BUSINESS_COLUMNS:
        lenient = LENIENT_STAMPS.get(base_name(table), ())
        stamps = {n for n, t in BUSINESS_COLUMNS[base_name(table)] if t == STAMP}
        chosen = [c for c in candidates if c.lower() in stamps and c.lower() not in lenient]
    elif candidates:
        if verdict is None:
            verdict = temporal_probe(df, candidates).first().asDict()
        chosen = [c for c in candidates if verdict.get(c)]
    else:
        chosen = []
    return df.withColumns({c: temporal.try_stamp(F.col(c)) for c in chosen})


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value in Spark; the warehouse treats it as missing."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: numbers.nan_to_null(F.col(c)) for c in floats}) if floats else df


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def require_distinct_names(df: DataFrame) -> DataFrame:
    """Spark ignores case in names, so names that differ only by case clash too."""
    clashes = sorted(n for n, k in Counter(c.lower() for c in df.columns).items() if k > 1)
    if clashes:
        raise ValueError(f"duplicate columns: {clashes}")
    return df


def coerce_stamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns to timestamps, names matched in any case, bad values to NULL."""
    wanted = {c.lower() for c in columns}
    return df.withColumns(
        {c: temporal.try_stamp(F.col(c)) for c in df.columns if c.lower() in wanted}
    )


def normalize_temporals(df: DataFrame, target: T.StructType) -> DataFrame:
    """Temporal columns of ``target`` as text a warehouse loader accepts.

    Dates become ``yyyy-MM-dd`` (bad values NULL). Timestamps and epoch numbers
    become ``yyyy-MM-dd HH:mm:ss.SSS``; text passes through unchanged.
    """
    kinds = {name.lower(): kind for name, kind in stamp_columns(target).items()}
    changed = {}
    for field in df.schema.fields:
        kind, column = kinds.get(field.name.lower()), F.col(f"`{field.name}`")
        if kind == "date":
            changed[field.name] = temporal.iso_day(column)
        elif kind == "timestamp":
            changed[field.name] = _as_iso_text(column, field.dataType)
    return df.withColumns(changed) if changed else df


def _as_iso_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, T.NumericType):
        return temporal.iso_millis(temporal.epoch_stamp(numbers.nan_to_null(column)
                                   if isinstance(dtype, (T.DoubleType, T.FloatType)) else column))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return temporal.iso_millis(column)
    return F.lit(None).cast("string")
