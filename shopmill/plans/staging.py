"""Staging layer: every raw column cast to its fixed type, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.functions import temporal
from shopmill.registry import LENIENT_STAMPS, base_name, staged_schema


def stage(raw: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Cast projection of one raw table; raw names may be in any case.

    ``strict`` fails on a value that does not fit its type; otherwise such a
    value becomes NULL. Words for "missing" in lenient columns always do.
    """
    lenient = LENIENT_STAMPS.get(base_name(table), ())
    cast = "cast" if strict else "try_cast"
    columns = []
    for field in staged_schema(table).fields:
        name, dtype = field.name, field.dataType.simpleString()
        if name in lenient:
            words = temporal.blank_words_to_null(F.col(name))
            columns.append(temporal.lenient_stamp(words).alias(name))
        else:
            columns.append(F.expr(f"{cast}({name} as {dtype}) as {name}"))
    return raw.select(*columns)
