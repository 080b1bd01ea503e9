"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for NULL in a key, and the separator.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the columns' text, lower-case hex.

    A pure function of the natural values, so a builder computes a foreign key
    in place instead of joining the lookup table that defines it.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def key_if_present(value: Column) -> Column:
    """Surrogate key of one value, NULL where the value is NULL."""
    return F.when(value.isNotNull(), surrogate_key(value))
