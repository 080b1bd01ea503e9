"""Bring the historic and the latest part of a table together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_parts(historic: DataFrame, latest: DataFrame) -> DataFrame:
    """All rows of both, matched by name; a column one side lacks is NULL there."""
    return historic.unionByName(latest, allowMissingColumns=True)


def outside_overlap(historic: DataFrame, latest: DataFrame, date_column: str) -> DataFrame:
    """Historic rows dated before the first latest row.

    Undated historic rows go, too. If the latest part has no date at all there
    is no overlap and the whole history stays. The cut is a scalar subquery:
    one number, computed by a partial aggregate and pushed into the scan.
    """
    cut = latest.select(F.min(date_column)).scalar()
    return historic.where(F.coalesce(F.col(date_column) < cut, cut.isNull()))


def replace_overlap(historic: DataFrame, latest: DataFrame, date_column: str) -> DataFrame:
    """Late data replaces the history from its first date on."""
    return union_parts(outside_overlap(historic, latest, date_column), latest)


#: The day of the column by which a written table is sorted (``plans.tables.write_table``).
MARK_DAY = "_mark_day"


def newer_than(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Dated rows past the target's high-water mark; all of them if it is empty.

    The bare comparison with a scalar subquery is pushed into the scan. Parquet row
    groups are skipped by it where ``column`` is a date; Spark does not compare timestamps with
    their minima and maxima. So where the frame has a ``MARK_DAY``, that is compared as well.
    """
    # Fixed value: an earlier day than any date of a shop.
    never = F.lit("0001-01-01").cast(df.schema[column].dataType)
    mark = F.coalesce(F.max(column), never)
    if MARK_DAY in df.columns:
        # The filter takes no dated row away. Without it Spark would compute both marks in one
        # subquery, and compare parts of its result only after the scan.
        day = target.where(F.col(column) >= never).select(mark.cast("date")).scalar()
        df = df.where(F.col(MARK_DAY) >= day).drop(MARK_DAY)
    return df.where(F.col(column) > target.select(mark).scalar())


def upsert(
    existing: DataFrame, new: DataFrame, keys: list[str], again: Column | None = None
) -> DataFrame:
    """``new`` replaces the rows of equal key; all other rows stay.

    Rows without key equal no other row. ``again`` says which of those that exist
    came with an earlier attempt at ``new`` and go.
    """
    kept = existing.join(new.select(*keys), keys, "left_anti")
    if again is not None:
        kept = kept.where(has_key(keys) | ~F.coalesce(again, F.lit(False)))
    return kept.unionByName(new)


def has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
