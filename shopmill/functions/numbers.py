"""Means, ratios and totals that have the same value on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL = T.DecimalType(38, 2)
# Units times reviews of one hot product can exceed a 64-bit integer.
UNITS = T.DecimalType(38, 0)


def ratio(total: Column, count: Column) -> Column:
    """Double division; NULL when the divisor is 0 or either side is NULL."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def ratio_or_zero(total: Column, count: Column) -> Column:
    return F.coalesce(ratio(total, count), F.lit(0.0))


def mean(column: Column) -> Column:
    """Exact sum over count. Decimal averages would round to the type's scale."""
    return ratio(F.sum(column), F.count(column))


def money_total(column: Column) -> Column:
    return F.sum(column).cast(TOTAL)


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)
