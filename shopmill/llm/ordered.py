"""Running totals over a whole table in a given order, without one task that holds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmill.llm import store


def running(df: DataFrame, order: Sequence[Column], **totals: Column) -> DataFrame:
    """The rows, with each named value's sum over all rows before them in the order.

    Rows are dealt by ranges of the order and written; sums within a range start
    from the sum of the ranges before it. One task adds up one row per range.
    """
    ranged = store.settle(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("range_").agg(*(F.sum(value).alias(name) for name, value in totals.items()))
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("range_", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_") for n in totals))
    within = Window.partitionBy("range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(n) for n, v in totals.items()))
    return own.join(carried, "range_").select(*df.columns, *((F.col(n) + F.col(f"{n}_")).alias(n) for n in totals))


def latest(df: DataFrame, order: Sequence[Column], value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows, with the last value that is not null at or before each in the order, of rows that are alike in ``by``.

    Each range begins with the last values of the ranges before it: one row per
    range and distinct ``by``.
    """
    ranged = store.settle(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), "ranged")
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    own = ranged.groupBy("range_", *by).agg(last.alias("own_"))
    earlier = Window.partitionBy(*by).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.select("range_", *by, F.last("own_", ignorenulls=True).over(earlier).alias("carried_"))
    within = Window.partitionBy("range_", *by).orderBy(*order)
    found = ranged.withColumn("near_", F.last(value, ignorenulls=True).over(within)).join(carried, ["range_", *by])
    return found.select(*df.columns, F.coalesce("near_", "carried_").alias(name))
