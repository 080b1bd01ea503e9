"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


ROW = "_row_without_key"


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("loaded_at",),
    also: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: the highest ``version``, then the highest remaining values.

    The order is total, so only identical rows can tie and the result does not
    depend on read order. ``max`` of a struct combines on the map side: a key
    with a third of all rows reaches its reducer as one row per map task, where
    a ``row_number`` window would sort the whole group in one task.

    Rows with a NULL key part identify nothing and are all kept. ``also`` are
    further aggregates over all rows of a key, each added as a column.
    """
    versions = [c for c in version if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in versions]
    unordered = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if unordered:
        raise ValueError(f"map columns have no order, flatten them first: {unordered}")

    group = list(keys)
    if any(df.schema[k].nullable for k in keys):
        # A row without key is a group of its own, so that one pass serves all rows.
        keyed = _all(F.col(k).isNotNull() for k in keys)
        df = df.withColumn(ROW, F.when(~keyed, F.monotonically_increasing_id()))
        group.append(ROW)
    names = [c for c in df.columns if c != ROW]
    best = F.max(F.struct(*versions, *rest)).alias("_best")
    newest = df.groupBy(*group).agg(best, *also)
    return newest.select(*[c if c in keys else F.col(f"_best.{c}").alias(c) for c in names], *newest.columns[len(group) + 1 :])


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
