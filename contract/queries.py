"""Registered queries: one per operator, over a folder of order-processing parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopmill.plans.warehouse import MARTS, NORMALIZED, STAGING, Warehouse
from shopmill.sources import shop

Query = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The derived raw tables are unique by key, so staging needs no pass for that."""
    return Warehouse(lambda t: shop.raw_table(spark, folder, t), shop.AS_OF, newest=False)


def _table(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder).table(name)


QUERIES: dict[str, Query] = {name: _table(name) for name in STAGING}
QUERIES |= {f"int_{name}": _table(name) for name in NORMALIZED}
QUERIES |= {name: _table(name) for name in MARTS}
