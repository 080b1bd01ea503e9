"""Lookup tables: the distinct values of one column and their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.functions.keys import surrogate_key
from shopmill.functions.temporal import moment
from shopmill.functions.text import filled


def value_lookup(df: DataFrame, column: str, id_name: str, value_name: str, as_of) -> DataFrame:
    """Distinct non-NULL values. The key is hashed after the distinct, once per value."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias(value_name)).distinct()
    return values.select(
        surrogate_key(value_name).alias(id_name), value_name, moment(as_of).alias("created_at")
    )


def education_types(stg_customers: DataFrame, as_of) -> DataFrame:
    return value_lookup(stg_customers, "education", "education_id", "education_type", as_of)


def marital_statuses(stg_customers: DataFrame, as_of) -> DataFrame:
    return value_lookup(stg_customers, "marital_status", "marital_status_id", "status_type", as_of)


def order_statuses(stg_orders: DataFrame, as_of) -> DataFrame:
    return value_lookup(stg_orders, "status", "status_id", "status_name", as_of)


def payment_methods(stg_orders: DataFrame, as_of) -> DataFrame:
    return value_lookup(stg_orders, "payment_method", "payment_method_id", "method_name", as_of)


def brands(stg_products: DataFrame, as_of) -> DataFrame:
    """Brand names without surrounding blanks; blank ones are no brand."""
    named = stg_products.where(filled(F.col("brand"))).select(F.trim("brand").alias("brand"))
    return value_lookup(named, "brand", "brand_id", "brand_name", as_of)
