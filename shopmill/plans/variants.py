"""Earlier definitions of four normalized tables that differ in detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.functions.temporal import cut_to_millis, lenient_stamp
from shopmill.plans import entities, transactions


def orders_by_load_time(
    stg_orders: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    """``orders`` dated by its load instead of its creation."""
    wide = transactions.order_measures(stg_orders, stg_order_items, stg_reviews)
    return wide.withColumn("created_at", F.col("loaded_at")).select(*transactions.ORDER_COLUMNS)


def order_items_newest_score(
    stg_order_items: DataFrame,
    stg_products: DataFrame,
    stg_orders: DataFrame,
    stg_reviews: DataFrame,
) -> DataFrame:
    """The newest-score rule, which the current ``order_items`` uses as well."""
    return transactions.order_items(stg_order_items, stg_products, stg_orders, stg_reviews)


def customers_with_parsed_dates(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Customers whose four dates are parsed leniently to milliseconds; no order totals."""
    dates = ("signup_date", "last_login", "first_order_date", "last_order_date")
    wide = entities.customer_measures(stg_customers, stg_orders)
    parsed = wide.withColumns({c: cut_to_millis(lenient_stamp(F.col(c))) for c in dates})
    return parsed.select(
        "customer_id",
        "email",
        "first_name",
        "last_name",
        "age",
        "gender",
        "annual_income",
        "education_id",
        "marital_status_id",
        "location_id",
        *dates,
        "created_at",
    )


def categories_by_using(
    stg_categories: DataFrame, stg_subcategories: DataFrame, stg_products: DataFrame
) -> DataFrame:
    """Same result as ``categories_enriched``."""
    return entities.categories_enriched(stg_categories, stg_subcategories, stg_products)
