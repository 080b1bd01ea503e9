"""Mart dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.functions import temporal
from shopmill.functions.numbers import TOTAL, ratio_or_zero
from shopmill.plans.transactions import repeated


def dim_dates(orders: DataFrame, interactions: DataFrame, as_date: bool = False) -> DataFrame:
    """Distinct order and event times with calendar columns.

    The grain is the full timestamp; ``as_date`` makes it the calendar day.
    """
    seen = orders.select(F.col("order_date").alias("date_day")).unionAll(
        interactions.select("event_date")
    )
    if as_date:
        seen = seen.select(F.col("date_day").cast("date").alias("date_day"))
    day = F.col("date_day")
    return seen.distinct().select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        temporal.iso_weekday(day).alias("day_of_week"),
        temporal.month_start(day).alias("first_day_of_month"),
        temporal.month_end(day).alias("last_day_of_month"),
    )


def dim_locations(locations: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and revenue of every location.

    Orders are summed per customer and customers per location, so a location
    with a third of all customers is one row when it is joined.
    """
    spending = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("orders"), F.sum("total_amount").alias("revenue"))
    )
    per_location = (
        customers.select("customer_id", "location_id")
        .join(spending, "customer_id", "left")
        .groupBy("location_id")
        .agg(
            F.count("customer_id").alias("total_customers"),
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return locations.join(per_location, "location_id", "left").select(
        "location_id",
        "city",
        "state",
        "country",
        F.coalesce("total_customers", zero).alias("total_customers"),
        F.coalesce("total_orders", zero).alias("total_orders"),
        F.col("total_revenue").cast(TOTAL).alias("total_revenue"),
    )


def dim_categories(
    categories_enriched: DataFrame, products: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Category counts and revenue.

    Revenue is defined over subcategories paired with order lines, so each line
    counts once per subcategory of its category. Revenue is summed per product
    and per category first and then multiplied.
    """
    revenue = (
        order_items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.sum("total_price").alias("revenue"))
        .join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return categories_enriched.join(revenue, "category_id", "left").select(
        "category_id",
        "category_name",
        "subcategory_count",
        "product_count",
        repeated(F.col("revenue"), F.col("subcategory_count"), TOTAL).alias("category_revenue"),
    )


def dim_products(products_named: DataFrame, as_of) -> DataFrame:
    """Products with names, sales totals and mean selling price.

    Totals come with the product: they are the same sums over its order lines.
    """
    return products_named.select(
        "product_id",
        "product_name",
        "description",
        "base_price",
        "sale_price",
        "stock_quantity",
        "category_name",
        "subcategory_name",
        "brand_name",
        "total_orders",
        "total_quantity_sold",
        "total_revenue",
        ratio_or_zero(F.col("total_revenue"), F.col("total_quantity_sold")).alias(
            "avg_selling_price"
        ),
        "review_count",
        "avg_review_score",
        "is_active",
        "created_at",
        temporal.moment(as_of).alias("updated_at"),
    )


# Months without an order until a customer leaves a status.
ACTIVE_MONTHS, AT_RISK_MONTHS = 3, 6


def dim_customers(customers_named: DataFrame, as_of) -> DataFrame:
    """Customers with names, order totals, status and lifetime as of a day."""
    today = temporal.today(as_of)
    last = F.col("last_order_date").cast("date")
    status = (
        F.when(last >= F.add_months(today, -ACTIVE_MONTHS), "Active")
        .when(last >= F.add_months(today, -AT_RISK_MONTHS), "At Risk")
        .otherwise("Churned")
    )
    began = F.coalesce("first_order_date", "signup_date").cast("date")
    return customers_named.select(
        "customer_id",
        "email",
        "first_name",
        "last_name",
        "age",
        "gender",
        "annual_income",
        "city",
        "state",
        "country",
        "education_type",
        "marital_status",
        "total_orders",
        "total_spent",
        ratio_or_zero(F.col("total_spent"), F.col("total_orders")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        status.alias("customer_status"),
        F.date_diff(today, began).alias("customer_lifetime_days"),
        "signup_date",
        "last_login",
        "is_active",
        "created_at",
        temporal.moment(as_of).alias("updated_at"),
    )
